import random
from difflib import SequenceMatcher

from issuewatch.llm import licenses
from issuewatch.llm.queries import QUERIES

MIT = licenses.TEMPLATES[0][1]


def test_finds_every_notice_of_the_documents(spark):
    names = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    expected = {(r["doc_id"], name) for r in rows for text, name in names.items() if text in r["text"]}
    got = QUERIES["op9_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert {(r["doc_id"], r["license"]) for r in got} == expected
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(names[text[r["doc_id"]][r["start"] : r["end"]] + "."] == r["license"] for r in got)


def test_wording_differences():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    changed = MIT.replace("free of charge", "free of any charge").replace("publish, ", "")
    found = scanner.scan(f"some code\n{changed}\nmore code")
    assert [(f[0], f[6], f[7]) for f in found] == [("MIT", ["publish"], ["any"])]
    assert 0.9 < found[0][5] < 1


def test_prose_about_licenses_is_no_license():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    assert scanner.scan("He lost his driving license without permission, and the copyright office was closed for the day.") == []


def test_two_licenses_and_a_long_text():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = "x " * 40_000 + "Released under the MIT License. " + "y " * 10 + "Licensed under CC BY-SA 4.0. " + "license " * 5000
    assert [f[0] for f in scanner.scan(text)] == ["MIT", "CC-BY-SA-4.0"]


def test_edge_rows(spark, docs, none):
    assert licenses.scan_licenses(docs).count() == 0
    assert licenses.scan_licenses(none).count() == 0
    rows = spark.createDataFrame([(None, MIT, 1), (3, MIT, 2), (3, MIT, 2)], "doc_id long, text string, start int")
    assert sorted((r["doc_id"] or 0) for r in licenses.scan_licenses(rows).collect()) == [0, 3, 3]


def test_short_notices_in_long_texts_of_license_words():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    draw = random.Random(3)
    syllables = ["ba", "ro", "ti", "men", "sal", "or", "ven", "cu", "dis", "la", "per", "nu"]
    vocabulary = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(3000)]
    for marker in ("license", "copyright", "permission"):
        words = [marker if k % 180 == 0 else draw.choice(vocabulary) for k in range(3000)]
        for at in (0, 700, 1501, 3000):
            for notice in ("Released under the MIT License.", "Licensed under CC BY-NC 4.0."):
                before = " ".join([*words[:at], ""])
                found = scanner.scan(f"{before}{notice} {' '.join(words[at:])}")
                assert [(f[2], f[3], f[6]) for f in found] == [(len(before), len(before) + len(notice) - 1, [])]


def test_compression_decides_between_texts_that_differ_in_a_few_words(monkeypatch):
    """Every template, alone and beside its nearest relatives, is known as itself, though the
    others' words agree with it well enough to be confirmed; another ranking gives others."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    pad = "some words of code "
    for i, (name, template) in enumerate(licenses.TEMPLATES):
        if scanner.words[i] in scanner.words[:i]:
            continue
        found = scanner.scan(f"{pad}{template} {pad}")
        assert [(f[0], f[1], f[6], f[7]) for f in found] == [(name, i, [], [])]
    relatives = [t for n, t in licenses.TEMPLATES if n in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "AGPL-3.0") and t.startswith("This ")]
    together = scanner.scan(f" {pad}".join(relatives))
    assert [licenses.TEMPLATES[f[1]][1] for f in together] == relatives
    monkeypatch.setattr(licenses.Scanner, "reduction", lambda self, i, block: 0)
    other = scanner.scan(f" {pad}".join(relatives))
    assert [licenses.TEMPLATES[f[1]][1] for f in other] != relatives


def test_scan_matches_all_alignments():
    """Texts with planted and changed notices: every license word's surroundings, aligned
    with every template at every word, gives the same licenses."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    draw = random.Random(5)
    for _ in range(12):
        words = draw.choices(["license", "of", "the", "work", "under", "code", "public", "version"], k=60)
        names = set()
        for name, template in draw.sample([t for t in licenses.TEMPLATES if len(t[1]) > 100], 2):
            quoted = template.split()
            for _ in range(len(quoted) // 30):
                quoted[draw.randrange(1, len(quoted) - 1)] = "zebra"
            words[draw.randrange(10, 50):0] = ["unrelated"] * 40 + quoted + ["unrelated"] * 40
            names.add(name)
        text = " ".join(words)
        assert best_of_all(scanner, text) <= {f[0] for f in scanner.scan(text)}


def best_of_all(scanner, text):
    """The licenses whose template has, at some word, more words in order than any other."""
    words = [m.group().lower() for m in licenses.WORDS.finditer(text)]
    best = {}
    for i, template in enumerate(scanner.words):
        for at in range(len(words)):
            part = words[at : at + licenses.reach(len(template))]
            if len(set(template) & set(part)) < 0.5 * len(set(template)):
                continue
            same = [m for m in SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if m.size]
            n = sum(m.size for m in same)
            if n >= licenses.CONFIRM * len(template):
                for k in range(at + same[0].b, at + same[-1].b + same[-1].size):
                    best[k] = max(best.get(k, (0, 0.0, "")), (n, n / len(template), scanner.templates[i][0]))
    return {v[2] for v in best.values()}
