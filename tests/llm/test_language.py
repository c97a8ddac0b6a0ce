import math
import random
import zlib
from collections import Counter

import numpy as np

from issuewatch.llm import language
from issuewatch.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_pieces_do_not_change_the_ngrams(monkeypatch):
    text = "Straße 12 été, ok? ÀB c"
    whole = sorted(x for b in language.ngram_buckets(text) for x in b.tolist())
    monkeypatch.setattr(language, "CHUNK", 4)
    assert sorted(x for b in language.ngram_buckets(text) for x in b.tolist()) == whole
    assert list(language.ngram_buckets("12 !?")) == []


def test_edge_rows(docs, none, spark):
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 7))
    assert got[6]["lang_pred"] in ("en", "de", "fr")
    assert language.identify(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language.identify(unlabelled).collect()] == ["und"]


def test_rejected_documents_go(docs, none):
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {4, 5, 6, 8, None}
    assert language.keep_known(none).count() == 0


def plain_buckets(text):
    """The buckets of a text's n-grams with Python integers, one n-gram at a time."""
    letters, last = " ", True
    for c in text.lower():
        if c.isalpha() or not last:
            letters += c if c.isalpha() else " "
        last = not c.isalpha()
    letters += " "
    counts = Counter()
    for n in (1, 2, 3):
        for at in range(len(letters) - n + 1):
            gram = 0
            for k, c in enumerate(letters[at : at + n]):
                gram = (gram * 0xC2B2AE3D + ord(c) + k + 1) * 0x9E3779B1 % (1 << 64)
            counts[(gram * 0x9E3779B97F4A7C15 % (1 << 64)) >> 49] += 1
    return counts


def test_batches_score_as_plain_naive_bayes(spark, monkeypatch):
    """Counts, probabilities and posteriors of a model fitted on few texts, recomputed text by
    text; batches that are gathered in many steps and pieces give the same."""
    draw = random.Random(2)
    alphabets = {"aa": "abcde fghij", "bb": "defgh, klmno", "cc": "äöü xyzab."}
    rows = [(i, "".join(draw.choices(alphabets[x], k=draw.randint(1, 60))) + "a", x) for i in range(60) for x in [draw.choice(list(alphabets))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    counts = {x: Counter() for x in alphabets}
    for _, text, lang in learnt:
        counts[lang] += plain_buckets(text)
    sizes = Counter(r[2] for r in learnt)

    def plain(text):
        z = []
        for x in sorted(alphabets):
            whole = counts[x].total() + 0.5 * language.BUCKETS
            z.append(math.log(sizes[x] / len(learnt)) + sum(n * math.log((counts[x][b] + 0.5) / whole) for b, n in plain_buckets(text).items()))
        e = [math.exp(v - max(z)) for v in z]
        return [v / sum(e) for v in e]

    texts = [r[1] for r in rows] + ["a", "ß x", "öb " * 300]
    expected = np.array([plain(t) for t in texts])
    assert model.languages == sorted(alphabets)
    assert np.allclose(model.posteriors(texts), expected, rtol=1e-7, atol=1e-12)
    monkeypatch.setattr(language, "GATHER", 40)
    assert np.allclose(model.posteriors(texts), expected, rtol=1e-7, atol=1e-12)
    assert not model.posteriors([None, "a", None])[[0, 2]].any()
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert got == {r[0]: sorted(alphabets)[int(np.argmax(plain(r[1])))] for r in rows}
