import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from issuewatch.llm import periodic
from issuewatch.llm.queries import looped_texts


def brute(words, least=12):
    """By the definition: every lag's maximal stretches, kept if no smaller lag fits the same stretch."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            smaller = any(all(words[x] == words[x + p] for x in range(start, end - p)) for p in range(1, q))
            if end - start >= max(least, 2 * q) and not smaller:
                out.add((start, end, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def as_numbers(words):
    table = {}
    return np.array([table.setdefault(w, len(table)) for w in words], np.int64)


def test_runs_equal_the_definition():
    draw = random.Random(3)
    seen = 0
    for k in range(400):
        n = draw.randrange(0, 90)
        words = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(n)]
        if k % 2 and n > 30:  # a copy of a stretch, several times over
            p, at = draw.randrange(1, 15), draw.randrange(10)
            for i in range(at + p, min(n, at + draw.randrange(2, 6) * p + draw.randrange(p))):
                words[i] = words[i - p]
        for least in (2, 5, 12, 13):
            want = brute(words, least)
            assert [tuple(r) for r in periodic.runs(as_numbers(words), least).tolist()] == want
            seen += len(want)
    assert seen > 1000


def test_structured_words():
    fib = ["a", "b"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    for words in (fib[-1][:400], "a" * 300, "a" * 100 + "b" + "a" * 120, "ab" * 40 + "c" + "ab" * 40, ("abc" * 7 + "d") * 12):
        assert [tuple(r) for r in periodic.runs(as_numbers(words), 12).tolist()] == brute(words)


def test_one_word_a_million_times():
    found = periodic.runs(np.zeros(1_000_000, np.int64), 12)
    assert found.tolist() == [[0, 1_000_000, 1]]


def test_documents_of_one_chunk_do_not_meet(spark):
    """Equal neighbours, and a text over the chunk size between small ones."""
    texts = ["x y " * 4, "x y " * 4, "x y " * 8, None, "", " \t\n", "w " * (periodic.CHUNK_WORDS + 5), "x y " * 6 + "z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert [[tuple(x) for x in rows[i].runs] for i in range(8)] == [[], [], [(0, 16, 2)], [], [], [], [(0, periodic.CHUNK_WORDS + 5, 1)], [(0, 12, 2)]]
    assert [rows[i].collapsed for i in (0, 2, 3, 5, 6, 7)] == ["x y x y x y x y", "x y", "", "", "w", "x y z"]


def rewritten(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    found = brute(words)
    gone = {x for s, e, q in found for x in range(s + q, e)}
    best = min(((s - e, s, q) for s, e, q in found), default=None)
    four = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *four, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def digests(docs):
    return periodic.run_digest(periodic.periodic_runs(looped_texts(docs)))


def test_query_rows_equal_brute_force(spark):
    """Whole rows of the query over short texts of the table, of which a tenth are made periodic."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.length("text") < 2500)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r) for r in digests(docs).collect()}
    assert len(texts) > 50 and got == {i: expected(i, t) for i, t in texts.items()}
    assert sum(r[1] > 0 for r in got.values()) > 3


def test_edge_rows(spark, docs, none):
    rows = digests(docs).collect()
    assert len(rows) == docs.count()
    texts = [(r.doc_id, r.text) for r in docs.collect() if (r.text or "").count(" ") < 100]
    some = {x.doc_id: tuple(x) for x in rows}
    for i, t in texts:
        assert some[i] == expected(i, t)
    assert digests(none).collect() == []
    assert len(digests(none).columns) == 8
