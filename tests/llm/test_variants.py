import collections
import random
import re
import zlib

from pyspark.sql import functions as F

from issuewatch.llm import variants
from issuewatch.llm.queries import letter_words


def near(a, b):
    """Exactly one edit, by trying all of them."""
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, least=3, ratio=2):
    words = {w: n for w, n in counts.items() if n >= least}
    forms, near_of = {}, {}
    by_size = collections.defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w, n in words.items():
        near_of[w] = [x for k in (-1, 0, 1) for x in by_size[len(w) + k] if near(w, x)]
        best = min(near_of[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near_of[w]), words[forms[w]] if forms[w] else None))
    return out


def random_counts(seed, size, letters, longest):
    draw = random.Random(seed)
    counts = collections.Counter()
    for _ in range(size):
        w = "".join(draw.choice(letters) for _ in range(draw.randrange(1, longest)))
        counts[w] += draw.choice([1, 2, 3, 4, 9, 30, 200])
    return counts


def occurrences(spark, counts):
    rows = spark.createDataFrame(list(counts.items()), "word string, times int")
    return rows.select("word", F.explode(F.sequence(F.lit(1), "times")).alias("n"))


def test_dense_words_equal_brute_force_however_the_trie_is_cut(spark):
    counts = random_counts(1, 700, "abcé", 7) + random_counts(2, 300, "abcdefghijklmnopqrstuvwxyzàéÿÀ", 5)
    counts.update({"a" * 300: 5, "a" * 301: 20, "漢字漢字": 3, "漢字漢": 9, "\U0001f389x": 3, "x": 7})
    want = brute(counts)
    assert sum(r[1] is not None for r in want) > 100 and any(r[1] != r[2] and r[1] for r in want)
    rows = occurrences(spark, counts)
    for subtree_words in (50_000, 60, 1):  # one trie; a few levels; all levels and several parts each
        assert {tuple(r) for r in variants.spelling_variants(rows, subtree_words=subtree_words).collect()} == want


def test_one_edit_on_all_pairs():
    import pyarrow as pa

    import numpy as np

    words = sorted(random_counts(5, 300, "ab", 8)) + ["", "abcdefgh", "abcdefghi", "bcdefgh"]
    letters = variants._letters(pa.array(words))
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    got = variants.one_edit(letters, letters, i, j).tolist()
    assert got == [near(words[x], words[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)]


def test_small_blocks_of_pairs(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    words = sorted(random_counts(6, 400, "ab", 9))
    paths = np.zeros((len(words), variants.LEVELS), np.int16)  # one leaf holds all words
    trie = variants.Trie(pa.array(words), np.ones(len(words), np.int64), paths, 0)
    full = np.ones(len(words), bool)
    monkeypatch.setattr(variants, "PAIRS", 1000)
    blocks = list(trie.search(paths, full, full))
    assert max(len(q) for q, _ in blocks) <= 2000 and sum(len(q) for q, _ in blocks) == len(words) ** 2


def expected(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return brute(counts)


def test_query_rows_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = expected((r.doc_id, r.text) for r in docs.collect())
    got = [tuple(r) for r in variants.spelling_variants(letter_words(docs)).collect()]
    assert len(got) == len(want) > 1000 and set(got) == want


def test_edge_rows(spark, docs, none):
    want = expected((r.doc_id, r.text) for r in docs.collect())
    assert {tuple(r) for r in variants.spelling_variants(letter_words(docs)).collect()} == want
    assert variants.spelling_variants(letter_words(none)).collect() == []
    nulls = spark.createDataFrame([(None,), ("",)] * 9, "word string")
    assert variants.spelling_variants(nulls).collect() == []
