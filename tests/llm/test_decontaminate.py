import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from issuewatch.llm import decontaminate
from issuewatch.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(rows, items):
    """(doc, item) pairs with an aligned stretch of enough words, four of five equal."""
    found = set()
    for i, b in items:
        b = words(b)
        for d, a in rows:
            a = words(a)
            for shift in range(-len(b) + 1, len(a)):
                equal = [a[k + shift] == w for k, w in enumerate(b) if 0 <= k + shift < len(a)]
                need = min(decontaminate.MIN_OVERLAP, len(b))
                sums = [0]
                for e in equal:
                    sums.append(sums[-1] + e)
                if any(5 * (sums[y] - sums[x]) >= 4 * (y - x) for x in range(len(sums)) for y in range(x + need, len(sums))):
                    found.add((d, i))
    return found


def test_documents_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    grams = {tuple(w[k : k + 5]) for _, t in items for w in [words(t)] for k in range(len(w) - 4)}
    near = [(d, t) for d, t in rows if any(tuple(w[k : k + 5]) in grams for w in [words(t)] for k in range(len(w) - 4))]
    got = QUERIES["op10_decontaminate"](spark, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(near, items)


def test_substituted_words_short_items_and_clean_texts(spark):
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(5000)]
    item = [draw.choice(vocabulary) for _ in range(40)]
    changed = [w if k % 9 else "other" for k, w in enumerate(item)]
    noise = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    short = "seven words make up this short item".split()
    rows = [
        (1, " ".join(noise(50) + item + noise(50))),
        (2, " ".join(noise(500) + changed + noise(5))),
        (3, " ".join(noise(30) + item[:8] + noise(30))),
        (4, " ".join(noise(100) + short)),
        (5, " ".join(noise(20) + short[:6])),
        (6, " ".join(item[20:] + noise(10))),
        (7, " ".join(noise(3000))),
    ]
    items = [(10, " ".join(item)), (11, " ".join(item).upper()), (12, " ".join(short)), (13, "too short"), (14, None), (15, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_overlaps(docs, benchmark).collect()}
    assert set(got) == {(1, 10), (2, 10), (4, 12), (6, 10)} == brute(rows, [items[0], items[2]])
    assert (got[1, 10]["doc_pos"], got[1, 10]["item_pos"], got[1, 10]["n_words"], got[1, 10]["n_equal"]) == (50, 0, 40, 40)
    assert got[2, 10]["doc_pos"] == 501 and got[2, 10]["n_equal"] == 35
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(docs, benchmark).collect()} == {3, 5, 7}


def test_large_benchmarks_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", 0)
    text = " ".join(f"t{k}" for k in range(30))
    docs = spark.createDataFrame([(1, f"x {text} y"), (2, "nothing here")], "doc_id long, text string")
    got = decontaminate.find_overlaps(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["n_words"]) for r in got] == [(1, 7, 30)]


def test_edge_rows(spark, docs, none):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi", "x"), (None, None, "y")], "item_id long, text string, h string")
    got = decontaminate.find_overlaps(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(4, 1), (5, 1)]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == 7
    assert decontaminate.find_overlaps(none, items).count() == 0
    assert decontaminate.find_overlaps(docs, items.limit(0)).count() == 0


def test_best_stretch_matches_brute_force(spark):
    draw = random.Random(8)
    rows = [(13, [k not in gone for k in range(13)]) for count in (1, 2) for gone in combinations(range(13), count)]
    rows += [(13, [k not in gone for k in range(15)]) for count in (1, 2, 3) for gone in combinations(range(15), count)]
    rows += [(draw.choice([5, 9, 13]), [draw.random() < p for _ in range(draw.randint(1, 60))]) for p in (0.5, 0.75, 0.8, 0.9) for _ in range(100)]
    frame = spark.createDataFrame(rows, "need int, equal array<boolean>").coalesce(2)
    got = frame.select("need", "equal", decontaminate.best_stretch(F.col("equal"), F.col("need")).alias("s")).collect()
    assert len(got) == len(rows)
    for need, equal, (best, lo, hi) in got:
        fits = [(sum(equal[x:y]), x, y) for x in range(len(equal)) for y in range(x + need, len(equal) + 1) if 5 * sum(equal[x:y]) >= 4 * (y - x)]
        assert best == max([f[0] for f in fits], default=0)
        assert not best or (best, lo, hi) in fits


def test_substituted_words_at_every_position_of_items(spark):
    rows, items = [], []
    for n, count in ((13, 1), (15, 1), (20, 1), (20, 2)):
        for gone in combinations(range(n), count):
            k = len(items)
            item = [f"i{k}w{j}" for j in range(n)]
            items.append((k, " ".join(item)))
            rows.append((k, " ".join(["before", *("other" if j in gone else w for j, w in enumerate(item)), "after"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = decontaminate.find_overlaps(docs, spark.createDataFrame(items, "item_id long, text string").coalesce(2)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k, _ in rows}
    assert all(r["n_words"] >= 13 and 5 * r["n_equal"] >= 4 * r["n_words"] for r in got)


def test_short_items_with_any_allowed_substitutions(spark):
    rows, items, near = [], [], set()
    for n in range(1, 14):
        for count in range(n // 5 + 2):
            for gone in combinations(range(n), count):
                k = len(items)
                item = [f"i{k}w{j}" for j in range(n)]
                items.append((k, " ".join(item)))
                rows.append((k, " ".join(["before", *("other" if j in gone else w for j, w in enumerate(item)), "after"])))
                if count <= n // 5:
                    near.add((k, k))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = decontaminate.find_overlaps(docs, spark.createDataFrame(items, "item_id long, text string").coalesce(2)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == near


def recall(n, changes):
    """The share of the ways to change so many of `n` words that leave some window's seed as it was."""
    windows = [frozenset(at + k for k, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS for at in range(n - len(m) + 1)]
    ways = list(combinations(range(n), changes))
    return sum(any(w.isdisjoint(way) for w in windows) for way in ways) / len(ways)


def test_recall_of_the_fixed_masks():
    assert recall(13, 2) == 1
    assert all(recall(n, n // 5) >= 0.9 for n in range(13, 25))


def test_both_joins_find_the_same(spark, docs, monkeypatch):
    """The join without broadcast: substituted words, rows that share an id, null ids, short items."""
    draw = random.Random(5)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate([3, 8, 13, 20, 40])] + [(9, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (10, None)]
    rows = []
    for k, text in items[:5]:
        for d in (1, 1, 2, None):
            w = [x if draw.random() > 0.1 else "other" for x in text.split()]
            rows.append((d, " ".join(["z"] * draw.randrange(4) + w + ["y"])))
    texts = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((tuple(r) for r in decontaminate.find_overlaps(texts, benchmark).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", 0)
    got = decontaminate.find_overlaps(texts, benchmark)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and len(want) > 5
