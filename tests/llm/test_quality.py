import duckdb

from issuewatch.llm import quality
from issuewatch.llm.queries import QUERIES, SQL


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = QUERIES["op6_quality_rules"](spark, "/root/testdata/sf0.001")
    expected = con.execute(SQL["op6_quality_rules"])
    names = [c[0] for c in expected.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(expected.fetchall())


def brute(text):
    words = (text or "").encode().split()
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(i + k for i in at for k in range(8))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_counts_match_brute_force(spark, docs, none):
    found = quality.judge(docs).collect()
    texts = sorted(((r["doc_id"] or 0, r["text"]) for r in docs.collect()), key=lambda x: x[0])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r["doc_id"] or 0, tuple(r[n] for n in names)) for r in found), key=lambda x: x[0])
    assert got == [(i, brute(t)) for i, t in texts]
    assert all(r["base_failed"] and not r["kept"] for r in found if r["n_words"] < 20)
    assert quality.judge(none).count() == 0


def test_repeats_overlap_and_ends(spark):
    a = "a b c d e f g h"
    texts = [f"{a} {a}", f"{a} x {a} y {a}", "a " * 40, "a " * 8, f"x {a} z\n{a}", " ".join(map(str, range(30)))]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.judge(docs).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_bins_keep_order_and_precision(spark):
    values = [*range(300), 1023, 1024, 1025, 10**6, 10**12 + 12345, 2**62]
    rows = spark.createDataFrame([(v,) for v in values], "v long").selectExpr("v", f"cast({quality.bin_of('v')} as long) b")
    found = rows.selectExpr("v", "b", f"{quality.floor_of('b')} f").orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(found, found[1:], strict=False))
    assert all(r["f"] <= r["v"] < r["f"] * (1 + 2**-6) + 1 for r in found)


def test_noisy_outlier_fails_and_its_peers_stay(spark):
    plain = [(i, " ".join(f"word{(i * 7 + k) % 90}" for k in range(60)), "en", "s") for i in range(150)]
    noisy = [(900, " ".join(f"w{k}***###" for k in range(60)), "en", "s")]
    docs = spark.createDataFrame(plain + noisy, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert not got.pop(900) and all(got.values())


def test_fences_follow_each_source(spark):
    """What is usual in one source is an outlier in another, for every one-sided ratio."""

    def text(i, n_symbols, n_dup, n_repeat):
        line = " ".join(f"w{(i * 31 + k * 7) % 997}x" for k in range(120))
        again = " ".join(f"r{i}q{k}" for k in range(8))
        lines = [line, "#" * n_symbols, *[f"one{i}"] * (n_dup + 1 if n_dup else 0), *[f"{again} s{j}" for j in range(n_repeat)]]
        return "\n".join(x for x in lines if x)

    rows = []
    for source, usual in (("plain", (2, 0, 0)), ("code", (60, 0, 0)), ("lists", (2, 9, 0)), ("forms", (2, 0, 4))):
        rows += [(len(rows) + i, text(i, *usual), "en", source) for i in range(300)]
    odd = {"symbols": (60, 0, 0), "dup_lines": (2, 9, 0), "repeats": (2, 0, 4)}
    rows += [(9000 + k, text(700 + k, *counts), "en", "plain") for k, counts in enumerate(odd.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert not any(got.pop(9000 + k) for k in range(len(odd)))
    assert all(got.values())


def test_copies_do_not_narrow_the_word_lengths(spark):
    """A source of one text's copies in a language of its own keeps its few other texts."""
    rows = [(i, " ".join("w" * (3 + (i + k) % 5) + str(k) for k in range(40 + i % 9)), "en", "s") for i in range(400)]
    rows += [(1000 + i, " ".join(f"copy{k}" for k in range(40)), "xx", "hot") for i in range(200)]
    rows += [(2000 + i, rows[i][1], "xx", "hot") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r["kept"] for r in quality.judge(docs).collect())
