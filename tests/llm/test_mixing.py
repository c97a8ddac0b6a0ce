import hashlib

import duckdb
from pyspark.sql import functions as F

from issuewatch.llm import mixing
from issuewatch.llm.queries import QUERIES, SQL

WEIGHTS = {"domain": {"a": 3, "b": 1, "z": 0}, "lang": {"en": 2}, "source": {}}


def share(total, nodes):
    """name -> tokens of (cap, weight) siblings, by raising the water step by step."""
    out, left, open_ = {}, total, {n: (c if w else 0, w) for n, (c, w) in nodes.items()}
    while open_:
        weight = sum(w for _, w in open_.values())
        full = {n: c for n, (c, w) in open_.items() if w == 0 or c * weight <= left * w}
        if not full:
            return out | {n: left * w // weight for n, (_, w) in open_.items()}
        first = min(full, key=lambda n: (open_[n][0] / open_[n][1] if open_[n][1] else 1e300, n))
        out[first] = open_.pop(first)[0]
        left -= out[first]
    return out


def brute(rows, percent, epochs, seed):
    """Sorted (id, copies) of rows (id, domain, lang, source, tokens)."""
    weight = lambda level, name: WEIGHTS[level].get(name, 1)
    tree = {}
    for _, d, g, s, n in rows:
        node = tree.setdefault(d, {}).setdefault(g, {})
        node[s] = node.get(s, 0) + n
    usable = lambda d, g, s: epochs * tree[d][g][s] * (0 if 0 in (weight("domain", d), weight("lang", g), weight("source", s)) else 1)
    caps = {d: {g: sum(usable(d, g, s) for s in tree[d][g]) for g in tree[d]} for d in tree}
    quota = {}
    by_domain = share(sum(r[4] for r in rows) * percent // 100, {d: (sum(caps[d].values()), weight("domain", d)) for d in tree})
    for d in tree:
        by_lang = share(by_domain[d], {g: (caps[d][g], weight("lang", g)) for g in tree[d]})
        for g in tree[d]:
            for s, q in share(by_lang[g], {s: (usable(d, g, s), weight("source", s)) for s in tree[d][g]}).items():
                quota[d, g, s] = q
    out = []
    for leaf, q in quota.items():
        own = [r for r in rows if tuple(r[1:4]) == leaf]
        total = sum(r[4] for r in own)
        whole = min(q // total, epochs) if total else 0
        rest = -1 if q == 0 or whole == epochs else q - whole * total
        key = {r[0]: hashlib.md5(f"{seed}:{whole}:{r[0]}".encode()).hexdigest() for r in own}
        for r in own:
            upto = sum(x[4] for x in own if key[x[0]] <= key[r[0]])
            out.append((r[0], whole + (upto <= rest)))
    return sorted(out)


def test_matches_brute_force(spark):
    rows, k = [], 0
    for d, g, s, count in (("a", "en", "s1", 4), ("a", "en", "s2", 30), ("a", "fr", "s1", 2), ("b", "en", "s3", 50), ("b", "de", "s4", 9), ("z", "en", "s5", 7)):
        for _ in range(count):
            rows.append((k, d, g, s, k % 7 + 1))
            k += 1
    rows.append(rows[5])
    docs = spark.createDataFrame([(i, d, g, s, " ".join(["w"] * n)) for i, d, g, s, n in rows], "doc_id long, dom string, lang string, source string, text string")
    for percent, epochs in ((30, 1), (90, 2), (150, 3), (1000, 2)):
        got = mixing.mix(docs, F.col("dom"), WEIGHTS, percent, epochs, 5).collect()
        assert sorted((r["doc_id"], r["copies"]) for r in got) == brute(rows, percent, epochs, 5), (percent, epochs)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = QUERIES["op5_source_mixing"](spark, "/root/testdata/sf0.001")
    expected = con.execute(SQL["op5_source_mixing"])
    names = [c[0] for c in expected.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(expected.fetchall())


def test_edge_rows_and_copies(spark, docs, none):
    mixed = mixing.mix(docs, F.lit(None).cast("string"), {}, 100, 2)
    assert mixed.count() == docs.count()
    taken = mixing.take_mix(docs, mixed)
    assert taken.columns == docs.columns
    per_id = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    repeats = {4: 2}
    assert taken.count() == sum(n * repeats.get(i, 1) for i, n in per_id.items())
    assert mixing.mix(none, F.lit("a"), {}, 100, 2).count() == 0
