"""Operators against brute-force references on small fixtures."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from issuewatch.operators import comments as cm
from issuewatch.operators import issues, keywords, normalise, similarity
from issuewatch.sources.tables import read_table
from conftest import SF_SMALL


def brute_mmr(words, wv, dv, top_n=5, d=0.2):
    """Greedy MMR as the reference describes it (numpy, candidates in id order)."""
    W = np.array(wv, dtype=float)
    D = np.array(dv, dtype=float)
    cos = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    sd = [cos(w, D) for w in W]
    picked = [int(np.argmax(sd))]
    left = [i for i in range(len(words)) if i != picked[0]]
    for _ in range(top_n - 1):
        if not left:
            break
        scores = [(1 - d) * sd[i] - d * max(cos(W[i], W[p]) for p in picked) for i in left]
        best = left[int(np.argmax(scores))]
        picked.append(best)
        left.remove(best)
    return [words[i] for i in picked]


def test_mmr_matches_brute_force(spark):
    e = read_table(spark, SF_SMALL, "embeddings").select(F.col("label").alias("doc"), "vec_id", "embedding")
    dv = keywords.mean_vectors(e, "doc", "embedding")
    got = keywords.mmr(e, dv, "doc", "vec_id", "embedding").collect()
    rows = e.orderBy("doc", "vec_id").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc"], []).append(r)
    for doc, rs in by_doc.items():
        words = [r["vec_id"] for r in rs]
        W = [r["embedding"] for r in rs]
        want = brute_mmr(words, W, np.mean(np.array(W, dtype=float), axis=0))
        have = [r["vec_id"] for r in sorted((g for g in got if g["doc"] == doc), key=lambda g: g["rank"])]
        assert have == want


def test_mmr_fewer_candidates_than_n(spark):
    c = spark.createDataFrame([(1, 10, [1.0, 0.0]), (1, 11, [0.0, 1.0]), (2, 20, [1.0, 1.0])], "doc int, item int, emb array<double>")
    dv = spark.createDataFrame([(1, [1.0, 0.2]), (2, [1.0, 0.0])], "doc int, doc_vec array<double>")
    got = sorted(tuple(r) for r in keywords.mmr(c, dv, "doc", "item", "emb").collect())
    assert got == [(1, 1, 10), (1, 2, 11), (2, 1, 20)]


def test_thread_blocks_equal_plain_window(spark):
    c = read_table(spark, SF_SMALL, "conversations").select(F.col("conv_id").alias("post"), F.col("turn").alias("pos"), (F.col("role") == "assistant").alias("is_reply"))
    blocked = cm.last_flag_position(c, "post", "pos", (~F.col("is_reply")) | (F.col("pos") == 0), block=2)
    w = Window.partitionBy("post").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    plain = c.withColumn("flag_pos", F.max(F.when((~F.col("is_reply")) | (F.col("pos") == 0), F.col("pos"))).over(w))
    a = sorted(tuple(r) for r in blocked.select("post", "pos", "flag_pos").collect())
    b = sorted(tuple(r) for r in plain.select("post", "pos", "flag_pos").collect())
    assert a == b


def test_leading_reply_becomes_parent(spark):
    items = spark.createDataFrame([(1, 0, True), (1, 1, True), (1, 2, False), (1, 3, True)], "post int, pos int, is_reply boolean")
    t = cm.thread_reply_counts(cm.assemble_threads(items).select("post", "pos", "is_reply", "thread_pos", "is_parent"))
    assert sorted((r["thread_pos"], r["reply_count"]) for r in t.collect()) == [(0, 1), (2, 1)]


def test_replies_from_next(spark):
    items = spark.createDataFrame([(1, 0, 2, "c0"), (1, 1, 0, "replies"), (1, 2, 0, "c2"), (1, 3, 1, "c3")], "post int, pos int, rcnt int, txt string")
    got = sorted((r["pos"], r["replies"]) for r in cm.replies_from_next(items, "post", "pos", "rcnt", "txt").collect())
    assert got == [(0, "replies"), (1, None), (2, None), (3, None)]


def test_comment_shapes_and_seconds(spark):
    df = spark.createDataFrame(
        [
            (1, '[{"author":"a","content":"x","created_at":"2024-01-01  00:10:00","num_of_comments":"0","children":[]},{"author":"b","content":"y","created_at":" "}]'),
            (2, '[{"comment":{"author":"a","content":"x","created_at":"2024-01-02  00:00:30"},"children":[]}]'),
            (3, None),
        ],
        "id int, raw string",
    )
    c = cm.normalise_comments(F.col("raw"))
    out = df.select("id", cm.comment_count(c).alias("n"), cm.last_valid_comment_time(c).alias("last")).orderBy("id").collect()
    assert [(r["n"], r["last"]) for r in out] == [(2, "2024-01-01  00:10:00"), (1, "2024-01-02  00:00:30"), (0, None)]
    post = F.lit("2024-01-01 00:00:00").cast("timestamp")
    last = F.to_timestamp(F.regexp_replace(F.lit("2024-01-02  00:00:30"), r"\s+", " "))
    v = spark.range(1).select(cm.seconds_per_comment(post, last, F.lit(3))).first()[0]
    assert v == 10.0  # 86430 s -> seconds part 30 (whole days ignored) / 3


def test_series_points_and_zero_variance(spark):
    df = spark.createDataFrame(
        [("k", dt.datetime(2024, 1, 1, h), v) for h, v in enumerate([0.0, 2.0, 0.0, 2.0])] + [("z", dt.datetime(2024, 1, 1, h), 0.0) for h in range(4)],
        "key string, t timestamp, v double",
    )
    pts = {r["key"]: r for r in similarity.series_points(df, "key", "t", "v").collect()}
    assert pts["k"]["idx"] == [1, 3] and pts["k"]["z"] == [0.0, 0.0]  # constant -> z 0, never NaN
    assert pts["z"]["idx"] == [] and pts["z"]["n_points"] == 0
    sim = {(r[0], r[1]): r[2] for r in similarity.series_similarity(
        similarity.series_points(df, "key", "t", "v"),
        similarity.series_points(df.withColumnRenamed("key", "past_issue_name"), "past_issue_name", "t", "v"),
        cur_key="key",
    ).collect()}
    assert sim[("k", "k")] == 1.0  # identical curves
    assert sim[("z", "k")] == 0.0 and sim[("k", "z")] == 0.0  # an all-zero curve


def test_dense_grid_counts(spark):
    posts = spark.createDataFrame(
        [(dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 1, 3, 5, 10), ["a"], 10, 1, 2, 0.5)],
        "file_create_time timestamp, created_at timestamp, keywords array<string>, viewed long, liked long, num_of_comments long, sentiment double",
    )
    snap = F.lit("2024-01-03 05:00:00").cast("timestamp")
    cur = issues.current_issue(posts, posts, snap, days=1)
    rows = cur.collect()
    assert len(rows) == 24 + 6  # midnight of the day before .. 05:00 inclusive
    hit = [r for r in rows if r["viewed"] == 10]
    assert len(hit) == 1 and abs(hit[0]["current_issueization"] - (10 + np.log(2) + np.log(3))) < 1e-12


def test_issue_graph_per_issue_origin(spark):
    from issuewatch.operators import views

    past = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, h), float(h), 0.0) for h in range(3)] + [("b", dt.datetime(2024, 1, 5, h), float(h), 0.0) for h in range(2)],
        "past_issue_name string, created_at timestamp, past_issueization double, past_sentiment double",
    )
    cur = spark.createDataFrame(
        [(dt.datetime(2024, 3, 1, h), "k", 1.0, 0, 0, 0, 0.0) for h in range(4)],
        "created_at timestamp, current_keyword string, current_issueization double, num_of_comments long, viewed long, liked long, sentiment double",
    )
    now = F.lit("2024-03-10 05:30:00").cast("timestamp")
    rows = views.issue_graph(past, cur, now).collect()
    anchor = dt.datetime(2024, 1, 10, 5)
    # both past issues start at the anchor; 3 + 2 past hours meet the 4 current hours
    assert len(rows) == 5
    assert min(r["created_at"] for r in rows if r["past_issue_name"] == "b") == anchor
    assert min(r["created_at"] for r in rows if r["past_issue_name"] == "a") == anchor


def test_threads_from_any_first_position(spark):
    items = spark.createDataFrame([(1, 1, True), (1, 2, True), (1, 5000, False), (1, 9000, True), (2, 3, False)], "post int, pos int, is_reply boolean")
    t = cm.assemble_threads(items)
    assert sorted((r["post"], r["pos"], r["thread_pos"], r["is_parent"]) for r in t.collect()) == [
        (1, 1, 1, True), (1, 2, 1, False), (1, 5000, 5000, True), (1, 9000, 5000, False), (2, 3, 3, True)
    ]


def test_off_hour_snapshot_counts_for_its_hour(spark):
    t = dt.datetime(2024, 1, 3, 11, 7)
    posts = spark.createDataFrame(
        [(t, t, ["a"], 10, 1, 2, 0.5)],
        "file_create_time timestamp, created_at timestamp, keywords array<string>, viewed long, liked long, num_of_comments long, sentiment double",
    )
    cur = issues.current_issue(posts, posts, F.lit("2024-01-03 11:07:00").cast("timestamp"), days=1).collect()
    assert [(r["created_at"], r["viewed"]) for r in cur if r["viewed"]] == [(dt.datetime(2024, 1, 3, 11), 10)]


def test_unknown_source_is_quarantined(spark):
    rows = [
        (1, "reddit", "t", "c", "2024-08-20 13:05:09", "1", "2", "3", None),
        (2, "clien", "t 12", "hello www.a.com there", "2024-08-20  13:05:09", "5", "", None, '[{"author":"a","content":"x","created_at":"2024-08-20  13:06:09"}]'),
        (3, "clien", "t", "c", "yesterday", "5", "1", None, None),
        (4, "naver", "t", "c", "2024.08.20. 13:05", "조회 1.2만", "3", "1,234", None),
        (5, "dc", "t", "c", "2024.08.20 13:05:00", "x", "3", "1", None),
        (6, None, "t", "c", "2024.08.20 13:05:00", "1", "3", "1", None),
    ]
    schema = "id int, data_source string, title string, content string, created_at string, viewed string, liked string, num_of_comments string, comments string"
    good, bad = normalise.normalise_posts(spark.createDataFrame(rows, schema), F.lit("2024-09-01 00:00:00").cast("timestamp"))
    assert {r["id"]: r["reason"] for r in bad.collect()} == {1: "unknown source", 3: "failed date", 5: "failed number", 6: "unknown source"}
    got = {r["id"]: r for r in good.collect()}
    assert (got[2]["title"], got[2]["content"], got[2]["created_at"], got[2]["liked"], got[2]["num_of_comments"]) == ("t", "hello there", "2024-08-20 13:05:09", 0, 1)
    assert got[2]["comments"][0]["created_at"] == "2024-08-20 13:06:09"
    assert (got[4]["viewed"], got[4]["num_of_comments"]) == (12000, 1234)


def test_extract_keywords_takes_another_tokenizer_and_encoder(spark):
    docs = spark.createDataFrame([(1, "aa-bb-cc-bb"), (2, None)], "id int, t string")
    got = keywords.extract_keywords(docs, "id", "t", tokenizer=lambda c: F.filter(F.split(c, "-"), lambda w: w != ""), encoder=lambda texts: np.array([[len(x), x.count("b") + 1.0] for x in texts]))
    assert {r["keyword"] for r in got.collect()} == {"aa", "bb", "cc"}


def test_mmr_salts_follow_the_candidates(spark):
    e = read_table(spark, SF_SMALL, "embeddings").select(F.col("label").alias("doc"), "vec_id", "embedding")
    dv = keywords.mean_vectors(e, "doc", "embedding", dim=64)
    plain = keywords.mmr(e, dv, "doc", "vec_id", "embedding").collect()
    salted = keywords.mmr(e, dv, "doc", "vec_id", "embedding", bucket_rows=3).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, salted))


def test_hot_thread_is_nested_in_chunks(spark):
    """A thread of 100,000 replies, small ones, gaps, a post that begins with a reply."""
    from issuewatch.operators import comments as cm

    hot = spark.range(100_001).selectExpr("'hot' AS post", "id AS pos", "id > 0 AS is_reply", "concat('t', id) AS text")
    rows = [("a", 0, False, "p"), ("a", 5, True, "r"), ("a", 7, True, "s"), ("a", 9, False, "q"), ("b", 3, True, "x"), ("b", 4, True, "y"), ("c", 0, False, None)]
    items = hot.unionByName(spark.createDataFrame(rows, "post string, pos long, is_reply boolean, text string")).repartition(8)
    got = {(r.post, r.thread_pos, r.chunk_no): r for r in cm.nested_threads(items, chunk=1000).collect()}
    assert len(got) == 104
    chunks = [got["hot", 0, k] for k in range(100)]
    assert all(len(c.children) == 1000 and c.n_chunks == 100 and c.parent.text == "t0" for c in chunks)
    assert [x.pos for c in chunks for x in c.children] == list(range(1, 100_001))
    assert [(x.pos, x.text) for x in got["a", 0, 0].children] == [(5, "r"), (7, "s")] and got["a", 9, 0].children == []
    assert [x.text for x in got["b", 3, 0].children] == ["y"] and got["b", 3, 0].parent.text == "x"
    assert got["c", 0, 0].parent.text is None
    few = cm.nested_threads(items.where("post = 'a'"), chunk=2).collect()
    assert sorted((r.thread_pos, r.chunk_no, [x.pos for x in r.children]) for r in few) == [(0, 2, [5]), (0, 3, [7]), (9, 0, [])]


def test_hashed_counts_match_their_definition():
    texts = ["", "a", "ab é", "漢字 \U0001f389\U0010ffff", "lorem " * 50]
    for dim in (64, 37):
        want = np.zeros((len(texts), dim))
        for row, t in enumerate(f" {t} " for t in texts):
            for a, b, c in zip(map(ord, t), map(ord, t[1:]), map(ord, t[2:])):
                want[row, (961 * a + 31 * b + c) % dim] += 1 if (a + 7 * b + 13 * c) % 2 == 0 else -1
        assert (keywords.hashed_counts(texts, dim) == want).all()


def test_extract_keywords_takes_the_words_of_a_text_once(spark):
    docs = spark.createDataFrame([(1, "beta alpha beta gamma"), (2, None), (3, "1 2"), (4, "alpha")], "id long, t string")
    found = keywords.extract_keywords(docs, "id", "t")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    rows = [(r["id"], r["rank"], r["keyword"]) for r in found.collect()]
    assert sorted(k for i, _, k in rows if i == 1) == ["alpha", "beta", "gamma"]
    assert [r for r in rows if r[0] != 1] == [(4, 1, "alpha")]


def test_a_stage_reads_many_files_in_few_triggers(spark, tmp_path):
    from issuewatch.plans import catalog

    for n in (3, 20):
        spark.range(n).repartition(n, "id").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/{n}")
        done = spark.read.parquet(f"{tmp_path}/{n}")
        assert -(-len(done.inputFiles()) // catalog.files_a_trigger(done)) == catalog.STAGE_TRIGGERS
