"""End-to-end job, compaction stream and the sparse-series fixture."""

import datetime as dt
import json
import math
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from issuewatch.functions import dtw
from issuewatch.operators import alerts, issues, similarity, views
from issuewatch.plans import fixtures as fx
from issuewatch.plans import pipeline
from issuewatch.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, scratch_path
from issuewatch.sources import files
from issuewatch.streaming import streams


def test_sparse_series_similarity(spark):
    s = fx.sparse_series(spark, 4, 120)
    pts = similarity.series_points(s, "name", "created_at", "value")
    sim = similarity.series_similarity(pts, pts.withColumnRenamed("name", "past_issue_name"), cur_key="name").collect()
    assert len(sim) == 16
    for r in sim:
        assert 0.0 <= r["similarity_degree"] <= 1.0
        if r["name"] == r["past_issue_name"]:
            assert r["similarity_degree"] == 1.0


def test_pipeline_writes_all_outputs(spark):
    posts = fx.kw_posts(spark, SF_SMALL)
    snap = fx.snapshot_time(posts)
    batch = fx.current_batch(posts, snap)
    history = posts.join(batch.select("event_id"), "event_id", "left_anti")
    out = scratch_path(spark, "wh-test")
    paths = pipeline.run_snapshot(spark, batch, history, fx.past_issue(spark, SF_SMALL), snap, out, model="kona")
    for name in ("raw_data", "current_issue", "current_issue_frequency", "similarity", "alerts"):
        assert spark.read.parquet(paths[name]).count() > 0, name
    alert = spark.read.parquet(paths["alerts"]).first()
    assert alert["AlarmName"].startswith("kona ")
    # replaying the same snapshot does not duplicate raw_data rows
    n1 = spark.read.parquet(paths["raw_data"]).count()
    pipeline.run_snapshot(spark, batch, history, fx.past_issue(spark, SF_SMALL), snap, out)
    assert spark.read.parquet(paths["raw_data"]).count() == n1 == batch.count()


def test_hourly_batches_of_a_day_stay(spark):
    """Two snapshots of one day, and a replay of the first."""
    rows = [(i, dt.datetime(2024, 1, 1, 10 + i // 10, 7)) for i in range(20)]
    p = files.with_snapshot_partitions(spark.createDataFrame(rows, "event_id long, t timestamp"), F.col("t"))
    out = scratch_path(spark, "hours-test")
    for hour in (10, 11, 10):
        files.write_table(p.where(F.col("snapshot_hour") == hour), out)
    assert spark.read.parquet(out).count() == 20


def test_history_scan_prunes_partitions(spark):
    p = files.with_snapshot_partitions(fx.kw_posts(spark, SF_SMALL), F.col("file_create_time"))
    out = scratch_path(spark, "prune-test")
    files.write_table(p, out)
    history = spark.read.parquet(out)
    start, end = issues.window_bounds(F.lit("2024-01-05 11:07:00").cast("timestamp"), 2)
    plan = issues.keyword_hour_sums(history, start, end)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_window_from_stored_sums(spark):
    """Hour by hour the stored sums give what the posts give; a replayed hour counts once,
    a snapshot after the window's end not at all, and only the window's folders are read."""
    start = dt.datetime(2024, 1, 5, 9, 7)
    rows = [
        (start + dt.timedelta(hours=h), ["a", "b"] if i % 2 else (["a"] if i else None), i, 2 * i, None if i == 3 else 1, 0.5)
        for h in (0, 1, 2, 30, 100)
        for i in range(5)
    ]
    posts = spark.createDataFrame(rows, "file_create_time timestamp, keywords array<string>, viewed long, liked long, num_of_comments long, sentiment double")
    raw, path = scratch_path(spark, "raw-test"), scratch_path(spark, "sums-test")
    files.write_table(files.with_snapshot_partitions(posts.where(F.col("file_create_time") == F.lit(start)), F.col("file_create_time")), raw)
    for h in (0, 1, 2, 30, 30, 100):
        at = F.lit(start + dt.timedelta(hours=h))
        table = pipeline.append_sums(spark, posts.where(F.col("file_create_time") == at), at, raw, path)
    assert table.count() == 10
    batch, snap = posts.where(F.col("file_create_time") == F.lit(rows[15][0])), F.lit(rows[15][0])
    for days in (0, 1, 3):
        got = issues.current_issue_from_sums(table, batch, snap, days)
        assert sorted(got.collect()) == sorted(issues.current_issue(posts, batch, snap, days).collect())
    plan = issues.window_sums(table, *issues.window_bounds(snap, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_compaction_over_several_batches_and_replay(spark):
    """Two triggers feed the same folders; broken messages are kept apart; a replay of the
    whole stream with the same checkpoint adds nothing."""
    msgs, out, cp = (scratch_path(spark, n) for n in ("msgs-test", "out-test", "cp-test"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "snapshot_key", "data_source")])
    for batch in range(2):
        lines = [json.dumps({"url": f"u{batch}{i}", "snapshot_key": "s", "data_source": "dc"}) for i in range(10)]
        lines += ["{broken", "[1]", json.dumps({"url": "x", "data_source": "dc"})]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(msgs)
        for _ in range(2):
            streams.compact_messages_stream(spark, msgs, schema, out, checkpoint=cp, max_files=1)
    back = spark.read.schema(schema).json(out)
    assert sorted(r["url"] for r in back.collect()) == sorted(f"u{b}{i}" for b in range(2) for i in range(10))
    assert spark.read.text(f"{out}-quarantine").count() == 6


def test_closed_snapshots_are_gathered_once(spark):
    """Gathered, replayed, late batches, gathered again: each message is read once at each step."""
    msgs, out, cp = (scratch_path(spark, n) for n in ("msgs-test", "out-test", "cp-test"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "snapshot_key", "data_source")])
    want = []

    def arrive(k):
        rows = [{"url": f"u{k}{i}", "snapshot_key": key, "data_source": src} for i, (key, src) in enumerate([("s1", "dc"), ("s1", "naver"), ("s2", "dc")])]
        want.extend((r["url"], r["snapshot_key"], r["data_source"]) for r in rows)
        spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.mode("append").text(msgs)
        streams.compact_messages_stream(spark, msgs, schema, out, checkpoint=cp)

    def read():
        return sorted(tuple(r) for r in streams.read_messages(spark, out, schema).collect())

    assert read() == []
    for k in range(3):
        arrive(k)
    assert read() == sorted(want)
    first = streams.compact_closed(spark, out, "s1")
    assert read() == sorted(want) and streams.compact_closed(spark, out, "s1") == first
    arrive(3)
    assert read() == sorted(want)
    assert streams.compact_closed(spark, out, "s1") != first and read() == sorted(want)
    streams.compact_closed(spark, out, "s2")
    assert read() == sorted(want) and streams.compact_closed(spark, out, "none") is None
    assert len(files.folders(spark, f"{out}/snapshot_key=s1/data_source=*/batch=*")) == 0  # gathered before, no longer named


def test_hourly_sums_over_many_compactions(spark):
    """Thirty batches, merged each two: the sums stay, and few folders are live."""
    land, out = scratch_path(spark, "land-test"), scratch_path(spark, "hourly-test")
    rows = [(k, NOON + dt.timedelta(minutes=17 * (k * 7 % 300)), ["a", "b"][: 1 + k % 2], k, 1, 2, 0.5) for k in range(300)]
    schema = "event_id long, created_at timestamp, keywords array<string>, viewed long, liked long, num_of_comments long, sentiment double"
    for k in range(30):
        spark.createDataFrame(rows[10 * k : 10 * k + 10], schema).coalesce(1).write.parquet(f"{land}/f={k:02}")
    for every in (2,):
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
        streams.hourly_issue_stream(spark, source, lambda df: df, f"{out}{every}", compact_every=every)
        got = {(r.created_at, r.current_keyword): (r.viewed, r.liked, round(r.sentiment, 6)) for r in streams.read_hourly_issue(spark, f"{out}{every}").collect()}
        want = {}
        for _, t, words, v, li, _, se in rows:
            for w in words:
                at = (t.replace(minute=0), w)
                a, b, c = want.get(at, (0, 0, 0.0))
                want[at] = (a + v, b + li, c + se)
        assert got == want
        segments, through, batches = streams._live_parts(spark, f"{out}{every}")
        assert len(segments) <= streams.SEGMENTS and len(batches) <= every + 1 and through >= 25
        assert len(files.versions(spark, f"{out}{every}", "batch_id=")) <= 2 * every + 2


def test_gate_calls_once_per_complete_snapshot(spark):
    rows = [(i, dt.datetime(2024, 1, 1), src, f"u{i}", dt.datetime(2024, 1, 1, 0, i)) for i, src in enumerate(["dc", "naver", "bobae", "clien", "dc"])]
    rows += [(9, dt.datetime(2024, 1, 1), "dc", "u0", dt.datetime(2024, 1, 1, 0, 30)), (10, dt.datetime(2024, 1, 2), "dc", "u", dt.datetime(2024, 1, 2))]
    land, raw, done = (scratch_path(spark, n) for n in ("land-test", "raw-test", "done-test"))
    spark.createDataFrame(rows, "event_id long, file_create_time timestamp, data_source string, url string, created_at timestamp").write.parquet(land)
    seen = []
    posts = spark.readStream.schema(spark.read.parquet(land).schema).parquet(land)
    streams.snapshot_gate_stream(spark, posts, raw, done, on_complete=seen.append)
    assert seen == [dt.datetime(2024, 1, 1)]
    assert spark.read.parquet(raw).count() == 6  # u0 of dc, delivered twice, is one post


GATE_ROW = "event_id long, file_create_time timestamp, data_source string, url string, created_at timestamp"
NOON = dt.datetime(2024, 1, 10, 12)


def gate_rows(trigger, hour=NOON):
    """A crawl of one source: urls of two days, half of them seen by the crawl before."""
    src = ["dc", "naver", "bobae", "clien"][trigger % 4]
    return [(100 * trigger + i, hour, src, f"u{i + trigger // 4}", hour - dt.timedelta(hours=12 * i)) for i in range(5)]


def test_gate_keeps_old_posts_over_many_triggers(spark):
    """Eight triggers of one file each, posts up to two days old, sources delivered twice, one
    snapshot long before the others and last: nothing is too late, nothing is kept twice."""
    land, raw, done = (scratch_path(spark, n) for n in ("land-test", "raw-test", "done-test"))
    early = NOON - dt.timedelta(days=3)
    crawls = [gate_rows(k) for k in range(8)] + [gate_rows(k, early) for k in range(4)]
    seen = []
    for k, rows in enumerate(crawls):
        spark.createDataFrame(rows, GATE_ROW).coalesce(1).write.parquet(f"{land}/f={k:02}")
        posts = spark.readStream.schema(GATE_ROW).option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
        streams.snapshot_gate_stream(spark, posts, raw, done, on_complete=seen.append)
    kept = [(r.file_create_time, r.data_source, r.url) for r in spark.read.parquet(raw).collect()]
    want = {(r[1], r[2], r[3]) for rows in crawls for r in rows}
    assert len(kept) == len(set(kept)) and set(kept) == want
    assert seen == [NOON, early]
    assert sorted(tuple(r) for r in spark.read.parquet(done).select("file_create_time", "n_sources").collect()) == [(early, 4), (NOON, 4)]


def test_stopped_job_is_started_again_and_a_finished_one_is_not(spark):
    land, raw, done = (scratch_path(spark, n) for n in ("land-test", "raw-test", "done-test"))
    for k in range(4):
        spark.createDataFrame(gate_rows(k), GATE_ROW).coalesce(1).write.parquet(f"{land}/f={k}")
    calls = []

    def job(t):
        calls.append(t)
        if len(calls) == 1:
            raise RuntimeError("stopped")

    def run():
        posts = spark.readStream.schema(GATE_ROW).option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
        streams.snapshot_gate_stream(spark, posts, raw, done, on_complete=job)

    with pytest.raises(Exception, match="stopped"):
        run()
    run()
    run()
    assert calls == [NOON, NOON]
    assert spark.read.parquet(raw).count() == 20


def test_chained_stages_after_a_stop_give_the_same_table(spark):
    """Two committed stages; the second is stopped between its write and its commit, and in the
    middle of a batch; replayed batches are read once by the next stage."""
    land, one, two = (scratch_path(spark, n) for n in ("land-test", "one-test", "two-test"))
    for k in range(4):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.parquet(f"{land}/f={k}")
    schema = T.StructType([T.StructField("id", T.LongType())])
    runs = []

    def fragile(df):
        runs.append(1)
        if len(runs) == 2:
            raise RuntimeError("stopped")
        return df.withColumn("x", F.col("id") * 2)

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
        streams.committed_stage_stream(spark, src, fragile, one)

    with pytest.raises(Exception, match="stopped"):
        run()
    # the batch that was committed is offered again by a checkpoint that forgot it
    run()
    streams.committed_stage_stream(spark, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{land}/*"), fragile, one, checkpoint=scratch_path(spark, "cp"))
    wide = T.StructType([*schema.fields, T.StructField("x", T.LongType())])
    for _ in range(2):
        streams.committed_stage_stream(spark, streams.stage_files(spark, one, wide, 1), lambda df: df.withColumn("y", F.col("x") + 1), two)
    assert sorted(tuple(r) for r in spark.read.parquet(two).select("id", "x", "y").collect()) == [(i, 2 * i, 2 * i + 1) for i in range(40)]


def test_model_versions(spark):
    root = scratch_path(spark, "model-test")
    with pytest.raises(ValueError, match="no model"):
        streams.latest_model(spark, root, "id long")
    assert [streams.publish_model(spark.range(n), root) for n in (3, 5)] == [1, 2]
    model, version = streams.latest_model(spark, root, "id long")
    assert version == 2 and model.count() == 5


def test_raw_files_to_alerts_for_two_hours(spark):
    """Raw posts of two snapshots of a day through the whole job, the first one twice."""

    def scorer(docs, key, text):
        return docs.select(key, F.lit(0.25).alias("p_clean"))

    posts = fx.site_posts(spark, SF_SMALL).withColumn("url", F.concat(F.lit("u"), F.col("doc_id").cast("string"))).drop("doc_id")
    posts = posts.withColumn("snapshot_key", F.when(F.xxhash64("url") % 2 == 0, "2030-01-01T10-07-00").otherwise("2030-01-01T11-07-00"))
    src, out = scratch_path(spark, "raw-files"), scratch_path(spark, "wh-raw")
    files.write_posts_jsonl(posts.withColumn("author", F.lit("a")), src)
    past = fx.past_issue(spark, SF_SMALL)
    for key in ("2030-01-01T10-07-00", "2030-01-01T11-07-00", "2030-01-01T10-07-00"):
        paths = pipeline.run_raw_snapshot(spark, src, key, past, out, scorer, "m", graph_issue="error")
    total = posts.count()
    raw = spark.read.parquet(paths["raw_data"])
    assert raw.count() + spark.read.parquet(f"{out}/quarantine").count() == total
    assert {r["snapshot_hour"] for r in raw.select("snapshot_hour").distinct().collect()} == {10, 11}
    assert raw.where("abs(sentiment - 0.75) > 1e-6 or size(keywords) > 5").count() == 0
    cur = spark.read.parquet(paths["current_issue"])
    ten = raw.where("snapshot_hour = 10")
    assert cur.where("viewed > 0").select("created_at").distinct().count() <= 2
    per_keyword = ten.select(F.explode("keywords").alias("current_keyword"), "viewed").groupBy("current_keyword").agg(F.sum("viewed").alias("v"))
    at_ten = cur.where(F.col("created_at") == F.lit("2030-01-01 10:00:00").cast("timestamp"))
    assert at_ten.join(per_keyword, "current_keyword").where("viewed <> v").count() == 0
    assert spark.read.parquet(paths["raw_data_view"]).count() == raw.select(F.explode("keywords")).count()
    assert spark.read.parquet(paths["keyword_frequency"]).count() == cur.select("current_keyword").distinct().count()
    assert spark.read.parquet(paths["alerts"]).count() == 1


def test_model_is_stamped_from_the_file_name(spark):
    """Crawler files of two models a source: each post carries its file's model to raw_data."""

    def scorer(docs, key, text):
        return docs.select(key, F.lit(0.25).alias("p_clean"))

    key, src = "2030-01-01T10-07-00", scratch_path(spark, "crawled")
    posts = fx.site_posts(spark, SF_SMALL).withColumn("url", F.concat(F.lit("u"), F.col("doc_id").cast("string"))).limit(60)
    expected = {}
    for r in posts.collect():
        model = "아이오닉6" if r["doc_id"] % 2 else "kona_ev"
        expected[r["url"]] = model
        folder = pathlib.Path(src.removeprefix("file:")) / f"snapshot_key={key}" / f"data_source={r['data_source']}"
        folder.mkdir(parents=True, exist_ok=True)
        post = {k: v for k, v in r.asDict().items() if k in files.RAW_POST.names}
        with open(folder / f"{r['data_source']}_{model}_{key}.jsonl", "a", encoding="utf-8") as out:
            out.write(json.dumps(post, ensure_ascii=False) + "\n")
    got, broken = files.read_snapshot_lines(spark, src, key, with_model=True)
    assert broken.count() == 0
    assert {r["url"]: r["model"] for r in got.select("url", "model").collect()} == expected
    assert "model" not in files.read_snapshot(spark, src, key).columns
    batch, _ = pipeline.prepare_posts(got, F.lit("2030-01-01 10:07:00").cast("timestamp"), scorer)
    stamped = {r["url"]: r["model"] for r in batch.select("url", "model").collect()}
    assert stamped and all(expected[u] == m for u, m in stamped.items()) and len(set(stamped.values())) == 2


def test_similar_pairs_above_a_threshold(spark):
    s = fx.sparse_series(spark, 5, 60)
    pts = similarity.series_points(s, "name", "created_at", "value")
    past = pts.withColumnRenamed("name", "past_issue_name")
    every = {tuple(r)[:2]: r[2] for r in similarity.series_similarity(pts, past, cur_key="name", exact=True).collect()}
    some = {tuple(r)[:2]: r[2] for r in similarity.series_similarity(pts, past, cur_key="name", exact=True, min_similarity=0.5).collect()}
    assert some == {k: v for k, v in every.items() if v >= 0.5} and 0 < len(some)
    assert len(set(every.values())) > 5 and min(every.values()) > 0


def test_bounded_top_alerts_equal_all_pairs(spark):
    """Curves in groups of like shape, of very different frequency; empty and one-point ones."""
    draw = random.Random(2)
    rows = []
    for c in range(60):
        hours = sorted(draw.sample(range(400), draw.randrange(2, 30) if c > 3 else c % 2))
        for h in hours:
            rows.append((f"k{c:02}", h + 300 * (c % 5), float(draw.randrange(1, 50)) * 10 ** (c % 4)))
    points = [(k, float(sum(v for x, _, v in rows if x == k))) for k in sorted({f"k{c:02}" for c in range(60)})]
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame(rows, "k string, h int, value double").select("k", F.timestamp_add("HOUR", F.col("h"), t0).alias("t"), "value")
    cur = similarity.series_points(df, "k", "t", "value", origin=t0)
    empty = spark.createDataFrame([(k, 0, [], []) for k, n in points if not n], cur.schema)
    cur = cur.unionByName(empty).withColumnRenamed("k", "current_keyword")
    freq = spark.createDataFrame([(k, math.log1p(n)) for k, n in points], "current_keyword string, total_frequency double")
    past = cur.where("current_keyword < 'k12'").withColumnRenamed("current_keyword", "past_issue_name")
    for exact, k in ((True, 1), (True, 25), (False, 3), (True, 1000)):
        every = similarity.series_similarity(cur, past, exact=exact)
        want = alerts.top_alerts(alerts.alert_table(freq, every), k).collect()
        got = similarity.top_alerts_bounded(cur, past, freq, k, exact=exact, first_pairs=24)
        assert [(r.current_keyword, r.past_issue_name) for r in got.alerts.collect()] == [(r.current_keyword, r.past_issue_name) for r in want]
        assert got.all_pairs == 720 and (k == 1000 or got.kernel_pairs < 400)
    none = similarity.top_alerts_bounded(cur, past.limit(0), freq, 2).alerts.collect()
    assert [r.alert_value for r in none] == [None, None]


def test_envelope_bound_is_below_the_distance(spark):
    draw = random.Random(8)
    rows = [(f"s{c}", sorted(draw.sample(range(200), draw.randrange(1, 40)))) for c in range(30)]
    points = spark.createDataFrame([(k, t, [draw.gauss(0, 1) for _ in t]) for k, t in rows], "k string, idx array<int>, z array<double>")
    got = similarity.with_envelope(points).collect()
    tight = 0
    for a in got:
        for b in got:
            low = similarity.envelope_bound(*(np.array(x.boxes).reshape(-1, 5) for x in (a, b)))
            d = dtw.series_distance(a.idx, a.z, b.idx, b.z, exact=True)
            assert low <= d + 1e-9
            tight += low > d / 2
    assert tight > 300


def test_issue_graph_of_ragged_curves(spark):
    """Gaps, curves of different hours, repeated hours and rows off the full hour: as the plain join."""
    draw = random.Random(6)
    hour = lambda h: dt.datetime(2024, 3, 1) + dt.timedelta(hours=h)
    past = [(f"p{i}", hour(draw.randrange(40) + 7 * i) + dt.timedelta(minutes=30 * (draw.random() < 0.1)), float(j)) for i in range(3) for j in range(30)]
    cur = [(hour(draw.randrange(60)), f"c{i}", float(j)) for i in range(4) for j in range(40)] + [(hour(0), "c0", -1.0)]
    p = spark.createDataFrame(past, "past_issue_name string, created_at timestamp, past_issueization double")
    c = spark.createDataFrame(cur, "created_at timestamp, current_keyword string, current_issueization double")
    now = F.lit("2024-05-01 03:10:00").cast("timestamp")
    for origin in (None, "p1"):
        got = views.issue_graph(p, c, now, origin)
        anchor = dt.datetime(2024, 3, 1, 3)
        first = {n: min(t for m, t, _ in past if m == (origin or n)) for n in ("p0", "p1", "p2")}
        start = min(t for t, _, _ in cur)
        want = [(t - first[n] + anchor, n, x, k, y) for n, t, x in past for u, k, y in cur if t - first[n] == u - start]
        assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want
        assert got.columns == ["created_at", "past_issue_name", "past_issueization", "current_keyword", "current_issueization"]
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert joins and not any("created_at" in x for x in joins)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_dense_curves_are_the_grid_with_the_facts(spark):
    """Facts on the first, a middle and the last hour, missing sums, keywords without any."""
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [(at(0), "a", 1, 2, 3, 0.5), (at(7), "a", None, 2, None, float("nan")), (at(30), "a", 4, 5, 6, 1.0), (at(3), "b", 1, 1, 1, None), (at(4), "b", 2, 2, 2, 2.0), (at(5), "gone", 1, 1, 1, 1.0)]
    facts = spark.createDataFrame(rows, "created_at timestamp, current_keyword string, num_of_comments long, viewed long, liked long, sentiment double")
    keywords = spark.createDataFrame([("a",), ("b",), ("none",), (None,)], "current_keyword string")
    start, end = F.lit(at(0)), F.lit(at(30) + dt.timedelta(minutes=7))
    known = issues.join_active_keywords(facts, keywords)
    got = issues.dense_curves(keywords, known, start, end)
    want = issues.densify(issues.hour_grid(keywords, start, end), known)
    assert got.schema.names == want.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    key = lambda r: (r["current_keyword"] or "", r["created_at"])
    found = got.collect()
    assert sorted(map(tuple, found), key=lambda r: (r[1] or "", r[0])) == sorted(map(tuple, want.collect()), key=lambda r: (r[1] or "", r[0])) and len(found) == 4 * 31
    runs = [[key(r) for r in part] for part in got.rdd.glom().collect()]
    assert all(part == sorted(part) for part in runs)
    # the hours are laid out behind the last exchange: none of them is shuffled or sorted
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [next((w for w in ("Exchange", "Sort ", "Generate") if w in line), None) for line in plan]
    assert [s for s in steps if s][:3] == ["Generate", "Generate", "Sort "]


def test_issue_graph_of_few_and_many_past_rows_is_the_same(spark, monkeypatch):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, tzinfo=None) + dt.timedelta(hours=h, minutes=m)
    past = spark.createDataFrame([(n, at(h, m), float(h)) for n in ("p", "q") for h, m in ((5, 0), (6, 0), (6, 0), (9, 30), (12, 0))], "past_issue_name string, created_at timestamp, past_issueization double")
    cur = spark.createDataFrame([(k, at(h, m), h) for k in ("a", "b") for h, m in ((40, 0), (41, 0), (41, 0), (44, 30), (60, 0))], "current_keyword string, created_at timestamp, current_issueization int")
    now = F.lit(at(100))
    few = views.issue_graph(past, cur, now)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(views, "MAX_BROADCAST_ROWS", 0)
    many = views.issue_graph(past, cur, now)
    assert few.schema.names == many.schema.names
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 24
    assert "c_cells" not in plan  # the current rows are not packed


def test_job_keeps_no_shuffle_files_and_scratch(spark):
    """A run leaves the shuffle files of none of its steps behind, and the caller's setting."""

    def scorer(docs, key, text):
        return docs.select(key, F.lit(0.25).alias("p_clean"))

    def shuffles():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {str(x) for x in manager.getAllBlocks().mkString(" ").split() if "shuffle_" in str(x)}

    posts = fx.site_posts(spark, SF_SMALL).withColumn("url", F.concat(F.lit("u"), F.col("doc_id").cast("string"))).where("doc_id < 300").drop("doc_id")
    key, src, out = "2030-01-01T10-07-00", scratch_path(spark, "raw-files"), scratch_path(spark, "wh-raw")
    files.write_posts_jsonl(posts.withColumns({"author": F.lit("a"), "snapshot_key": F.lit(key)}), src, compression="gzip")
    past, before = fx.past_issue(spark, SF_SMALL), spark.conf.get(SHUFFLE_CLEANUP, None)
    old = shuffles()
    paths = pipeline.run_raw_snapshot(spark, src, key, past, out, scorer, "m", graph_issue="error")
    assert shuffles() <= old
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert not [f for f in files.folders(spark, ensure_checkpoint_dir(spark) + "/posts-*")]
    assert spark.read.parquet(paths["raw_data"]).count() + spark.read.parquet(f"{out}/quarantine").count() == posts.count()
