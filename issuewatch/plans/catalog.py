"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables; queries over files, streams and iterations write those when called. Names match `oracle.SQL` where a SQL oracle exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import issues
from ..functions.scoring import issue_score
from ..sources.tables import read_table
from . import fixtures as fx
from .common import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _current_issue(spark: SparkSession, root: str) -> DataFrame:
    posts = fx.kw_posts(spark, root)
    snap = fx.snapshot_time(posts)
    return issues.current_issue(posts, fx.current_batch(posts, snap), snap)


@query("keyword_hour_issue")
def q_keyword_hour_issue(spark, root):
    return round_doubles(issues.keyword_hour_issue(fx.kw_posts(spark, root)))


@query("dense_keyword_issue")
def q_dense_keyword_issue(spark, root):
    return round_doubles(_current_issue(spark, root))


@query("dense_keyword_issue_offhour")
def q_dense_keyword_issue_offhour(spark, root):
    """Snapshots taken off the full hour count for their hour."""
    posts = fx.off_hour_posts(spark, root)
    snap = fx.snapshot_time(posts)
    return round_doubles(issues.current_issue(posts, fx.current_batch(posts, snap), snap))


@query("dense_keyword_issue_from_sums")
def q_dense_keyword_issue_from_sums(spark, root):
    """A1 + P6 from the stored sums: the earlier snapshots' sums are written once, the newest
    batch's are appended (twice, as after a replay), and the window adds up the table."""
    from . import pipeline

    posts = fx.kw_posts(spark, root)
    snap = fx.snapshot_time(posts)
    batch = fx.current_batch(posts, snap)
    raw, sums = scratch_path(spark, "raw-data"), scratch_path(spark, "snapshot-sums")
    earlier = posts.join(batch.select("event_id"), "event_id", "left_anti")
    earlier.write.parquet(raw)
    for _ in range(3):  # the first call writes the sums of the earlier snapshots
        table = pipeline.append_sums(spark, batch, snap, raw, sums)
    return round_doubles(issues.current_issue_from_sums(table, batch, snap))


@query("keyword_frequency")
def q_keyword_frequency(spark, root):
    return round_doubles(issues.keyword_frequency(_current_issue(spark, root)))


@query("keyword_frequency_log")
def q_keyword_frequency_log(spark, root):
    return round_doubles(issues.total_frequency(_current_issue(spark, root)))


# --- similarity, views, alert -------------------------------------------------------

from ..operators import alerts, similarity, views  # noqa: E402


@query("series_per_keyword")
def q_series_per_keyword(spark, root):
    cur = _current_issue(spark, root)
    pts = similarity.series_points(cur, "current_keyword", "created_at", "current_issueization")
    return round_doubles(pts.withColumn("n_points", F.col("n_points").cast("bigint")))


def _curves(spark, root):
    cur = _current_issue(spark, root)
    past = fx.past_issue(spark, root)
    cp = similarity.series_points(cur, "current_keyword", "created_at", "current_issueization")
    pp = similarity.series_points(past, "past_issue_name", "created_at", "past_issueization")
    return cur, cp, pp


@query("series_similarity")
def q_series_similarity(spark, root):
    _, cp, pp = _curves(spark, root)
    return similarity.series_similarity(cp, pp)


@query("series_similarity_exact")
def q_series_similarity_exact(spark, root):
    """U2 with the exact distance, which is returned too (similarities of long curves are tiny)."""
    _, cp, pp = _curves(spark, root)
    return round_doubles(similarity.series_similarity(cp, pp, exact=True, with_distance=True))


@query("top_alerts_exact")
def q_top_alerts_exact(spark, root):
    """J5 + T2: the eight highest alerts by exact distances, found by bounds without the pair table."""
    cur, cp, pp = _curves(spark, root)
    found = similarity.top_alerts_bounded(cp, pp, issues.total_frequency(cur), 8, exact=True).alerts
    distance = -F.log("similarity_degree") * similarity.SIMILARITY_SCALE
    return round_doubles(found.select("current_keyword", "past_issue_name", "total_frequency", distance.alias("dtw_distance")))


@query("issue_graph")
def q_issue_graph(spark, root):
    posts = fx.kw_posts(spark, root)
    snap = fx.snapshot_time(posts)
    cur = issues.current_issue(posts, fx.current_batch(posts, snap), snap)
    g = views.issue_graph(fx.past_issue(spark, root), cur, snap, origin_issue=fx.PAST_ISSUE_TYPES[0])
    return round_doubles(g)


@query("top_alert")
def q_top_alert(spark, root):
    cur, cp, pp = _curves(spark, root)
    return alerts.alert_message(similarity.top_alerts_bounded(cp, pp, issues.total_frequency(cur), 1).alerts)


FLAGSHIP = "top_alert"


# --- text, numbers, dates -------------------------------------------------------------

from ..functions import dates, numbers, text  # noqa: E402
from ..operators import normalise  # noqa: E402


@query("clean_text")
def q_clean_text(spark, root):
    d = fx.raw_docs(spark, root)
    return d.select("doc_id", text.clean_content("content", "naver", unescape=False, normalise=False).alias("content"))


@query("clean_text_dc")
def q_clean_text_dc(spark, root):
    d = fx.raw_docs(spark, root)
    return d.select("doc_id", text.clean_content("content", "dc", unescape=False, normalise=False).alias("content"))


@query("clean_text_full")
def q_clean_text_full(spark, root):
    return normalise.clean_by_source(fx.raw_docs(spark, root), "content").select("doc_id", "data_source", "content")


@query("clean_titles")
def q_clean_titles(spark, root):
    p = fx.raw_pages(spark, root).select("page_id", "data_source", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    return normalise.clean_titles(p).select("page_id", "data_source", "title")


NORMALISE_SNAPSHOT = "2030-01-01 00:00:00"


def _normalise(raw):
    return normalise.normalise_posts(raw, F.lit(NORMALISE_SNAPSHOT).cast("timestamp"))


def _formatted(good):
    last = F.to_timestamp(cm.last_valid_comment_time(F.col("comments")))
    return good.select("doc_id", "data_source", "title", "content", "created_at", "viewed", "liked", "num_of_comments", last.alias("last_comment_at"))


@query("normalise_posts")
def q_normalise_posts(spark, root):
    """The formatter over all four sources: cleaned texts, parsed dates and counts."""
    return _formatted(_normalise(fx.site_posts(spark, root))[0])


@query("normalise_quarantine")
def q_normalise_quarantine(spark, root):
    """The rows that the formatter refuses, raw, with the reason."""
    _, bad = _normalise(fx.site_posts(spark, root))
    return bad.select("doc_id", "data_source", "created_at", "viewed", "reason")


@query("parse_counts")
def q_parse_counts(spark, root):
    c = fx.site_counts(spark, root)
    return c.select("p_partkey", "count_text", numbers.korean_number(text.strip_view_prefix("count_text")).alias("n"))


@query("parse_dates")
def q_parse_dates(spark, root):
    d = fx.site_dates(spark, root)
    snap = d.select(F.max("o_orderdate")).scalar().cast("timestamp")
    t = dates.parse_post_date("date_text", F.col("data_source"), snap)
    return d.select("o_orderkey", "data_source", "date_text", t.alias("created_at"), dates.format_ts(t).alias("created_text"))


@query("split_modified")
def q_split_modified(spark, root):
    o = read_orders(spark, root)
    k = F.col("o_orderkey")
    base = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = F.when(k % 3 == 0, F.concat(base, F.lit(" 수정일 : "), F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd HH:mm:ss"))).otherwise(base)
    c, m = text.split_created_modified(raw)
    return o.select("o_orderkey", c.alias("created_at"), m.alias("modified_at"))


@query("label_value")
def q_label_value(spark, root):
    o = read_orders(spark, root)
    lab = F.concat(F.lit("조회 "), F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", lab.alias("label_text"), text.second_token(lab).alias("value"))


@query("shift_zone")
def q_shift_zone(spark, root):
    e = read_table(spark, root, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), dates.to_local(F.col("ts").cast("timestamp")).alias("local_ts"))


@query("text_concat")
def q_text_concat(spark, root):
    c = read_table(spark, root, "conversations")
    return c.select("conv_id", "turn", text.newlines_to_blank(text.concat_title_content("role", "text")).alias("scoring_text"))


def read_orders(spark, root):
    return read_table(spark, root, "orders")


# --- comments and threads ---------------------------------------------------------------

from ..operators import comments as cm  # noqa: E402


@query("comment_threads")
def q_comment_threads(spark, root):
    t = cm.assemble_threads(fx.thread_items(spark, root))
    r = cm.thread_reply_counts(t.select("post", "pos", "role", "is_reply", "thread_pos", "is_parent"))
    return r.select(F.col("post").alias("conv_id"), "thread_pos", "role", F.col("reply_count").cast("bigint").alias("reply_count"))


@query("nested_threads")
def q_nested_threads(spark, root):
    """Each thread's replies nested in order, here at most two to a row."""
    t = cm.nested_threads(fx.thread_items(spark, root), chunk=2)
    children = F.transform("children", lambda c: F.concat_ws(":", c["pos"], c["role"], F.length(c["text"])))
    return t.select(F.col("post").alias("conv_id"), "thread_pos", "chunk_no", "n_chunks", "parent.role", children.alias("children"))


@query("threads_by_count")
def q_threads_by_count(spark, root):
    it = fx.thread_items(spark, root).withColumn("num_of_comments", F.when(F.col("role") == "user", F.length("text") % 3).otherwise(0))
    w = cm.replies_from_next(it, "post", "pos", "num_of_comments", "text")
    return w.filter(~F.col("is_reply")).select(F.col("post").alias("conv_id"), F.col("pos").alias("turn"), "role", "num_of_comments", "reply_pos", "replies")


def _parsed_posts(spark, root):
    rt = fx.raw_threads(spark, root)
    src = F.col("data_source")
    snap = F.lit("2030-01-01 00:00:00").cast("timestamp")
    posts = rt.select("doc_id", "data_source", "content", "created_at", "viewed", "liked", cm.normalise_comments(F.col("comments_json")).alias("comments"))
    return posts, (lambda c: dates.parse_post_date(c, src, snap))


def _post_comment_rows(spark, root):
    """Title and content joined, every text cleaned by its site's chain; dc and naver
    posts carry their own number of comments."""
    posts, parse = _parsed_posts(spark, root)
    src = F.col("data_source")
    posts = posts.withColumn("content", text.concat_title_content(F.concat(F.lit("제목 "), F.col("doc_id").cast("string")), "content"))
    count = F.when(src.isin("dc", "naver"), F.col("doc_id") % 11).otherwise(cm.comment_count(F.col("comments")))
    rows = cm.post_comment_rows(posts, "doc_id", parse, count, keep=("data_source",))
    return normalise.clean_by_source(rows, "content").drop("data_source")


@query("post_comment_rows")
def q_post_comment_rows(spark, root):
    return round_doubles(_post_comment_rows(spark, root))


@query("post_comment_csv")
def q_post_comment_csv(spark, root):
    """The 7-column file written and read back."""
    out = scratch_path(spark, "post-comment-csv")
    fl.write_post_comment_csv(round_doubles(_post_comment_rows(spark, root)), out)
    kinds = "content string, created_at timestamp, viewed int, liked int, post_type int, num_of_comments int, seconds_per_comment double"
    return spark.read.schema(kinds).option("header", True).csv(out)


@query("seconds_per_comment")
def q_seconds_per_comment(spark, root):
    posts, parse = _parsed_posts(spark, root)
    posts = posts.withColumn("comments", cm.rewrite_comment_times(F.col("comments"), parse))
    n = cm.comment_count(F.col("comments"))
    last = F.to_timestamp(cm.last_valid_comment_time(F.col("comments")))
    return round_doubles(
        posts.select(
            "doc_id",
            n.cast("int").alias("num_of_comments"),
            last.alias("last_comment_at"),
            cm.seconds_per_comment(F.col("created_at"), last, n).alias("seconds_per_comment"),
        )
    )


# --- sources, sinks, projections ------------------------------------------------------

from ..sources import files as fl  # noqa: E402
from ..session import scratch_path  # noqa: E402


def _parsed_files(spark, root):
    f = fx.file_list(spark, root)
    m = fl.parse_file_meta(F.col("key"))
    return f.select("key", "file_mtime", *[v.alias(k) for k, v in m.items()])


@query("file_meta")
def q_file_meta(spark, root):
    return _parsed_files(spark, root).select("key", "file_name", "data_source", "model", "snapshot")


@query("newest_files")
def q_newest_files(spark, root):
    return fl.newest_files(_parsed_files(spark, root), 4).select("snapshot", "file_name", "file_mtime")


@query("latest_complete_snapshot")
def q_latest_complete_snapshot(spark, root):
    files = _parsed_files(spark, root)
    latest = fl.latest_snapshot(files)
    c = fl.complete_snapshots(files, 4)
    return c.select("snapshot", F.col("n_sources").cast("bigint").alias("n_sources"), "is_complete", (F.col("snapshot") == latest).alias("is_latest"))


@query("dedupe_snapshot")
def q_dedupe_snapshot(spark, root):
    p = fx.kw_posts(spark, root).select("file_create_time", "data_source", "url", "event_id", "viewed")
    return fl.dedupe_by_url(p, ["file_create_time", "data_source"], ["viewed", "event_id"])


@query("union_sources")
def q_union_sources(spark, root):
    """X1 over one folder per source, as the crawlers write them: each has its own column
    order, clien an extra column, naver one column less."""
    p = fx.kw_posts(spark, root)
    cols = ["event_id", "url", "created_at", "data_source", "keywords", "viewed", "liked", "num_of_comments", "sentiment"]
    out = scratch_path(spark, "per-source")
    p.select(*cols).write.partitionBy("data_source").parquet(out)
    parts = []
    for i, s in enumerate(fx.SOURCES):
        part = spark.read.parquet(f"{out}/data_source={s}").withColumn("data_source", F.lit(s)).select(*(cols[i:] + cols[:i]))
        if s == "clien":
            part = part.withColumn("modified_at", F.col("created_at").cast("string"))
        if s == "naver":
            part = part.drop("sentiment")
        parts.append(part)
    return round_doubles(fl.union_sources(parts).select(*cols))


def _raw_posts(spark, root):
    rt = fx.raw_threads(spark, root)
    comments = cm.normalise_comments(F.col("comments_json"))
    return rt.select(
        F.concat_ws(" ", "data_source", F.col("doc_id").cast("string")).alias("title"),
        "content",
        F.col("data_source").alias("author"),
        "created_at",
        "viewed",
        "liked",
        cm.comment_count(comments).alias("num_of_comments"),
        comments.alias("comments"),
        F.lit("doc").alias("model"),
        "data_source",
        F.array(F.col("data_source"), F.concat(F.lit("k"), (F.col("doc_id") % 7).cast("string"))).alias("keywords"),
        ((F.col("doc_id") % 100) / F.lit(100.0)).alias("sentiment"),
        F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("url"),
    )


@query("raw_data_projection")
def q_raw_data_projection(spark, root):
    return round_doubles(normalise.to_raw_data(_raw_posts(spark, root), F.lit("2024-02-01 00:00:00")))


@query("raw_data_view")
def q_raw_data_view(spark, root):
    raw = normalise.to_raw_data(_raw_posts(spark, root), F.lit("2024-02-01 00:00:00"))
    return round_doubles(normalise.raw_data_view(raw).select("url", "current_keyword", "content", "comments", "sentiment"))


@query("failed_post_filter")
def q_failed_post_filter(spark, root):
    d = fx.site_dates(spark, root)
    k = F.col("o_orderkey")
    d = d.withColumn("date_text", F.when(k % 13 == 0, F.lit(" ")).when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("date_text")))
    return fl.drop_failed_posts(d, "date_text").select("o_orderkey", "data_source", "date_text")


@query("listing_window")
def q_listing_window(spark, root):
    o = read_orders(spark, root)
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    src = F.element_at(F.array(F.lit("bobae"), F.lit("clien"), F.lit("naver")), (k % 3 + 1).cast("int"))
    txt = (
        F.when(k % 3 == 0, F.date_format(d, "yy. MM. dd"))
        .when(k % 3 == 1, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k % 5 == 0, F.lit("15:40"))
        .otherwise(F.date_format(d, "yyyy.MM.dd."))
    )
    start = o.select(F.max("o_orderdate")).scalar().cast("timestamp")
    items = o.select("o_orderkey", src.alias("data_source"), txt.alias("listing_text"))
    posted = dates.parse_listing_date(F.col("listing_text"), F.col("data_source"), start)
    items = items.withColumn("posted_date", posted)
    return items.filter(dates.in_listing_window(F.col("posted_date"), start, 30)).withColumn("look_back", dates.look_back_date(start, 30))


@query("keywords_json_roundtrip")
def q_keywords_json_roundtrip(spark, root):
    p = fx.kw_posts(spark, root)
    j = F.to_json("keywords")
    return p.select("event_id", j.alias("keywords_json"), F.from_json(j, "array<string>").alias("keywords"))


CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string, _corrupt_record string"


@query("tolerant_json")
def q_tolerant_json(spark, root):
    """S3: conversations written as JSON lines where some lines are cut short (broken)
    and some are `{}`; the tolerant read keeps every intact row, quarantines the broken
    ones and drops the empty records (P4)."""
    good, _ = _tolerant(spark, root)
    return fl.drop_failed_posts(good.withColumn("_k", F.col("conv_id").cast("string")), "_k").select("conv_id", "turn", "role", "text")


@query("tolerant_json_quarantine")
def q_tolerant_json_quarantine(spark, root):
    """The broken lines of the same files, by their text, or by their bytes where they are no UTF-8."""
    _, bad = _tolerant(spark, root)
    return bad.select(F.when(F.is_valid_utf8("_corrupt_record"), F.col("_corrupt_record")).otherwise(F.hex("raw")).alias("line"))


def _tolerant(spark, root):
    from pyspark.sql import types as T

    c = read_table(spark, root, "conversations")
    j = F.concat(F.lit('{"conv_id":'), F.col("conv_id").cast("string"), F.lit(',"turn":'), F.col("turn").cast("string"), F.lit(',"role":"'), F.col("role"), F.lit('","n":'), F.length("text").cast("string"), F.lit("}"))
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    cut = F.expr("substring(j, 1, length(j) - 3)")
    bytes_ = F.concat(F.expr("cast(substring(j, 1, length(j) - 1) as binary)"), F.lit(bytearray(b',"x":"\xff\xfe"}'))).cast("string")
    line = F.when(F.col("turn") % 9 == 4, cut).when(F.col("turn") % 11 == 7, F.lit("{}")).when(F.col("turn") % 13 == 6, bytes_).otherwise(F.col("whole"))
    out = scratch_path(spark, "tolerant-json")
    c.select(j.alias("j"), whole.alias("whole"), "turn").select(line.alias("value")).write.mode("overwrite").text(out)
    return fl.read_jsonl_tolerant(spark, out, T._parse_datatype_string(CONV_SCHEMA))


def _raw_post_lines(spark, root):
    p = fx.kw_posts(spark, root)
    return p.select(
        "event_id",
        F.col("event_type").alias("title"),
        F.concat(F.lit("value "), F.col("value").cast("string")).alias("content"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.when(F.col("data_source") == "clien", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).alias("modified_at"),
        F.col("viewed").cast("string").alias("viewed"),
        F.col("liked").cast("string").alias("liked"),
        F.col("num_of_comments").cast("string").alias("num_of_comments"),
        "url",
        "keywords",
        "sentiment",
        F.date_format("file_create_time", "yyyy-MM-dd'T'HH-mm-ss").alias("snapshot_key"),
        "data_source",
    )


@query("snapshot_read")
def q_snapshot_read(spark, root):
    """S5 -> S1: posts written as JSON lines per (snapshot, source) folder, then the
    newest snapshot read back (all its sources, failed rows dropped, url dedupe)."""
    out = scratch_path(spark, "posts-jsonl")
    fl.write_posts_jsonl(_raw_post_lines(spark, root).drop("event_id"), out)
    r = fl.read_snapshot(spark, out)
    return r.select("snapshot_key", "data_source", "url", "created_at", F.col("viewed").try_cast("bigint").alias("viewed"), "title")


@query("roundtrip_tables")
def q_roundtrip_tables(spark, root):
    """Posts appended to a Parquet table partitioned by snapshot date twice
    (a replayed batch), read back (no duplicates: dynamic partition overwrite), and
    written / read as CSV with a header."""
    p = fl.with_snapshot_partitions(fx.kw_posts(spark, root).select("event_id", "url", "data_source", "viewed", "file_create_time"), F.col("file_create_time"))
    tbl = scratch_path(spark, "raw-data")
    fl.write_table(p, tbl)
    fl.write_table(p, tbl)
    back = spark.read.parquet(tbl)
    csv = scratch_path(spark, "raw-data-csv")
    fl.write_csv(p, csv)
    cback = spark.read.option("header", True).csv(csv)
    a = back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("viewed").alias("sum_viewed"))
    b = cback.groupBy(F.to_date("snapshot_date").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("n_csv_rows"))
    return a.join(b, "snapshot_date", "full")


@query("raw_data_two_snapshots")
def q_raw_data_two_snapshots(spark, root):
    """Hourly batches of one day appended one after the other (even hours, odd hours,
    and the even ones again as a replay): no batch erases another's rows."""
    p = fl.with_snapshot_partitions(fx.kw_posts(spark, root).select("event_id", "url", "viewed", "file_create_time"), F.col("file_create_time"))
    tbl = scratch_path(spark, "raw-data-hours")
    for odd in (0, 1, 0):
        fl.write_table(p.where(F.col("snapshot_hour") % 2 == odd), tbl)
    back = spark.read.parquet(tbl)
    return back.groupBy("snapshot_date", "snapshot_hour").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("viewed").alias("sum_viewed"))


# --- page extraction ------------------------------------------------------------------

from ..operators import pages as pg  # noqa: E402
from ..operators import selectors  # noqa: E402


@query("page_posts")
def q_page_posts(spark, root):
    p = pg.extract_posts(fx.raw_pages(spark, root))
    return p.select("page_id", "data_source", "title", "content", "author", "ok")


@query("site_page_posts")
def q_site_page_posts(spark, root):
    """H1 by the four sites' selectors: the fields of the post."""
    p = selectors.select_posts(fx.site_pages(spark, root))
    return p.select("doc_id", "data_source", *[f"post.{f}" for f in selectors.POST_FIELDS], F.size("post.comments").alias("n_rows"))


@query("site_page_comments")
def q_site_page_comments(spark, root):
    """H1 + H3 + P8 + W1 inside a page: the comments in order, each with its answers."""
    p = selectors.select_posts(fx.site_pages(spark, root)).select("doc_id", F.posexplode("post.comments").alias("pos", "c"))
    answers = F.array_join(F.transform("c.children", lambda r: F.concat_ws("/", r["author"], r["created_at"], r["content"])), "|")
    return p.select("doc_id", "pos", *[f"c.{f}" for f in ("author", "content", "created_at", "modified_at", "liked", "num_of_comments")], answers.alias("answers"))


@query("page_links")
def q_page_links(spark, root):
    return pg.extract_links(fx.raw_pages(spark, root))


@query("comment_defaults")
def q_comment_defaults(spark, root):
    c = read_table(spark, root, "conversations")
    items = c.select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 10 == 3, F.lit("ub-content us-post blocked"))
        .when(F.col("role") == "system", F.lit("ub-content notice"))
        .otherwise(F.lit("ub-content us-post"))
        .alias("class"),
        F.when(F.col("turn") % 7 != 5, F.concat(F.lit("n"), F.col("conv_id").cast("string"))).alias("author"),
        F.when(F.length("text") >= 40, F.col("text")).alias("content"),
        F.date_format(F.timestamp_add("MINUTE", F.col("conv_id") * 60 + F.col("turn"), F.lit("2024-01-01 00:00:00").cast("timestamp")), "yyyy.MM.dd HH:mm:ss").alias("created_at"),
    )
    return pg.comment_defaults(pg.unblocked_comments(pg.post_rows(items))).select("conv_id", "turn", "author", "content", "created_at")


# --- keywords ---------------------------------------------------------------------------

from ..operators import keywords as kw  # noqa: E402


EMBEDDING_DIM = 64  # width of the stored vectors


@query("mmr_keywords")
def q_mmr_keywords(spark, root):
    """U3a on stored embeddings: label = document, vec_id = candidate, document vector =
    mean of its candidates' vectors."""
    e = read_table(spark, root, "embeddings").select(F.col("label").alias("doc"), "vec_id", "embedding")
    dv = kw.mean_vectors(e, "doc", "embedding", dim=EMBEDDING_DIM)
    return kw.mmr(e, dv, "doc", "vec_id", "embedding").select("doc", F.col("rank").cast("int").alias("rank"), "vec_id")


@query("document_keywords")
def q_document_keywords(spark, root):
    d = read_table(spark, root, "documents")
    return kw.extract_keywords(d, "doc_id", "text").select("doc_id", F.col("rank").cast("int").alias("rank"), "keyword")


# --- sentiment ---------------------------------------------------------------------------

from ..operators import sentiment as st  # noqa: E402


def _sentiment(spark, root):
    d = read_table(spark, root, "documents").select("doc_id", "text", "source")
    labels = read_table(spark, root, "labels").select("doc_id", "toxic")
    return d, st.score_sentiment(d, "doc_id", "text", labels, "toxic")


@query("sentiment_score")
def q_sentiment_score(spark, root):
    return round_doubles(_sentiment(spark, root)[1])


@query("keyword_sentiment")
def q_keyword_sentiment(spark, root):
    d, s = _sentiment(spark, root)
    g = d.select("doc_id", F.col("source").alias("current_keyword")).join(s, "doc_id")
    return round_doubles(g.groupBy("current_keyword").agg(F.sum("sentiment").alias("sentiment"), F.count(F.lit(1)).alias("n_docs")))


# --- streaming ----------------------------------------------------------------------------

from ..streaming import streams as sm  # noqa: E402


def _event_files(spark, root):
    """events written as one parquet file per day into the shared scratch folder (the
    landing folder a crawler would fill)."""
    e = read_table(spark, root, "events")
    out = scratch_path(spark, "events-landing")
    e.withColumn("_day", F.to_date("ts")).hint("rebalance", "_day").write.partitionBy("_day").parquet(out)
    return out, e.schema


def _crawl_files(spark, root):
    """events as crawl files: file k of 12 holds every 12th post of all days, so that each
    file has posts of every snapshot, as crawls that look back do."""
    e = read_table(spark, root, "events")
    out = scratch_path(spark, "crawls-landing")
    e.withColumn("_crawl", F.pmod(F.xxhash64("event_id"), F.lit(12))).repartition("_crawl").write.partitionBy("_crawl").parquet(out)
    return out, e.schema


@query("stream_hour_issue")
def q_stream_hour_issue(spark, root):
    """R1 + R5: streaming hour sums over several micro-batches, merged on the way, equal the batch
    sums, open hours and late rows included; `closed` marks the hours that are final."""
    src, schema = _event_files(spark, root)
    source = sm.file_stream(spark, src, schema, MAX_FILES // 4)
    out = sm.hourly_issue_stream(spark, source, fx.posts_from_events, scratch_path(spark, "hourly"), compact_every=3)
    return round_doubles(sm.read_hourly_issue(spark, out))


MAX_FILES = 16  # landing files per micro-batch in the stream queries


def _gate(spark, root, **options):
    """Crawl files, several to a trigger, through the gate stream; every trigger has posts of all snapshots."""
    src, schema = _crawl_files(spark, root)
    posts = fx.posts_from_events(sm.file_stream(spark, src, schema, GATE_FILES), keep=("src_file_id",))
    raw, processed = scratch_path(spark, "raw"), scratch_path(spark, "processed")
    sm.snapshot_gate_stream(spark, posts, raw, processed, order=("created_at", "event_id"), **options)
    return raw, processed


GATE_FILES = 4  # crawl files per micro-batch of the gate


@query("stream_dedupe")
def q_stream_dedupe(spark, root):
    """The posts that the gate stream keeps over many triggers, one per (snapshot, source, url)."""
    raw, _ = _gate(spark, root)
    kept = spark.read.parquet(raw)
    return kept.groupBy(F.col("file_create_time").alias("snapshot"), "data_source", "url").agg(F.count(F.lit(1)).alias("n_rows"))


@query("stream_snapshot_gate")
def q_stream_snapshot_gate(spark, root):
    """R3 + S6 + S11 + R6: complete snapshots recorded once by the gate stream."""
    _, processed = _gate(spark, root)
    return spark.read.parquet(processed).select(F.col("file_create_time").alias("snapshot"), F.col("n_sources").cast("bigint").alias("n_sources"))


def _stage(df):
    ex = df.select("src_file_id", "event_id", F.explode("keywords").alias("current_keyword"), "file_create_time", "viewed", "liked", "num_of_comments")
    return ex.select("src_file_id", "event_id", "current_keyword", "file_create_time", issue_score("viewed", "liked", "num_of_comments").alias("current_issueization"))


@query("stream_stages")
def q_stream_stages(spark, root):
    """R2 + R4: the same landing files streamed twice (fresh checkpoints = a replay);
    the idempotent sink holds each row once."""
    src, schema = _event_files(spark, root)
    table = scratch_path(spark, "stage")
    for _ in range(2):
        posts = fx.posts_from_events(sm.file_stream(spark, src, schema), keep=("src_file_id",))
        sm.replayable_stage_stream(spark, posts, _stage, table, checkpoint=scratch_path(spark, "cp-stage"))
    return round_doubles(spark.read.parquet(table).drop("src_file_id"))


@query("stream_normalise")
def q_stream_normalise(spark, root):
    """R1 + R4: the formatter as a streamed stage over landed files, run twice (a replay)."""
    src, table = scratch_path(spark, "posts-landing"), scratch_path(spark, "formatted")
    raw = fx.site_posts(spark, root)
    raw.repartition(MAX_FILES).write.parquet(src)
    for _ in range(2):
        sm.replayable_stage_stream(spark, sm.file_stream(spark, src, raw.schema, MAX_FILES // 4), _normalise, table, checkpoint=scratch_path(spark, "cp-stage"))
    return _formatted(spark.read.parquet(table))


NB_MODEL = "token string, weight double"


def publish_naive_bayes(docs, labels, root):
    """The lexicon as a model table: one row a token, the prior in the row without one."""
    weights, prior = st.fit_naive_bayes(docs, "doc_id", "text", labels, "toxic")
    spark = docs.sparkSession
    sm.publish_model(weights.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("token"), prior.alias("weight"))), root)


def sentiment_stage(models):
    """R2: a batch of documents with the score of the newest model, whose version it carries."""

    def stage(df):
        model, version = sm.latest_model(df.sparkSession, models, NB_MODEL)
        prior = model.where("token is null").select("weight").scalar()
        scored = st.score_naive_bayes(df, "doc_id", "text", model.where("token is not null"), prior)
        rows = df.join(scored, "doc_id")
        return rows.withColumn("sentiment", F.lit(1.0) - F.col("p_clean")).withColumn("model_version", F.lit(version))

    return stage


def keyword_stage(df):
    """R2: a batch of scored documents with their keywords, in rank order."""
    found = kw.extract_keywords(df, "doc_id", "text")
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda x: x["keyword"])  # at most five
    return df.join(found.groupBy("doc_id").agg(ranked.alias("keywords")), "doc_id", "left")


STAGE_TRIGGERS = 2  # micro-batches in which a stage reads what the one before it wrote


def files_a_trigger(done):
    """So many of a stage's files a trigger that the number of triggers does not grow with them."""
    return max(2, -(-len(done.inputFiles()) // STAGE_TRIGGERS))


def _staged(spark, root, chain):
    """Documents in landing files through the first stages of a chain, several files a trigger;
    a stage's folder is the source of the next one, which takes the same share of its files
    with each trigger, however many they are, so that a trigger's work spreads as the files do."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    landing, models = scratch_path(spark, "docs-landing"), scratch_path(spark, "models")
    docs.repartition(MAX_FILES).write.parquet(landing)
    publish_naive_bayes(docs, read_table(spark, root, "labels").select("doc_id", "toxic"), models)
    source = sm.file_stream(spark, landing, docs.schema, MAX_FILES // 4).drop("src_file_id")
    for stage in (sentiment_stage(models), keyword_stage)[:chain]:
        out = scratch_path(spark, "stage")
        sm.committed_stage_stream(spark, source, stage, out)
        done = spark.read.parquet(out).drop("batch_id")
        source = sm.stage_files(spark, out, done.schema, files_a_trigger(done))
    return done


@query("stream_sentiment")
def q_stream_sentiment(spark, root):
    """R2: scoring as a streamed stage with a versioned model, equal to the batch scores."""
    return round_doubles(_staged(spark, root, 1).select("doc_id", "p_clean", "sentiment"))


@query("stream_keywords")
def q_stream_keywords(spark, root):
    """R2: keywords as the stage behind scoring, read from that stage's folder."""
    each = _staged(spark, root, 2).select("doc_id", F.posexplode("keywords").alias("rank", "keyword"))
    return each.select("doc_id", (F.col("rank") + 1).alias("rank"), "keyword")


@query("stream_alert")
def q_stream_alert(spark, root):
    """R1 + R3: crawls arrive one after the other; the gate starts the whole job for the newest
    snapshot once its four sources are there, on what it has stored; returns the written
    alert. The last crawls are those of the newest snapshot that all sources deliver."""
    from . import pipeline

    e = read_table(spark, root, "events")
    hour = F.date_trunc("hour", "ts")
    sources = e.groupBy(hour.alias("h")).agg(F.count_distinct(F.col("event_id") % 4).alias("n")).where("n = 4")
    newest = sources.agg(F.max("h")).first()[0]
    e = e.where(hour <= F.lit(newest))
    landing, raw, done, out = (scratch_path(spark, n) for n in ("crawls", "raw", "processed", "warehouse"))
    past = fx.past_issue_between(fx.posts_from_events(e), *issues.window_bounds(F.lit(newest).cast("timestamp")))

    def job(t):
        if t < newest:
            return
        snap = F.lit(t).cast("timestamp")
        posts = spark.read.parquet(raw).drop("snapshot_date", "batch")
        batch = fx.current_batch(posts, snap)
        history = posts.join(batch.select("event_id"), "event_id", "left_anti")
        pipeline.run_snapshot(spark, batch, history, past, snap, out, exact=True)

    last, late = hour == F.lit(newest), F.col("event_id") % 4 >= 2
    for k, crawl in enumerate((e.where(~last), e.where(last & ~late), e.where(last & late))):
        crawl.write.parquet(f"{landing}/crawl={k}")
        source = spark.readStream.schema(e.schema).parquet(f"{landing}/crawl=*")  # a trigger: the new crawl's files
        sm.snapshot_gate_stream(spark, fx.posts_from_events(source), raw, done, order=("created_at", "event_id"), on_complete=job, newest_only=True)
    return round_doubles(spark.read.parquet(f"{out}/alerts").select("current_keyword", "past_issue_name", "alert_value"))


@query("raw_snapshot_pipeline")
def q_raw_snapshot_pipeline(spark, root):
    """The whole job from raw posts on disk: read, format with quarantine, score, extract
    keywords, append, aggregate, compare, alert; returns the raw_data rows it appended."""
    from . import pipeline

    key = "2030-01-01T00-00-00"
    posts = fx.site_posts(spark, root).withColumn("url", F.concat(F.lit("d/"), F.col("doc_id").cast("string")))
    raw = scratch_path(spark, "raw-files")
    fl.write_posts_jsonl(posts.drop("doc_id").withColumns({"author": F.lit("a"), "snapshot_key": F.lit(key)}), raw, compression="gzip")
    score = lambda docs, key, text: docs.select(key, F.lit(0.25).alias("p_clean"))
    paths = pipeline.run_raw_snapshot(spark, raw, key, fx.past_issue(spark, root), scratch_path(spark, "warehouse"), score, "m", graph_issue="error")
    rows = spark.read.parquet(paths["raw_data"])
    return rows.select("url", "data_source", "title", "content", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "viewed", "liked", "num_of_comments", "model")


def _compacted(spark, root):
    """Messages in many small files, each 17th cut short, drained in several triggers."""
    from pyspark.sql import types as T

    msgs, aside = scratch_path(spark, "messages"), scratch_path(spark, "quarantine")
    lines = _raw_post_lines(spark, root)
    whole = F.to_json(F.struct(*[c for c in lines.columns if c != "event_id"]))
    cut = F.concat(F.lit('{"broken":"'), F.col("event_id").cast("string"))
    lines.select(F.when(F.col("event_id") % 17 == 3, cut).otherwise(whole).alias("value")).repartition(64).write.text(msgs)
    schema = T.StructType([f for f in fl.RAW_POST.fields if f.name != "_corrupt_record"] + [T.StructField("snapshot_key", T.StringType()), T.StructField("data_source", T.StringType())])
    out = sm.compact_messages_stream(spark, msgs, schema, scratch_path(spark, "compacted"), quarantine=aside, max_files=MAX_FILES)
    newest = lines.select(F.sort_array(F.collect_set("snapshot_key"), asc=False)).first()[0][:CLOSED_SNAPSHOTS]
    for key in newest:  # as the gate does for complete snapshots
        sm.compact_closed(spark, out, key)
    return sm.read_messages(spark, out, schema), spark.read.text(aside)


CLOSED_SNAPSHOTS = 2  # snapshots that the query gathers; the others are read as they arrived


@query("stream_compact")
def q_stream_compact(spark, root):
    """Message files compacted by a stream, in several micro-batches, into JSON-lines
    files per (snapshot, source); read back whole."""
    back, _ = _compacted(spark, root)
    return back.select("snapshot_key", "data_source", "url", "created_at", F.col("viewed").try_cast("bigint").alias("viewed"), "title")


@query("stream_compact_quarantine")
def q_stream_compact_quarantine(spark, root):
    """S6 + R4: the messages that are no posts, by their text."""
    _, aside = _compacted(spark, root)
    return aside.select("value")


@query("issue_pipeline")
def q_issue_pipeline(spark, root):
    """The whole hourly job on the newest snapshot (writes raw_data, current_issue,
    frequency, similarity and the alert); returns the written current_issue table."""
    from . import pipeline

    posts = fx.kw_posts(spark, root)
    snap = fx.snapshot_time(posts)
    batch = fx.current_batch(posts, snap)
    history = posts.join(batch.select("event_id"), "event_id", "left_anti")
    paths = pipeline.run_snapshot(spark, batch, history, fx.past_issue(spark, root), snap, scratch_path(spark, "warehouse"))
    return round_doubles(spark.read.parquet(paths["current_issue"]))
