"""Views derived from the driver tables (see FIXTURES.md section 2).

The driver tables are TPC-H-like; these views re-shape them into the post / issue /
comment shapes the pipeline works on. Every view is a lazy DataFrame over the whole
table, so its work grows with the data. The same views are written in DuckDB SQL in
`issuewatch.plans.oracle` for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

# The four community sources, in the order used to spread rows.
SOURCES = ["dc", "naver", "bobae", "clien"]


def source_by(key_col) -> F.Column:
    """data_source chosen by key % 4 over SOURCES."""
    return F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (F.col(key_col) % 4 + 1).cast("int"))


def kw_posts(spark: SparkSession, root: str) -> DataFrame:
    """events -> keyworded post rows (one row per event, snapshot = hour of ts)."""
    return posts_from_events(read_table(spark, root, "events"))


def posts_from_events(e: DataFrame, keep=()) -> DataFrame:
    """The kw_posts projection of an events DataFrame (batch or streaming)."""
    return e.select(
        *keep,
        F.col("event_id"),
        F.concat(F.lit("u/"), (F.col("event_id") % 500).cast("string")).alias("url"),
        F.date_trunc("hour", "ts").alias("file_create_time"),
        F.col("ts").cast("timestamp").alias("created_at"),
        source_by("event_id").alias("data_source"),
        F.array(F.col("event_type"), F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string"))).alias("keywords"),
        F.floor("value").cast("bigint").alias("viewed"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("liked"),
        (F.col("event_id") % 7).alias("num_of_comments"),
        ((F.col("event_id") % 100) / F.lit(100.0)).cast("double").alias("sentiment"),
        F.col("event_type"),
        F.col("user_id"),
        F.col("value"),
    )


def off_hour_posts(spark: SparkSession, root: str) -> DataFrame:
    """kw_posts whose snapshots are taken 7 minutes past the hour."""
    p = kw_posts(spark, root)
    return p.withColumn("file_create_time", F.col("file_create_time") + F.expr("INTERVAL 7 MINUTES"))


def snapshot_time(posts: DataFrame) -> F.Column:
    """The newest snapshot as a scalar subquery (the job parameter `recent_time`)."""
    return posts.select(F.max("file_create_time")).scalar()


def current_batch(posts: DataFrame, snapshot: F.Column, lookback_days: int = 2) -> DataFrame:
    """Posts of the current crawl: each run re-crawls the last `lookback_days` days."""
    return posts.filter(F.col("created_at") >= snapshot - F.make_interval(days=F.lit(lookback_days)))


# Fixed values for the past-issue fixture: the days and the keywords that are past issues.
PAST_ISSUE_TYPES = ["error", "purchase"]


def past_issue(spark: SparkSession, root: str, days: int = 62) -> DataFrame:
    """Past issue curves: each event type in turn stands for an issue of the past, over the
    same window as the current issues, one row per hour (zeros where no post)."""
    from ..operators.issues import window_bounds

    posts = kw_posts(spark, root)
    start, end = window_bounds(snapshot_time(posts), days)
    return past_issue_between(posts, start, end)


def past_issue_between(posts: DataFrame, start: F.Column, end: F.Column) -> DataFrame:
    from ..functions.scoring import issue_score

    sel = posts.filter(F.col("event_type").isin(PAST_ISSUE_TYPES) & F.col("file_create_time").between(start, end))
    facts = sel.groupBy(F.col("event_type").alias("past_issue_name"), F.col("file_create_time").alias("created_at")).agg(
        F.sum("viewed").alias("viewed"), F.sum("liked").alias("liked"), F.sum("num_of_comments").alias("c"), F.sum("sentiment").alias("s")
    )
    names = facts.select("past_issue_name").distinct()
    grid = names.select("past_issue_name", F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("created_at"))
    d = grid.join(facts, ["past_issue_name", "created_at"], "left").fillna(0, ["viewed", "liked", "c", "s"])
    return d.select(
        "past_issue_name",
        "created_at",
        issue_score("viewed", "liked", "c").alias("past_issueization"),
        F.col("s").cast("double").alias("past_sentiment"),
    )


def raw_docs(spark: SparkSession, root: str) -> DataFrame:
    """documents as post content; site by doc_id % 4 (per-source cleaning chain)."""
    d = read_table(spark, root, "documents")
    return d.select("doc_id", source_by("doc_id").alias("data_source"), F.col("text").alias("content"), "lang")


def raw_pages(spark: SparkSession, root: str) -> DataFrame:
    """pages with their site (page_id % 4)."""
    p = read_table(spark, root, "pages")
    return p.select("page_id", "url", "html", source_by("page_id").alias("data_source"))


def site_counts(spark: SparkSession, root: str) -> DataFrame:
    """part -> counts rendered as site text, by p_partkey % 4:
    `조회 <size>,345`, `<size>.<key % 10>천`, `<size>백만`, `<size>`."""
    p = read_table(spark, root, "part")
    k, s = F.col("p_partkey"), F.col("p_size").cast("string")
    txt = (
        F.when(k % 4 == 0, F.concat(F.lit("조회 "), s, F.lit(",345")))
        .when(k % 4 == 1, F.concat(s, F.lit("."), (k % 10).cast("string"), F.lit("천")))
        .when(k % 4 == 2, F.concat(s, F.lit("백만")))
        .otherwise(s)
    )
    return p.select("p_partkey", txt.alias("count_text"))


def site_dates(spark: SparkSession, root: str) -> DataFrame:
    """orders -> o_orderdate rendered in the four site layouts (source by o_orderkey % 4);
    dc and naver drop the year on every other row (o_orderkey % 8 in (0, 1))."""
    o = read_table(spark, root, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    txt = (
        F.when(k % 8 == 0, F.date_format(d, "MM.dd HH:mm:ss"))
        .when(k % 8 == 1, F.date_format(d, "MM.dd. HH:mm"))
        .when(k % 4 == 0, F.date_format(d, "yyyy.MM.dd HH:mm:ss"))
        .when(k % 4 == 1, F.date_format(d, "yyyy.MM.dd. HH:mm"))
        .when(k % 4 == 2, F.date_format(d, "yy.MM.dd  HH:mm"))
        .otherwise(F.date_format(d, "yyyy-MM-dd  HH:mm:ss"))
    )
    return o.select("o_orderkey", source_by("o_orderkey").alias("data_source"), txt.alias("date_text"), d.alias("o_orderdate"))


def thread_items(spark: SparkSession, root: str) -> DataFrame:
    """conversations as flat comment items: post = conv_id, pos = turn (list index),
    is_reply = assistant turn; system and user turns are parents."""
    c = read_table(spark, root, "conversations")
    return c.select(F.col("conv_id").alias("post"), F.col("turn").alias("pos"), "role", (F.col("role") == "assistant").alias("is_reply"), "text")


# Fixed values for the nested-comment fixture: comment k of a post is written k * 97
# minutes after the post; lines shorter than 20 characters stand for deleted comments.
COMMENT_STEP_MINUTES = 97
DELETED_BELOW_CHARS = 20
SITE_LAYOUTS = {"dc": "yyyy.MM.dd HH:mm:ss", "naver": "yyyy.MM.dd. HH:mm", "bobae": "yy.MM.dd  HH:mm", "clien": "yyyy-MM-dd  HH:mm:ss"}


def raw_threads(spark: SparkSession, root: str) -> DataFrame:
    """documents -> raw posts with nested comments as the crawlers write them.

    First line = post content, each further line = one comment (author `a<k>`, time in
    the site's layout, blank time for a deleted comment). bobae posts use the wrapped
    `{comment, children}` shape, the others the flat shape; single-line documents have
    `comments: null`. `comments_json` is the raw JSON text (input of C1). Per-row
    transformation only: no grouping is involved."""
    d = read_table(spark, root, "documents")
    src = source_by("doc_id")
    base = F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    lines = F.split(F.col("text"), "\n", -1)

    def fmt(t):
        return (
            F.when(src == "dc", F.date_format(t, SITE_LAYOUTS["dc"]))
            .when(src == "naver", F.date_format(t, SITE_LAYOUTS["naver"]))
            .when(src == "bobae", F.date_format(t, SITE_LAYOUTS["bobae"]))
            .otherwise(F.date_format(t, SITE_LAYOUTS["clien"]))
        )

    def one(line, i):
        k = i + 1
        t = F.timestamp_add("MINUTE", k * COMMENT_STEP_MINUTES, base)
        created = F.when(F.length(line) < DELETED_BELOW_CHARS, F.lit(" ")).otherwise(fmt(t))
        return F.struct(F.concat(F.lit("a"), k.cast("string")).alias("author"), line.alias("content"), created.alias("created_at"))

    flat = F.transform(F.slice(lines, 2, F.size(lines)), one)
    flat_json = F.to_json(F.transform(flat, lambda c: c.withField("num_of_comments", F.lit("0")).withField("children", F.array().cast("array<struct<author:string,content:string,created_at:string>>"))))
    wrapped_json = F.to_json(F.transform(flat, lambda c: F.struct(c.alias("comment"), F.array().cast("array<struct<author:string,content:string,created_at:string>>").alias("children"))))
    cj = F.when(F.size(lines) <= 1, F.lit("null")).when(src == "bobae", wrapped_json).otherwise(flat_json)
    return d.select(
        "doc_id",
        src.alias("data_source"),
        F.element_at(lines, 1).alias("content"),
        base.alias("created_at"),
        (F.col("n_chars") % 1000).alias("viewed"),
        (F.col("doc_id") % 17).alias("liked"),
        cj.alias("comments_json"),
    )


def site_pages(spark: SparkSession, root: str) -> DataFrame:
    """documents -> one page each in the markup of its site: the first line is the post, line k
    behind it a comment by `a<k>`; every third comment answers the one before it (clien has
    no answers, and blocks every fifth comment); dc shows comments under 20 characters as
    deleted ones."""
    d = read_table(spark, root, "documents").where("text is not null")
    src, k = source_by("doc_id"), F.col("doc_id")
    base = F.timestamp_add("HOUR", k, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    lines = F.split("text", "\n", -1)

    def esc(x):
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    def tag(name, inner, cls=None):
        head = f'<{name} class="{cls}">' if cls else f"<{name}>"
        return F.concat(F.lit(head), *(inner if isinstance(inner, tuple) else (inner,)), F.lit(f"</{name}>"))

    def parts(i, site):
        t = F.date_format(F.timestamp_add("MINUTE", i * COMMENT_STEP_MINUTES, base), SITE_LAYOUTS[site])
        return F.concat(F.lit("a"), i.cast("string")), esc(F.get(lines, i)), t

    n = F.size(lines) - 1
    numbers = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    first = F.filter(numbers, lambda i: i % 3 != 0)

    def answered(i):
        return (i % 3 == 2) & (i < n)

    def dc_body(i):
        a, text, t = parts(i, "dc")
        return tag("span", tag("em", a), "nickname"), tag("p", text), t

    def dc(i, count):
        a, text, t = dc_body(i)
        whole = F.concat(F.lit('<div data-rcnt="'), count, F.lit('">'), tag("div", a, "cmt_nickbox"), tag("div", text, "cmt_txtbox"), tag("div", tag("span", t, "date_time"), "fr"), F.lit("</div>"))
        gone = F.concat(F.lit('<div data-rcnt="'), count, F.lit('"><p>deleted</p></div>'))
        return tag("li", F.when(F.length(F.get(lines, i)) < DELETED_BELOW_CHARS, gone).otherwise(whole), "ub-content")

    def dc_row(i):
        return F.concat(dc(i, answered(i).cast("int").cast("string")), F.when(answered(i), tag("li", tag("ul", dc(i + 1, F.lit("0"))))).otherwise(""))

    def naver_row(i):
        a, text, t = parts(i, "naver")
        cls = F.when(i % 3 == 0, "CommentItem CommentItem--reply").otherwise("CommentItem")
        box = tag("div", (tag("a", a, "comment_nickname"), tag("span", text, "comment_text_view"), tag("span", t, "comment_info_date")), "comment_box")
        return F.concat(F.lit('<li class="'), cls, F.lit('">'), box, F.lit("</li>"))

    def bobae_dl(i, more):
        a, text, t = parts(i, "bobae")
        return tag("dl", (tag("dt", (tag("span", a, "cmt_nickname"), tag("span", t, "date"))), tag("dd", (tag("p", text), F.lit("<br>"), more))))

    def bobae_row(i):
        return bobae_dl(i, F.when(answered(i), tag("div", bobae_dl(i + 1, F.lit("")), "replyList")).otherwise(""))

    def clien_row(i):
        a, text, t = parts(i, "clien")
        cls = F.when(i % 5 == 0, "comment_row blocked").otherwise("comment_row")
        liked = F.concat(F.lit("1,"), F.lpad((i % 100).cast("string"), 3, "0"))
        stamp = F.concat(t, F.when(i % 2 == 0, F.concat(F.lit(" / 수정일: "), t)).otherwise(""))
        return F.concat(F.lit('<div class="'), cls, F.lit('">'), tag("span", a, "nickname"), tag("span", liked, "comment_symph"), tag("div", text, "comment_content"), tag("span", stamp, "timestamp"), F.lit("</div>"))

    def rows(of, make):
        return F.array_join(F.transform(of, make), "")

    title, body, author = F.concat(F.lit("제목 &amp; "), k.cast("string")), esc(F.get(lines, F.lit(0))), F.concat(F.lit("u"), k.cast("string"))
    time = F.coalesce(*[F.when(src == s, F.date_format(base, x)) for s, x in SITE_LAYOUTS.items()])
    viewed, liked = (F.col("n_chars") % 1000).cast("string"), (k % 17).cast("string")
    lab = lambda name, v: F.concat(F.lit(f"{name} "), v)
    counts = (tag("span", lab("조회", viewed)), tag("span", lab("추천", liked)), tag("span", tag("a", lab("댓글", n.cast("string")))))
    head = (tag("h3", (tag("span", F.lit("[잡담]")), tag("span", title))), tag("div", (tag("div", (tag("span", tag("em", author)), tag("span", F.lit("(1.2)")), tag("span", time))), tag("div", counts))))
    dc_page = F.concat(tag("article", F.lit("notice")), tag("article", (tag("header", tag("div", head)), tag("div", body, "write_div"), tag("ul", rows(first, dc_row), "cmt_list"))))
    naver_page = tag(
        "div",
        (
            tag("div", tag("div", tag("h3", title)), "article_header"),
            tag("div", (tag("div", tag("b", author, "nickname"), "profile_info"), tag("div", (tag("span", time, "date"), tag("span", lab("조회", viewed), "count")), "article_info"), tag("div", body, "article_viewer")), "article_container"),
            tag("div", (tag("strong", n.cast("string"), "num"), tag("div", tag("em", liked, "u_cnt _count"), "like_article")), "ArticleTool"),
            tag("ul", rows(numbers, naver_row), "comment_list"),
        ),
        "ArticleContentBox",
    )
    util = tag("div", (tag("time", time), tag("span", lab("추천", liked), "data3"), tag("span", lab("조회", viewed), "data4")), "util")
    bobae_page = F.concat(
        tag("header", (tag("div", title, "title"), util, tag("div", tag("div", tag("span", author), "info"), "util2")), "article-tit"),
        tag("div", body, "article-body"),
        tag("div", tag("div", rows(first, bobae_row), "cmtList"), "commentListArea"),
    )
    clien_page = F.concat(
        tag("h3", title, "post_subject"),
        tag("div", (tag("span", author, "nickname"), tag("span", viewed, "view_count"), tag("a", F.concat(liked, F.lit("명")), "symph_count")), "post_info"),
        tag("div", tag("span", F.concat(time, F.lit(" 수정일 : "), time)), "post_author"),
        tag("div", body, "post_content"),
        rows(numbers, clien_row),
    )
    page = F.coalesce(*[F.when(src == s, p) for s, p in (("dc", dc_page), ("naver", naver_page), ("bobae", bobae_page), ("clien", clien_page))])
    skin = F.concat(F.lit("<!DOCTYPE html><html><head><script>var x = '<div class=write_div>';</script></head><body><nav><a href=/x>menu</a></nav>"), page, F.lit("</body></html>"))
    return d.select("doc_id", src.alias("data_source"), skin.alias("html"))


def site_posts(spark: SparkSession, root: str) -> DataFrame:
    """documents -> posts as the crawlers deliver them (all text), with some that the
    formatter must refuse: every 23rd document comes from a source it does not know, every
    29th has a broken date, every 31st a broken view count."""
    rt = raw_threads(spark, root)
    k, src, n = F.col("doc_id"), F.col("data_source"), F.col("viewed").cast("string")
    title = F.concat(F.lit("제목 "), k.cast("string"))
    created = F.coalesce(*[F.when(src == s, F.date_format("created_at", layout)) for s, layout in SITE_LAYOUTS.items()])
    liked = F.col("liked").cast("string")
    thousands = F.concat(F.lit("1,"), F.lpad(liked, 3, "0"), F.lit("명"))
    clien = F.when(k % 5 == 2, thousands).when(F.col("liked") == 0, F.lit("")).otherwise(F.concat(liked, F.lit("명")))
    return rt.select(
        "doc_id",
        F.when(k % 23 == 0, F.lit("reddit")).otherwise(src).alias("data_source"),
        F.when(src == "bobae", F.concat(title, F.lit(" (12) 이미지"))).when(src == "clien", F.concat(title, F.lit(" 12"))).otherwise(title).alias("title"),
        "content",
        F.when(k % 29 == 0, F.lit("garbage")).otherwise(created).alias("created_at"),
        F.when(k % 31 == 0, F.lit("many")).when(src == "naver", F.concat(F.lit("조회 "), n)).otherwise(n).alias("viewed"),
        F.when(src == "naver", F.concat(liked, F.lit(".5천"))).when(src == "clien", clien).otherwise(liked).alias("liked"),
        F.when(src.isin("dc", "naver"), (k % 11).cast("string")).alias("num_of_comments"),
        F.col("comments_json").alias("comments"),
    )


def file_list(spark: SparkSession, root: str) -> DataFrame:
    """kw_posts as an object listing: one file per (source, first keyword, hour), named
    `keywords/<iso hour>/<source>_<keyword>_<iso hour>.jsonl` with ':' url-encoded;
    modification time = newest post in it."""
    p = kw_posts(spark, root)
    iso = F.date_format("file_create_time", "yyyy-MM-dd'T'HH:mm:ss")
    key = F.concat(F.lit("keywords/"), iso, F.lit("/"), F.col("data_source"), F.lit("_"), F.col("keywords")[0], F.lit("_"), iso, F.lit(".jsonl"))
    return p.groupBy(F.replace(key, F.lit(":"), F.lit("%3A")).alias("key")).agg(F.max("created_at").cast("timestamp").alias("file_mtime"))


def sparse_series(spark: SparkSession, n_series: int, length: int, zero_fraction: float = 0.7, seed: int = 7) -> DataFrame:
    """U5 (test fixture only): sine curves plus noise with `zero_fraction` of the points
    zeroed, as (name, created_at, value) rows."""
    r = spark.range(n_series * length)
    name = (F.col("id") / length).cast("long")
    pos = F.col("id") % length
    v = F.sin(pos / F.lit(10.0) + name) * 10 + 10 + F.rand(seed) * 2
    v = F.when(F.rand(seed + 1) < zero_fraction, F.lit(0.0)).otherwise(v)
    t = F.timestamp_add("HOUR", pos, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return r.select(F.concat(F.lit("s"), name.cast("string")).alias("name"), t.alias("created_at"), v.alias("value"))
