"""Turning already fetched HTML into post / link / comment rows.

Fetching and browser driving are not part of the engine (see README); the
extraction that follows it is a per-row regex job, native in Catalyst; F3 (entity
unescaping) is native for the common entities and uses Python only for other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Extraction rules: field -> regex with one group. The same template serves all four
# sites in the stored pages; a site can override any field.
DEFAULT_RULES = {
    "title": r"<title>(.*?)</title>",
    "content": r"(?s)<article>(.*?)</article>",
    "author": r"<footer>&copy; ([^ <]+)",
}
SITE_RULES = {s: dict(DEFAULT_RULES) for s in ("dc", "naver", "bobae", "clien")}
HREF = r'href="([^"]*)"'
# Fixed values from the reference: placeholder of a deleted comment, default content of
# an emoticon-only comment, css markers of listing rows and of blocked comments.
DELETED_CONTENT = "해당 댓글은 삭제되었습니다."
EMOTICON_CONTENT = " "
POST_ROW_CLASS = "ub-content us-post"
BLOCKED_CLASS = "blocked"


def strip_tags(c: Column) -> Column:
    """Body HTML -> text: drop the h1 heading, replace tags by blanks, collapse blanks."""
    no_h1 = F.regexp_replace(c, r"(?s)<h1>.*?</h1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(no_h1, r"<[^>]+>", " "), r"\s+", " "))


def _field(html: Column, source: Column, field: str) -> Column:
    expr = None
    for s, rules in SITE_RULES.items():
        v = F.regexp_extract(html, rules[field], 1)
        expr = F.when(source == s, v) if expr is None else expr.when(source == s, v)
    return expr


def extract_posts(pages: DataFrame, html: str = "html", source: str = "data_source") -> DataFrame:
    """H1: title / content / author per page by the site's rules; `ok` is false when a
    field is missing (those rows are the quarantine, kept in the output)."""
    h, s = F.col(html), F.col(source)
    out = pages.select(
        "*",
        _field(h, s, "title").alias("_title"),
        strip_tags(_field(h, s, "content")).alias("_content"),
        _field(h, s, "author").alias("author"),
    )
    res = (
        out.withColumn("title", text.html_unescape_mixed(F.col("_title")))
        .withColumn("content", text.html_unescape_mixed(F.col("_content")))
        .drop("_title", "_content")
    )
    ok = (F.length("title") > 0) & (F.length("content") > 0) & (F.length("author") > 0)
    return res.withColumn("ok", ok)


def extract_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """H2: one row per href with its position; relative links resolved on the page's
    scheme and host."""
    ex = pages.select(key, url, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(HREF), 1)).alias("link_pos", "href"))
    origin = F.regexp_extract(F.col(url), r"^(https?://[^/?#]+)", 1)
    absolute = F.when(F.col("href").startswith("/"), F.concat(origin, F.col("href"))).otherwise(F.col("href"))
    return ex.select(key, F.col("link_pos").cast("int").alias("link_pos"), "href", absolute.alias("link_url"))


def post_rows(items: DataFrame, cls: str = "class") -> DataFrame:
    """The listing rows that are posts, by their class (dc)."""
    return items.filter(F.contains(F.col(cls), F.lit(POST_ROW_CLASS)))


def unblocked_comments(items: DataFrame, cls: str = "class") -> DataFrame:
    """Comments whose class does not mark them as blocked (clien)."""
    return items.filter(~F.contains(F.col(cls), F.lit(BLOCKED_CLASS)))


def comment_defaults(items: DataFrame) -> DataFrame:
    """H3: a comment with missing fields becomes the deleted placeholder; a missing content
    alone (emoticon-only comment) becomes ' '."""
    missing = F.col("author").isNull() | F.col("created_at").isNull()
    return items.select(
        "*",
        F.when(missing, F.lit(" ")).otherwise(F.col("author")).alias("_a"),
        F.when(missing, F.lit(DELETED_CONTENT)).otherwise(F.coalesce(F.col("content"), F.lit(EMOTICON_CONTENT))).alias("_c"),
        F.when(missing, F.lit(" ")).otherwise(F.col("created_at")).alias("_t"),
    ).drop("author", "content", "created_at").withColumnsRenamed({"_a": "author", "_c": "content", "_t": "created_at"})
