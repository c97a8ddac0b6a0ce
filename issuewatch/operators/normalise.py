"""Per-source normalisation (P1-P4, P10, P12, C1, C2, F-chains) as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.dates import format_ts, parse_post_date
from ..functions.numbers import korean_number
from .comments import comment_count, normalise_comments, rewrite_comment_times

DC_SOURCES = ("dc", "dcinside")
PLAIN_SOURCES = ("naver", "bobae", "clien")


def clean_by_source(df: DataFrame, col: str = "content", source_col: str = "data_source") -> DataFrame:
    """F-chain per source (2.8.1) in one scan. F1 and F2 are computed once into a column,
    F3 uses native replaces except for rows with unusual entities, which go through the
    Arrow UDF (see `text.html_unescape_mixed`), then F4 onward per source. A source that
    is not known has no chain: its text becomes NULL."""
    src = F.col(source_col)
    stripped = df.withColumn("_f12", text.strip_emails(text.strip_urls(col)))
    unesc = stripped.withColumn("_f3", text.html_unescape_mixed(F.col("_f12")))
    x = F.col("_f3")
    out = unesc.withColumn(col, F.when(src.isin(*DC_SOURCES), _clean_native_from(x, "dc")).when(src.isin(*PLAIN_SOURCES), _clean_native_from(x, "naver")))
    return out.drop("_f12", "_f3")


def _clean_native_from(x, source: str):
    """F4 onward of the chain for `source` on an already url/email-stripped column."""
    return text.after_allowed(x, source)


def clean_titles(df: DataFrame, col: str = "title", source_col: str = "data_source") -> DataFrame:
    """F10 (bobae) / F11 (clien); other sources keep their title."""
    src = F.col(source_col)
    t = F.when(src == "bobae", text.clean_title_bobae(col)).when(src == "clien", text.clean_title_clien(col)).otherwise(F.col(col))
    return df.withColumn(col, t)


def normalise_posts(raw: DataFrame, snapshot: Column, source_col: str = "data_source") -> tuple[DataFrame, DataFrame]:
    """The formatter: raw posts of all sources -> (formatted posts, quarantine).

    `raw` has the text columns of `files.RAW_POST` and `source_col`; other columns pass
    through. Per source: content cleaned (2.8.1 chains), titles of bobae and clien
    cleaned, created_at parsed (DT1-DT4), counts as integers (dc: as they are; naver: unit
    numbers under a view label; bobae and clien: viewed and liked without commas, an empty
    text of clien is 0, comments counted), comments in one shape with their times
    rewritten. A row goes to the quarantine with its raw values and a `reason`: unknown
    source, failed date, or failed number. One scan, no shuffle."""
    src = F.col(source_col)
    comments = normalise_comments(F.col("comments"))
    count = {
        c: F.when(src == "naver", korean_number(text.strip_view_prefix(c)))
        .when((src == "clien") & (F.lit(c) == "liked"), text.clien_liked(c))
        .when((src == "clien") & (F.trim(c) == ""), F.lit(0).cast("bigint"))
        .otherwise(F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("bigint"))
        for c in ("viewed", "liked", "num_of_comments")
    }
    own = src.isin(*DC_SOURCES) | (src == "naver")
    count["num_of_comments"] = F.when(own, count["num_of_comments"]).otherwise(comment_count(comments).cast("bigint"))
    parsed = {f"_n_{c}": v for c, v in count.items()} | {"_time": parse_post_date(F.col("created_at"), src, snapshot)}
    rows = raw.withColumn("_raw", F.struct(*raw.columns)).withColumns(parsed)
    bad_number = F.col("_n_viewed").isNull() | F.col("_n_liked").isNull() | F.col("_n_num_of_comments").isNull()
    reason = (
        F.when(src.isNull() | ~src.isin(*DC_SOURCES, *PLAIN_SOURCES), "unknown source")
        .when(F.col("_time").isNull(), "failed date")
        .when(bad_number, "failed number")
    )
    rows = rows.withColumn("_reason", reason)
    quarantine = rows.where(F.col("_reason").isNotNull()).select("_raw.*", F.col("_reason").alias("reason"))
    good = rows.where(F.col("_reason").isNull())
    good = good.withColumns(
        {
            "created_at": format_ts("_time"),
            "comments": rewrite_comment_times(comments, lambda c: parse_post_date(c, src, snapshot)),
            **{c: F.col(f"_n_{c}") for c in count},
        }
    )
    good = clean_titles(clean_by_source(good, "content", source_col), "title", source_col)
    return good.select(*raw.columns), quarantine


def to_raw_data(df: DataFrame, snapshot) -> DataFrame:
    """P1 (+C4, C5): stamp the snapshot, cast with try_cast (bad values -> NULL, not a
    failed job under ANSI), comments as JSON text, keywords kept as an array (SURVEY D1),
    14 columns in the warehouse order."""
    comments = F.col("comments")
    is_text = dict(df.dtypes).get("comments") == "string"
    return df.select(
        F.col("title").cast("string").alias("title"),
        F.col("content").cast("string").alias("content"),
        F.col("author").cast("string").alias("author"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
        F.col("viewed").try_cast("int").alias("viewed"),
        F.col("liked").try_cast("int").alias("liked"),
        F.col("num_of_comments").try_cast("int").alias("num_of_comments"),
        (comments if is_text else F.to_json(comments)).alias("comments"),
        F.col("model").cast("string").alias("model"),
        F.col("data_source").cast("string").alias("data_source"),
        F.col("keywords").alias("keywords"),
        snapshot.try_cast("timestamp").alias("file_create_time"),
        F.col("sentiment").try_cast("float").alias("sentiment"),
        F.col("url").cast("string").alias("url"),
    )


def raw_data_view(raw: DataFrame, width: int = 255) -> DataFrame:
    """P2 + C3: one row per keyword; content and comments, where the rows have them, cut to
    `width` characters."""
    cols = [F.substring(c, 1, width).alias(c) if c in ("content", "comments") else F.col(c) for c in raw.columns if c != "keywords"]
    return raw.select(F.explode("keywords").alias("current_keyword"), *cols)
