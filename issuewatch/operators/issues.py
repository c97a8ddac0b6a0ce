"""Keyword issue time series: C3, A5, A1, P6, DT7, DT8, J1-J3, M1, A2, A3.

Plan shape (see `.explain`): the history scan carries the snapshot-window filter
(pushed to parquet, and to the partitions of a table partitioned by snapshot date), keywords are exploded, sums are partially aggregated map-side
(so a hot keyword never lands whole in one task), shuffled on (hour, keyword) and
left-joined from a per-keyword hour grid. The grid is generated per keyword with
`explode(sequence(...))` instead of a cross join, and where the dense table is built only
behind the last exchange: what is shuffled and sorted is one row per keyword. The active-keyword filter (J1) is a
semi join on the aggregated facts, never on the exploded history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import issue_score, log_frequency

SUM_COLS = ("num_of_comments", "viewed", "liked", "sentiment")
WINDOW_DAYS = 62  # fixed value: issue window length in days


def explode_keywords(posts: DataFrame, *keep: str, keyword_col: str = "keywords", as_name: str = "current_keyword") -> DataFrame:
    """One row per keyword; rows with null or empty keyword arrays vanish."""
    return posts.select(F.explode(keyword_col).alias(as_name), *keep)


def distinct_keywords(batch: DataFrame, keyword_col: str = "keywords") -> DataFrame:
    """A5: distinct keywords of the current batch."""
    return batch.select(F.explode(keyword_col).alias("current_keyword")).distinct()


def window_bounds(snapshot: Column, days: int = WINDOW_DAYS) -> tuple[Column, Column]:
    """DT7: end = snapshot, start = midnight of (snapshot date - days)."""
    return F.date_sub(snapshot, days).cast("timestamp"), snapshot


def keyword_hour_sums(
    history: DataFrame, start: Column | None = None, end: Column | None = None, time_col: str = "file_create_time", date_col: str = "snapshot_date"
) -> DataFrame:
    """A1 (+P6, P11): sums per (snapshot hour, keyword) inside [start, end]. A snapshot at
    11:07 counts for the hour 11:00, so it meets the hour grid. A history partitioned by
    `date_col` is pruned to the window's dates."""
    h = _inside(history, start, end, time_col, date_col)
    hour = F.date_trunc("hour", time_col).alias("created_at")
    ex = h.select(F.explode("keywords").alias("current_keyword"), hour, *SUM_COLS)
    return _sums(ex.groupBy("created_at", "current_keyword"))


def _inside(rows: DataFrame, start: Column | None, end: Column | None, time_col: str, date_col: str) -> DataFrame:
    """The rows with a time in [start, end]; a table partitioned by `date_col` is pruned to
    the window's dates."""
    for bound, keep in ((start, lambda c, x: c >= x), (end, lambda c, x: c <= x)):
        if bound is not None:
            rows = rows.filter(keep(F.col(time_col), bound))
            if date_col in rows.columns:  # the table's partition column: prunes folders
                rows = rows.filter(keep(F.col(date_col), F.to_date(bound)))
    return rows


def snapshot_sums(posts: DataFrame, time_col: str = "file_create_time") -> DataFrame:
    """A1, the part of a snapshot: sums per (snapshot time, keyword) of its posts, one row
    each whatever the number of posts. Rows of the table that `window_sums` adds up."""
    ex = posts.select(F.explode("keywords").alias("current_keyword"), F.col(time_col).alias("snapshot"), *SUM_COLS)
    return _sums(ex.groupBy("snapshot", "current_keyword"))


def window_sums(sums: DataFrame, start: Column | None = None, end: Column | None = None, date_col: str = "snapshot_date") -> DataFrame:
    """A1 + P6 from stored `snapshot_sums`: equal to `keyword_hour_sums` of the posts behind
    them, without reading a post. Snapshots of one hour are added up."""
    s = _inside(sums, start, end, "snapshot", date_col)
    return _sums(s.groupBy(F.date_trunc("hour", "snapshot").alias("created_at"), "current_keyword"))


def _sums(groups) -> DataFrame:
    counts = [F.sum(c).cast("bigint").alias(c) for c in SUM_COLS[:3]]
    return groups.agg(*counts, F.sum("sentiment").cast("double").alias("sentiment"))


def join_active_keywords(facts: DataFrame, keywords: DataFrame, key: str = "current_keyword") -> DataFrame:
    """Keep only rows of the active keywords. Applied to the aggregated (hour,
    keyword) facts, not the exploded history, so both sides are small; a semi join
    (the keyword list is distinct), broadcast by AQE when its measured size allows."""
    return facts.join(keywords.select(key), key, "left_semi")


def hour_grid(keywords: DataFrame, start: Column, end: Column, key: str = "current_keyword") -> DataFrame:
    """DT8 + J3: every hour in [start, end] for every keyword, generated per keyword
    row (a generator, not a cross join; rows per keyword are bounded by the window)."""
    return keywords.select(key, F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("created_at"))


def densify(grid: DataFrame, facts: DataFrame, keys=("created_at", "current_keyword")) -> DataFrame:
    """Grid left join facts; missing sums become 0; score computed once (M1)."""
    return _scored(grid.join(facts, list(keys), "left"))


def _scored(dense: DataFrame) -> DataFrame:
    return dense.fillna(0, list(SUM_COLS)).select(
        "created_at",
        "current_keyword",
        issue_score("viewed", "liked", "num_of_comments").alias("current_issueization"),
        "num_of_comments",
        "viewed",
        "liked",
        "sentiment",
    )


def current_issue(history: DataFrame, batch: DataFrame, snapshot: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """The dense keyword x hour fact table `current_issue` for one snapshot."""
    return _dense(keyword_hour_sums(history, *window_bounds(snapshot, days)), batch, snapshot, days)


def current_issue_from_sums(sums: DataFrame, batch: DataFrame, snapshot: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """`current_issue` from stored `snapshot_sums`, the batch's own among them: a run reads
    the window's (snapshot, keyword) rows and its own batch, never an earlier post."""
    return _dense(window_sums(sums, *window_bounds(snapshot, days)), batch, snapshot, days)


def _dense(facts: DataFrame, batch: DataFrame, snapshot: Column, days: int) -> DataFrame:
    start, end = window_bounds(snapshot, days)
    kw = distinct_keywords(batch)
    return dense_curves(kw, join_active_keywords(facts, kw), start, end)


def dense_curves(keywords: DataFrame, facts: DataFrame, start: Column, end: Column, key: str = "current_keyword") -> DataFrame:
    """J2 + J3 in one: the rows of `densify(hour_grid(keywords, start, end), facts)` for facts
    on the grid's hours, one row per hour and keyword.

    A keyword's facts, at most one for each hour of the window, are packed into its row. Each
    of them opens a run of hours up to the next one, and the runs are laid out behind the
    last exchange, so hours without posts are neither shuffled nor sorted. The rows of a
    partition come out by keyword and hour."""
    hour = F.expr("INTERVAL 1 HOUR")
    tasks = int(keywords.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = facts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("created_at", *SUM_COLS))).alias("cells"))  # at most the window's hours
    rows = keywords.select(key).join(packed, key, "left").withColumn("first", start).withColumn("last", end)
    # by a hash of the key: by the key itself the exchange would be taken for the join's, and its small partitions put together
    rows = rows.repartition(tasks, F.xxhash64(key)).sortWithinPartitions(key)
    kinds = {f.name: f.dataType for f in facts.schema.fields}
    blank = F.struct(F.col("first").alias("created_at"), *[F.lit(None).cast(kinds[c]).alias(c) for c in SUM_COLS])
    led = F.when(F.get("cells", F.lit(0))["created_at"] > F.col("first"), F.concat(F.array(blank), "cells"))
    rows = rows.select(key, "last", F.coalesce(led, "cells", F.array(blank)).alias("cells"))
    until = F.transform("cells", lambda c, k: F.coalesce(F.get("cells", k + 1)["created_at"] - hour, F.col("last")))
    runs = rows.select(key, F.explode(F.arrays_zip("cells", until.alias("until"))).alias("run"))
    runs = runs.select(key, F.col("run.cells").alias("cell"), F.col("run.until").alias("until"))
    dense = runs.select(key, "cell", F.explode(F.sequence(F.col("cell.created_at"), F.col("until"), hour)).alias("created_at"))
    here = F.col("created_at") == F.col("cell.created_at")
    return _scored(dense.select("created_at", key, *[F.when(here, F.col(f"cell.{c}")).alias(c) for c in SUM_COLS]))


def keyword_hour_issue(history: DataFrame) -> DataFrame:
    """Sparse variant: issue score per (hour, keyword) that has posts."""
    s = keyword_hour_sums(history)
    return s.select("created_at", "current_keyword", issue_score("viewed", "liked", "num_of_comments").alias("current_issueization"), *SUM_COLS)


def total_frequency(current: DataFrame) -> DataFrame:
    """A2: per keyword ln(sum(issue score) + 1)."""
    return current.groupBy("current_keyword").agg(log_frequency(F.sum("current_issueization")).alias("total_frequency"))


def keyword_frequency(current: DataFrame) -> DataFrame:
    """A3: per keyword sum(issue score) (the frequency view)."""
    return current.groupBy("current_keyword").agg(F.sum("current_issueization").alias("frequency"))
