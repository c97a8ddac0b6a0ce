"""J6 / A8 / DT9 / DT10 / A3: dashboard views over the issue tables.

`issue_graph`: past and current curves are both shifted so that they start at the
same anchor (`date_trunc('hour', now - 2 months)`), then joined on the shifted hour.
The origins are scalar aggregates (`min`), planned once as subqueries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import pair_series

#: Past rows up to this count are broadcast to the current ones; more meet them as packed curves.
MAX_BROADCAST_ROWS = 200_000


def anchor_time(now: Column, months: int = 2) -> Column:
    """DT9: date_trunc('hour', now - months)."""
    return F.date_trunc("hour", now - F.expr(f"INTERVAL {int(months)} MONTHS"))


def shift_series(df: DataFrame, origin: Column, anchor: Column, time_col: str = "created_at") -> DataFrame:
    """DT10: created_at + (anchor - origin) seconds."""
    off = F.timestamp_diff("SECOND", origin, anchor)
    return df.withColumn(time_col, F.timestamp_add("SECOND", off, F.col(time_col)))


def hours_from(anchor: Column, time_col: str) -> Column:
    return F.floor(F.timestamp_diff("SECOND", anchor, F.col(time_col)) / 3600).cast("int")


def packed_curves(df: DataFrame, key: str, anchor: Column, time_col: str = "created_at") -> DataFrame:
    """(key, first, cells): one row per curve. `cells[h - first]` holds the rows of hour h (counted
    from the anchor), null where there are none, so two curves are aligned by position. A
    curve's rows are bounded by the window, not by the data."""
    rest = [c for c in df.columns if c != key]
    hours = df.groupBy(key, hours_from(anchor, time_col).alias("h")).agg(F.collect_list(F.struct(*rest)).alias("rows"))
    curves = hours.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("h", "rows"))).alias("some"), F.min("h").alias("first"), F.max("h").alias("last"))
    gaps = F.size("some") <= F.col("last") - F.col("first")
    filled = F.transform(F.sequence("first", "last"), lambda h: F.get(F.filter("some", lambda c: c["h"] == h), F.lit(0))["rows"])
    return curves.select(key, "first", "last", F.when(gaps, filled).otherwise(F.transform("some", lambda c: c["rows"])).alias("cells"))


def issue_graph(past_issue: DataFrame, current_issue: DataFrame, now: Column, origin_issue: str | None = None) -> DataFrame:
    """Shifted past x current rows per hour. `origin_issue` names the past issue whose
    first hour is the origin for all past curves (the reference behaviour); None uses
    each past issue's own first hour.

    Every past curve meets every current one by definition of the result. Few past rows
    are broadcast, after a count, and each current row looks up its hour in them where it is
    read. More meet as packed rows, on blocks of curves, so the pairs spread over the tasks by curve and no
    task is keyed by an hour; a pair is unpacked where it was joined, without a shuffle."""
    anchor = anchor_time(now)
    if origin_issue is None:
        # per-issue origin: a partial min per issue joined back (one row per issue), so
        # no issue's curve has to sit in one task
        origins = past_issue.groupBy("past_issue_name").agg(F.min("created_at").alias("_o"))
        past = past_issue.join(origins, "past_issue_name")
        past = past.withColumn("created_at", F.timestamp_add("SECOND", F.timestamp_diff("SECOND", F.col("_o"), anchor), F.col("created_at"))).drop("_o")
    else:
        p_origin = past_issue.filter(F.col("past_issue_name") == origin_issue).select(F.min("created_at")).scalar()
        past = shift_series(past_issue, p_origin, anchor)
    c_origin = current_issue.select(F.min("created_at")).scalar()
    cur = shift_series(current_issue, c_origin, anchor)
    if past_issue.count() <= MAX_BROADCAST_ROWS:
        p = past.groupBy("past_issue_name", hours_from(anchor, "created_at").alias("p_hour"))
        p = p.agg(F.collect_list(F.struct(*[n for n in past.columns if n != "past_issue_name"])).alias("p"))  # few rows in all
        c = cur.select("current_keyword", F.struct(*[n for n in cur.columns if n != "current_keyword"]).alias("c"), hours_from(anchor, "created_at").alias("hour"))
        cells = c.join(F.broadcast(p), F.col("hour") == F.col("p_hour"))
        both = cells.select("past_issue_name", "current_keyword", F.explode("p").alias("p"), "c")
    else:
        p = packed_curves(past, "past_issue_name", anchor).toDF("past_issue_name", "p_first", "p_last", "p_cells")
        c = packed_curves(cur, "current_keyword", anchor).toDF("current_keyword", "c_first", "c_last", "c_cells")
        tasks = int(past_issue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = pair_series(c, p, "current_keyword", "past_issue_name", max(1, math.isqrt(tasks)), max(1, math.isqrt(tasks)))
        low, high = F.greatest("p_first", "c_first"), F.least("p_last", "c_last")
        hours = pairs.where(low <= high).withColumn("h", F.explode(F.sequence(low, high)))
        cells = hours.select(
            "past_issue_name", "current_keyword", F.get("p_cells", F.col("h") - F.col("p_first")).alias("p"), F.get("c_cells", F.col("h") - F.col("c_first")).alias("c")
        )
        both = cells.select("past_issue_name", "current_keyword", "c", F.explode("p").alias("p")).select("past_issue_name", "current_keyword", "p", F.explode("c").alias("c"))
    both = both.where(F.col("p.created_at") == F.col("c.created_at"))  # rows off the full hour meet only where they are equal
    names = [n for n in past.columns if n not in ("created_at", "past_issue_name")]
    more = [n for n in cur.columns if n not in ("created_at", "current_keyword")]
    return both.select("p.created_at", "past_issue_name", *[f"p.{n}" for n in names], "current_keyword", *[f"c.{n}" for n in more])
