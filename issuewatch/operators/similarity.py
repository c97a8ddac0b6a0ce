"""Similarity of each keyword's issue curve to the curves
of past issues.

* Series prep is native: per key, the nonzero points (hour offset, value) are
  collected in time order (bounded by the window length, not by the data), and the
  values z-scored with the population mean / std of the nonzero values (std 0 -> z 0,
  so a similarity is never NaN).
* Pairing: every (keyword, past issue) pair is needed by definition of the result.
  It is produced by a blocked equi-join: each side is hashed into blocks and
  replicated over the other side's blocks, so the pairs are spread over
  blocks_cur x blocks_past tasks instead of one cartesian product; AQE broadcasts the
  past side at runtime when its measured size is small.
* DTW runs in an Arrow-batched pandas UDF (numpy kernel in `functions.dtw`).
  Pairs where either series has no nonzero value get similarity 0 without DTW.
* `top_alerts_bounded` finds the highest similarity x frequency without the pair table: a
  similarity is at most 1, so keywords below the k-th best value so far pair with nothing;
  of the others only the envelopes are paired, and the kernel sees pairs in the order of
  their bounds until no bound reaches the k-th best.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..functions import dtw
from ..functions.scoring import DTW_RADIUS, SIMILARITY_SCALE, alert_value
from ..session import scratch_path
from .alerts import alert_table, top_alerts


def series_points(df: DataFrame, key: str, time_col: str, value_col: str, origin: Column | None = None) -> DataFrame:
    """A4 + C6 + M2: key, n_points, idx (hour offsets of nonzero values, ascending),
    z (z-scores of those values). `origin` defaults to the key's first time (dense input)."""
    rows = df.select(F.col(key), F.col(time_col).alias("t"), F.col(value_col).cast("double").alias("v"))
    # a plain aggregate for all rows; only the nonzero ones are collected
    starts = rows.groupBy(key).agg(F.min("t").alias("_t0"))
    some = rows.where(F.col("v") != 0).groupBy(F.col(key).alias("_key"))
    some = some.agg(F.array_sort(F.collect_list(F.struct("t", "v"))).alias("_some"), F.avg("v").alias("_mu"), F.stddev_pop("v").alias("_sd"))
    g = starts.join(some, F.col(key).eqNullSafe(F.col("_key")), "left")
    none = F.array().cast(some.schema["_some"].dataType)
    g = g.withColumn("_pts", F.coalesce("_some", none))
    t0 = F.col("_t0") if origin is None else origin
    return g.select(
        key,
        F.size("_pts").alias("n_points"),
        F.transform("_pts", lambda p: F.timestamp_diff("HOUR", t0, p["t"]).cast("int")).alias("idx"),
        F.transform(
            "_pts",
            lambda p: F.when(F.col("_sd") > 0, (p["v"] - F.col("_mu")) / F.col("_sd")).otherwise(F.lit(0.0)),
        ).alias("z"),
    )


def _blocks(spark_partitions: int) -> int:
    return max(1, int(math.ceil(math.sqrt(max(1, spark_partitions)))))


def pair_series(cur: DataFrame, past: DataFrame, cur_key: str, past_key: str, blocks_cur: int, blocks_past: int) -> DataFrame:
    """All (cur, past) pairs by a blocked equi-join on (cur block, past block)."""
    c = cur.withColumn("_cb", F.pmod(F.xxhash64(cur_key), F.lit(blocks_cur))).withColumn(
        "_pb", F.explode(F.sequence(F.lit(0), F.lit(blocks_past - 1)))
    )
    p = past.withColumn("_pb", F.pmod(F.xxhash64(past_key), F.lit(blocks_past))).withColumn(
        "_cb", F.explode(F.sequence(F.lit(0), F.lit(blocks_cur - 1)))
    )
    return c.join(p, ["_cb", "_pb"]).drop("_cb", "_pb")


def _distance_udf(radius: int, exact: bool):
    @pandas_udf(DoubleType())
    def distance(a_idx: pd.Series, a_z: pd.Series, b_idx: pd.Series, b_z: pd.Series) -> pd.Series:
        out = [dtw.series_distance(ai, az, bi, bz, radius=radius, exact=exact) for ai, az, bi, bz in zip(a_idx, a_z, b_idx, b_z)]
        return pd.Series(out, dtype="float64")

    return distance


def series_similarity(
    cur_points: DataFrame,
    past_points: DataFrame,
    cur_key: str = "current_keyword",
    past_key: str = "past_issue_name",
    radius: int = DTW_RADIUS,
    scale: float = SIMILARITY_SCALE,
    exact: bool = False,
    blocks: tuple[int, int] | None = None,
    min_similarity: float = 0.0,
    with_distance: bool = False,
) -> DataFrame:
    """cur_key, past_key, similarity_degree = exp(-dtw / scale), 0 when a series is all zero.

    By default every pair is returned, as the result is defined. With `min_similarity` only
    pairs of at least that degree are, and a pair whose end points alone are too far apart
    never reaches the kernel: every warp path matches first to first and last to last, so
    the sum of those two distances is a lower bound of the distance."""
    spark = cur_points.sparkSession
    if blocks is None:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = (_blocks(n), _blocks(n) // 2 or 1)
    a = cur_points.select(cur_key, F.col("idx").alias("a_idx"), F.col("z").alias("a_z"))
    b = past_points.select(past_key, F.col("idx").alias("b_idx"), F.col("z").alias("b_z"))
    pairs = pair_series(a, b, cur_key, past_key, *blocks)
    if min_similarity > 0:
        pairs = pairs.where(F.exp(-end_point_bound() / F.lit(float(scale))) >= min_similarity)
    dist = _distance_udf(radius, exact)("a_idx", "a_z", "b_idx", "b_z")
    with_d = pairs.select(cur_key, past_key, dist.alias("_d"))
    found = with_d.select(
        cur_key,
        past_key,
        F.coalesce(F.exp(-F.col("_d") / F.lit(float(scale))), F.lit(0.0)).alias("similarity_degree"),
        *([F.col("_d").alias("dtw_distance")] if with_distance else []),
    )
    return found.where(F.col("similarity_degree") >= min_similarity) if min_similarity > 0 else found


def end_point_bound() -> Column:
    """Distance of the first points plus that of the last ones (NULL for an empty series); a
    pair of one-point series has a single match, which counts once."""

    def gap(at: int) -> Column:
        dx = F.try_element_at("a_idx", F.lit(at)) - F.try_element_at("b_idx", F.lit(at))
        return F.hypot(dx.cast("double"), F.try_element_at("a_z", F.lit(at)) - F.try_element_at("b_z", F.lit(at)))

    single = (F.size("a_idx") == 1) & (F.size("b_idx") == 1)
    return gap(1) + F.when(single, 0.0).otherwise(gap(-1))


#: Hours that one box of an envelope covers.
BOX_HOURS = 6
#: Pairs of the first round of the kernel; each further round takes twice as many.
FIRST_PAIRS = 64
#: Room for rounding when a bound is compared with a value.
SLACK = 1e-9


def with_envelope(points: DataFrame, hours: int = BOX_HOURS) -> DataFrame:
    """`points` with `boxes`: per range of `hours` that has points, their number, their first
    and last hour and their smallest and largest z, as five numbers behind each other."""

    @pandas_udf("array<double>")
    def boxes(idx: pd.Series, z: pd.Series) -> pd.Series:
        out = []
        for t, v in zip(idx, z):
            if not len(t):
                out.append([])
                continue
            t, v = np.asarray(t, float), np.asarray(v, float)
            first = np.concatenate([[0], np.flatnonzero(np.diff(t // hours)) + 1])
            size = np.diff(np.append(first, len(t)))
            out.append(np.stack([size, t[first], t[first + size - 1], np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)], axis=1).ravel())
        return pd.Series(out)

    return points.withColumn("boxes", boxes("idx", "z"))


def envelope_bound(a: np.ndarray, b: np.ndarray) -> float:
    """A lower bound of the warp distance from two envelopes (boxes of five numbers a row):
    every point matches some point of the other curve, at least as far as the boxes are."""
    gap_t = np.maximum(0, np.maximum(a[:, None, 1] - b[None, :, 2], b[None, :, 1] - a[:, None, 2]))
    gap_z = np.maximum(0, np.maximum(a[:, None, 3] - b[None, :, 4], b[None, :, 3] - a[:, None, 4]))
    gap = np.hypot(gap_t, gap_z)
    return float(max(a[:, 0] @ gap.min(axis=1), b[:, 0] @ gap.min(axis=0)))


def _bound_udf():
    @pandas_udf(DoubleType())
    def bound(a: pd.Series, b: pd.Series) -> pd.Series:
        boxes = [(np.asarray(x, float).reshape(-1, 5), np.asarray(y, float).reshape(-1, 5)) for x, y in zip(a, b)]
        return pd.Series([envelope_bound(x, y) if len(x) and len(y) else None for x, y in boxes], dtype="float64")

    return bound


class TopAlerts(NamedTuple):
    alerts: DataFrame
    kernel_pairs: int
    all_pairs: int


def top_alerts_bounded(
    cur_points: DataFrame,
    past_points: DataFrame,
    frequency: DataFrame,
    k: int = 1,
    cur_key: str = "current_keyword",
    past_key: str = "past_issue_name",
    radius: int = DTW_RADIUS,
    scale: float = SIMILARITY_SCALE,
    exact: bool = False,
    first_pairs: int = FIRST_PAIRS,
) -> TopAlerts:
    """U2 + J4 + J5 + T2: the k pairs of highest alert value = similarity x frequency, in the
    order of `top_alerts`, and how many of all pairs reached the kernel.

    The kernel runs in rounds, on the pairs of highest bound first; after each round pairs
    whose bound is below the k-th best value are out. The bounds are: the frequency itself
    (no pairing needed), and the frequency times exp(-bound / scale) with the larger of the
    envelopes' and the end points' distances. They hold for the exact distance and so for
    the approximate one, which is never smaller. Only k rows and the counts reach the
    driver. Without past issues the alert values are null, as in `alert_table`."""
    spark = cur_points.sparkSession
    root = scratch_path(spark, "top-alerts")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    cur = keep(with_envelope(cur_points).join(frequency.select(cur_key, "total_frequency"), cur_key), "current")
    past = keep(with_envelope(past_points), "past")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_cur, n_past = cur.count(), past.count()
    if not n_past:
        none = spark.createDataFrame([], f"{cur_key} string, {past_key} string, similarity_degree double")
        return TopAlerts(top_alerts(alert_table(frequency, none), k), 0, 0)
    names = [cur_key, past_key]
    a = [F.col("idx").alias("a_idx"), F.col("z").alias("a_z")]
    b = [F.col("idx").alias("b_idx"), F.col("z").alias("b_z")]

    def measured(pairs: DataFrame) -> DataFrame:
        """The alert rows of some pairs, by the kernel."""
        full = pairs.select(*names).repartition(tasks).join(cur.select(cur_key, "total_frequency", *a), cur_key).join(past.select(past_key, *b), past_key)
        d = full.select(*names, "total_frequency", _distance_udf(radius, exact)("a_idx", "a_z", "b_idx", "b_z").alias("_d"))
        found = d.withColumn("similarity_degree", F.coalesce(F.exp(-F.col("_d") / F.lit(float(scale))), F.lit(0.0)))
        return found.withColumn("alert_value", alert_value("similarity_degree", "total_frequency")).drop("_d")

    def floor(best: DataFrame) -> float:
        values = [r["alert_value"] for r in best.collect()]  # k rows
        return min(values) * (1 - SLACK) if len(values) == k else -math.inf

    def crossed(left: DataFrame, right: DataFrame) -> DataFrame:
        return pair_series(left, right, cur_key, past_key, _blocks(tasks), _blocks(tasks) // 2 or 1)

    # the most frequent keywords with every past issue give a first k-th best value
    top = keep(cur.orderBy(F.desc("total_frequency"), cur_key).limit(max(1, first_pairs // n_past)).select(cur_key), "top")
    best = keep(top_alerts(measured(crossed(top, past.select(past_key))), k), "best")
    used, least = top.count() * n_past, floor(best)
    # envelopes of the keywords that can still be among the best
    few = cur.join(top, cur_key, "left_anti").where(F.col("total_frequency") >= least)
    each = crossed(few.select(cur_key, "total_frequency", "boxes", *a), past.select(past_key, F.col("boxes").alias("b_boxes"), *b))
    low = F.greatest(_bound_udf()("boxes", "b_boxes"), end_point_bound())
    most = F.coalesce(F.col("total_frequency") * F.exp(-low / F.lit(float(scale))), F.lit(0.0))
    pairs = keep(each.select(*names, most.alias("most")).where(F.col("most") >= least), "bounds")
    taken: list[str] = []
    while True:
        left = pairs.where(F.col("most") >= least)
        if taken:
            left = left.join(spark.read.schema(pairs.schema).parquet(*taken), names, "left_anti")
        chosen = keep(left.orderBy(F.desc("most"), *names).limit(first_pairs << len(taken)), f"chosen{len(taken)}")
        n = chosen.count()
        if not n:
            return TopAlerts(top_alerts(best, k), used, n_cur * n_past)
        best = keep(top_alerts(measured(chosen).unionByName(best), k), f"best{len(taken)}")
        taken.append(f"{root}/chosen{len(taken)}")
        used, least = used + n, floor(best)
