"""Rank keyword x past-issue alerts and format the top one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import alert_value


def alert_table(frequency: DataFrame, similarity: DataFrame) -> DataFrame:
    """J5 + M4: frequency left join similarity on keyword; alert_value = similarity x frequency."""
    a = frequency.join(similarity, "current_keyword", "left")
    return a.withColumn("alert_value", alert_value("similarity_degree", "total_frequency"))


def top_alerts(alerts: DataFrame, k: int = 1) -> DataFrame:
    """The k highest alert values (nulls last, ties by keyword then past issue).
    orderBy + limit plans as TakeOrderedAndProject: each partition keeps its top k."""
    return alerts.orderBy(F.desc_nulls_last("alert_value"), F.asc("current_keyword"), F.asc_nulls_last("past_issue_name")).limit(k)


def alert_message(top: DataFrame, model: str | None = None) -> DataFrame:
    """AlarmName / NewStateValue / NewStateReason columns and one sentence over them
    (the message is a row, nothing is sent)."""
    name = F.col("current_keyword") if not model else F.concat_ws(" ", F.lit(model), F.col("current_keyword"))
    return top.select(
        "current_keyword",
        "past_issue_name",
        "alert_value",
        name.alias("AlarmName"),
        F.col("alert_value").cast("string").alias("NewStateValue"),
        F.coalesce(F.col("past_issue_name"), F.lit("")).alias("NewStateReason"),
        F.format_string("%s: alert value %.4f, similar to %s", name, F.coalesce("alert_value", F.lit(0.0)), F.coalesce("past_issue_name", F.lit("no past issue"))).alias("sentence"),
    )
