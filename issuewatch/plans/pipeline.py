"""The reference's hourly job end to end, as one Spark program.

extract (newest snapshot) -> raw_data append (idempotent per snapshot hour) ->
current_issue (dense keyword x hour) written first and read back (lineage cut: the
four later outputs read the written table, not a recomputation) -> frequency,
raw_data_view, similarity -> alert. Each output is one write job; T1 ordering is that of
the keywords within a partition before their hours are laid out, never a sort of the dense
rows. Shuffle files go with the step that made them, and tables are written as zstd.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import alerts, issues, normalise, sentiment, similarity, views
from ..operators.keywords import extract_keywords, hashed_counts, letter_words
from ..session import scratch_path, shuffles_deleted
from ..sources import files


TABLES = ("raw_data", "snapshot_sums", "raw_data_view", "current_issue", "current_issue_frequency", "keyword_frequency", "issue_graph", "similarity", "alerts")


def written(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def append_sums(spark: SparkSession, batch: DataFrame, snapshot: Column, raw_data: str, path: str) -> DataFrame:
    """Append the batch's keyword sums to the table at `path` and return the table. A
    warehouse without it gets the sums of its whole raw_data table, once: they are written
    beside it and renamed, so a half-written table is never taken for a whole one."""
    if files.existing(spark, [path]):
        files.write_table(files.with_snapshot_partitions(issues.snapshot_sums(batch), snapshot), path)
    else:
        aside = f"{path}_new"
        sums = issues.snapshot_sums(spark.read.parquet(raw_data))
        files.with_snapshot_partitions(sums, F.col("snapshot")).hint("rebalance", *files.SNAPSHOT_PARTITIONS).write.mode("overwrite").partitionBy(
            *files.SNAPSHOT_PARTITIONS
        ).parquet(aside)
        files.rename(spark, aside, path)
    return spark.read.parquet(path)


def run_snapshot(
    spark: SparkSession,
    batch: DataFrame,
    history: DataFrame | None,
    past_issue: DataFrame,
    snapshot: Column,
    out_root: str,
    model: str | None = None,
    graph_issue: str | None = None,
    exact: bool = False,
) -> dict[str, str]:
    """Run one snapshot. `batch`: current posts (keywords array, sums columns, url ...);
    `history`: earlier raw_data rows, or None to go by the warehouse's own tables: the
    window is then added up from the `snapshot_sums` table, which the run extends by its batch. `graph_issue`: the one past issue that the graph view shows.
    `exact`: exact warp distances. The view of raw_data grows by the snapshot's rows, as the
    table does; where `history` comes from elsewhere it is written anew.
    Returns the written table paths."""
    out = out_root.rstrip("/")
    paths = {n: f"{out}/{n}" for n in TABLES}
    with shuffles_deleted(spark):
        files.write_table(files.with_snapshot_partitions(batch, snapshot), paths["raw_data"])
        if history is None:
            cur = issues.current_issue_from_sums(append_sums(spark, batch, snapshot, paths["raw_data"], paths["snapshot_sums"]), batch, snapshot)
        else:  # the reference's later reads see the appended batch
            hist = history.unionByName(batch, allowMissingColumns=True)
            cur = issues.current_issue(hist, batch, snapshot)
        written(cur, paths["current_issue"])  # in the order of keywords and hours
        cur = spark.read.parquet(paths["current_issue"])
        written(issues.total_frequency(cur), paths["current_issue_frequency"])
        written(issues.keyword_frequency(cur), paths["keyword_frequency"])
        if history is None:
            files.write_table(files.with_snapshot_partitions(normalise.raw_data_view(batch), snapshot), paths["raw_data_view"])
        else:
            written(normalise.raw_data_view(hist), paths["raw_data_view"])
        shown = past_issue if graph_issue is None else past_issue.where(F.col("past_issue_name") == graph_issue)
        written(views.issue_graph(shown, cur, snapshot), paths["issue_graph"])
        cp = similarity.series_points(cur, "current_keyword", "created_at", "current_issueization")
        pp = similarity.series_points(past_issue, "past_issue_name", "created_at", "past_issueization")
        written(similarity.series_similarity(cp, pp, exact=exact), paths["similarity"])
        sim = spark.read.parquet(paths["similarity"])
        top = alerts.alert_message(alerts.top_alerts(alerts.alert_table(spark.read.parquet(paths["current_issue_frequency"]), sim), 1), model)
        written(top, paths["alerts"])
    return paths


def prepare_posts(raw: DataFrame, snapshot: Column, scorer, tokenizer=letter_words, encoder=hashed_counts) -> tuple[DataFrame, DataFrame]:
    """Raw crawled posts -> (raw_data rows, quarantine): normalised, scored, with keywords
    of title and content. `scorer` is as in `sentiment.score_sentiment`; posts are known by
    their url within a source."""
    good, quarantine = normalise.normalise_posts(raw, snapshot)
    good = good.drop("sentiment", "keywords").withColumn("_key", F.concat_ws("\n", "data_source", "url"))
    good = good.withColumn("_text", text.newlines_to_blank(text.concat_title_content("title", "content")))
    scored = sentiment.score_sentiment(good, "_key", "_text", scorer=scorer).select("_key", "sentiment").dropDuplicates(["_key"])
    found = extract_keywords(good, "_key", "_text", tokenizer=tokenizer, encoder=encoder)
    ranked = F.transform(F.array_sort(F.collect_set(F.struct("rank", "keyword"))), lambda x: x["keyword"])  # at most five
    words = found.groupBy("_key").agg(ranked.alias("keywords"))
    rows = good.join(scored, "_key", "left").join(words, "_key", "left")
    return normalise.to_raw_data(rows.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>"))), snapshot), quarantine


def run_raw_snapshot(
    spark: SparkSession, raw_root: str, snapshot_key: str, past_issue: DataFrame, out_root: str, scorer, model: str | None = None, graph_issue: str | None = None
) -> dict[str, str]:
    """The whole job for one snapshot folder of raw posts (`files.write_posts_jsonl`): read,
    normalise with quarantine, score, extract keywords, then `run_snapshot` on top of the
    raw_data table. The prepared batch is written once and read by every later step. Without
    `model` each post carries the model in its file's name, and the alert names none."""
    snapshot = F.try_to_timestamp(F.lit(snapshot_key), F.lit("yyyy-MM-dd'T'HH-mm-ss"))
    raw, broken = files.read_snapshot_lines(spark, raw_root, snapshot_key, with_model=model is None)
    if model is not None:
        raw = raw.withColumn("model", F.lit(model))
    out = out_root.rstrip("/")
    with shuffles_deleted(spark):
        written(broken, f"{out}/broken_lines/snapshot_key={snapshot_key}")
        posts = scratch_path(spark, "posts")  # each url once: shuffled by one step, read by two
        written(raw, posts)
        batch, quarantine = prepare_posts(spark.read.schema(raw.schema).parquet(posts), snapshot, scorer)
        written(quarantine, f"{out}/quarantine/snapshot_key={snapshot_key}")
        written(batch, f"{out}/batch/snapshot_key={snapshot_key}")
        files.remove(spark, [posts])
    batch = spark.read.parquet(f"{out}/batch/snapshot_key={snapshot_key}")
    return run_snapshot(spark, batch, None, past_issue, snapshot, out, model, graph_issue)
