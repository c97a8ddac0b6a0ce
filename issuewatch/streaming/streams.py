"""The event-driven parts of the reference as Structured Streaming.

* `hourly_issue_stream` (R1, R5): file source -> post projection -> per batch partial
  sums per (hour, keyword), one `batch_id=` folder each. `read_hourly_issue` adds the
  partial sums up: every row counts, however late, and open hours are there too; an
  hour is `closed` once the newest post is past its end and the allowed delay.
* `snapshot_gate_stream` (R3, S11, R6): posts once per (snapshot, source, url), written
  under their snapshot; the snapshots that became complete (>= 4 sources) in a batch are
  recorded once, and `run_pending` starts a job once for each. A batch is compared with the
  stored posts of its own snapshots, so a post is never too late and no state is held
  beside the table.
* `committed_stage_stream` (R2, R4): a stage whose batches appear whole or not at all, so
  that its folder can be the source of the next stage; `publish_model` / `latest_model`
  give a stage its versioned model table.
* `replayable_stage_stream` (R2, R4): stateless per-row stages written idempotently;
  running it again over the same files leaves the table unchanged.
* `compact_messages_stream` (S6, R4): messages to JSON lines per snapshot and source,
  broken ones to a quarantine.

Every micro-batch writes a folder of its own number and a replay overwrites just that
(R4); no batch touches the rows of another. All streams use `trigger(availableNow=True)`
in tests (drain what is there, stop). The checkpoint of a stream lies beside its output
(`<output>-checkpoint`) unless one is given, so a second call goes on where the first
one stopped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import issue_score
from ..sources import files

WATERMARK_DELAY = "1 hour"


def _run(writer, available_now: bool = True):
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def _checkpoint(out: str, given: str | None) -> str:
    return given or f"{out.rstrip('/')}-checkpoint"


def batch_folder_sink(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: batch N -> `<out>/batch_id=N`, overwritten on replay."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


HOUR_SUMS = ("num_of_comments", "viewed", "liked", "sentiment")


def hourly_issue_stream(
    spark: SparkSession,
    events: DataFrame,
    to_posts: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str | None = None,
    compact_every: int = 8,
) -> str:
    """R1 + R5: partial keyword sums per hour from a streaming events DataFrame. No state is
    kept between batches, so nothing is too late to be counted. Each `compact_every`
    batches the partial sums before the newest are merged (`compact_hourly`)."""
    ex = to_posts(events).select(F.explode("keywords").alias("current_keyword"), "created_at", *HOUR_SUMS)
    rows = ex.withColumn("hour", F.date_trunc("hour", "created_at"))

    def on_batch(df: DataFrame, batch_id: int) -> None:
        sums = [F.sum(c).alias(c) for c in HOUR_SUMS]
        part = df.groupBy("hour", "current_keyword").agg(*sums, F.max("created_at").alias("newest"))
        batch_folder_sink(out)(part, batch_id)
        if (batch_id + 1) % compact_every == 0:
            compact_hourly(spark, out)

    _run(rows.writeStream.option("checkpointLocation", _checkpoint(out, checkpoint)).foreachBatch(on_batch))
    return out


MANIFEST = "path string, through bigint"


def _live_parts(spark: SparkSession, out: str) -> tuple[list[str], int, list[int]]:
    """The merged segments that the newest manifest names, the last batch in them, and the
    batches behind it."""
    root = f"{out.rstrip('/')}-manifest"
    rows = latest_model(spark, root, MANIFEST)[0].collect() if files.versions(spark, root) else []  # a few segments
    through = max((r["through"] for r in rows), default=-1)
    return [r["path"] for r in rows], through, [n for n in files.versions(spark, out, "batch_id=") if n > through]


#: Merged segments beside each other; one more, and all become one.
SEGMENTS = 8


def compact_hourly(spark: SparkSession, out: str, most: int = SEGMENTS) -> None:
    """Merge the batches since the last call into a segment, and the segments into one when
    there are too many, then publish the manifest that names the live ones. The newest
    batch is left out, as it may be replayed. A reader takes one manifest, so it sees each
    batch once, merged or not; a stop between write and manifest leaves an unnamed folder.
    What the manifest before last no longer needed is deleted."""
    segments, through, batches = _live_parts(spark, out)
    done = batches[:-1]
    if not done:
        return
    base = out.rstrip("/")
    merge = segments if len(segments) >= most else []
    kept = [p for p in segments if p not in merge]
    parts = spark.read.schema(PARTIAL_SUMS).parquet(*merge, *[f"{base}/batch_id={n}" for n in done])
    sums = [F.sum(c).cast(dict(PARTIAL_TYPES)[c]).alias(c) for c in HOUR_SUMS]
    path = f"{base}-segments/{done[0] if not merge else 0}-{done[-1]}"
    parts.groupBy("hour", "current_keyword").agg(*sums, F.max("newest").alias("newest")).write.mode("overwrite").parquet(path)
    publish_model(spark.createDataFrame([(p, done[-1]) for p in [*kept, path]], MANIFEST).coalesce(1), f"{base}-manifest")
    # readers that took the manifest before this one may still need what it names
    old = [f"{base}/batch_id={n}" for n in files.versions(spark, out, "batch_id=") if n <= through]
    before = files.versions(spark, f"{base}-manifest")[:-1]
    named = {*kept, path, *segments}
    if len(before) > 1:
        older = spark.read.schema(MANIFEST).parquet(f"{base}-manifest/version={before[-2]}").collect()
        old += [r["path"] for r in older if r["path"] not in named]
    files.remove(spark, old)


PARTIAL_TYPES = (("num_of_comments", "bigint"), ("viewed", "bigint"), ("liked", "bigint"), ("sentiment", "double"))
PARTIAL_SUMS = "hour timestamp, current_keyword string, " + ", ".join(f"{c} {t}" for c, t in PARTIAL_TYPES) + ", newest timestamp"


def read_hourly_issue(spark: SparkSession, out: str, delay: str = WATERMARK_DELAY) -> DataFrame:
    """The hourly issue table over all batches so far: one row per (hour, keyword). Reads the
    merged segments and the batches since, so the number of files stays bounded."""
    segments, _, batches = _live_parts(spark, out)
    parts = spark.read.schema(PARTIAL_SUMS).parquet(*segments, *[f"{out.rstrip('/')}/batch_id={n}" for n in batches])
    sums = [F.sum(c).cast("double" if c == "sentiment" else "bigint").alias(c) for c in HOUR_SUMS]
    total = parts.groupBy("hour", "current_keyword").agg(*sums)
    newest = parts.select(F.max("newest")).scalar()
    return total.select(
        F.col("hour").alias("created_at"),
        "current_keyword",
        issue_score("viewed", "liked", "num_of_comments").alias("current_issueization"),
        *HOUR_SUMS,
        (F.col("hour") + F.expr("INTERVAL 1 HOUR") <= newest - F.expr(f"INTERVAL {delay}")).alias("closed"),
    )


SNAPSHOT_KEYS = ("file_create_time", "data_source", "url")


def snapshot_gate_stream(
    spark: SparkSession,
    posts: DataFrame,
    raw_table: str,
    processed_table: str,
    required: int = 4,
    order: tuple[str, ...] = ("created_at",),
    checkpoint: str | None = None,
    on_complete: Callable[[dt.datetime], None] | None = None,
    newest_only: bool = False,
) -> str:
    """R3 + S11 + R6: append posts to `raw_table`, each (snapshot, source, url) once over all
    batches, then record newly complete snapshots once in `processed_table` and start
    `on_complete` once for each, or with `newest_only` for the newest one (see `run_pending`).

    The stored posts are the state: a batch is anti-joined with those of its own snapshots'
    days only, read from their folders, so a post counts however old it is (a crawl looks back
    two days) and what must be read does not grow with the history. Of one batch's equal
    keys the post with the largest `order` values stays. A replayed batch leaves its own
    rows out of the comparison and overwrites them. Rows with a null key column are kept
    apart by the other two."""
    keys = list(SNAPSHOT_KEYS)
    spark.createDataFrame([], PROCESSED).write.mode("append").parquet(f"{processed_table}/batch=-1")
    if on_complete is not None:  # what an earlier run recorded but did not finish
        run_pending(spark, processed_table, on_complete, newest_only)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.withColumn("_tie", F.xxhash64(*df.columns)).persist()
        try:
            days = df.select(F.to_date("file_create_time").alias("day")).distinct()
            folders = [f"{raw_table}/{snapshot_folder(r['day'])}" for r in days.collect()]  # the days of a batch's snapshots
            here = files.existing(spark, folders)
            batch = files.dedupe_by_url(df, keys[:2], [*order, "_tie"]).drop("_tie")
            held = None
            if here:
                stored = spark.read.option("basePath", raw_table).schema(raw_schema(df)).parquet(*here).where(F.col("batch") != batch_id)
                held = stored.select(*keys)
                same = [F.col(f"b.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
                batch = batch.alias("b").join(held.alias("h"), same, "left_anti")
            fresh = batch.withColumns({"snapshot_date": F.to_date("file_create_time"), "batch": F.lit(batch_id)})
            write = fresh.write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
            write.partitionBy("snapshot_date", "batch").parquet(raw_table)
            here = files.existing(spark, folders)
            if not here:
                return
            stored = spark.read.option("basePath", raw_table).schema(raw_schema(df)).parquet(*here)
            counts = stored.groupBy("file_create_time").agg(F.count_distinct("data_source").alias("n_sources"))
            done = spark.read.schema(f"{PROCESSED}, batch int").parquet(processed_table).where(F.col("batch") != batch_id).select("file_create_time")
            fresh = counts.where(F.col("n_sources") >= required).join(done, "file_create_time", "left_anti")
            fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint")).coalesce(1).write.mode("overwrite").parquet(f"{processed_table}/batch={batch_id}")
        finally:
            df.unpersist()
        if on_complete is not None:
            run_pending(spark, processed_table, on_complete, newest_only)

    _run(posts.writeStream.option("checkpointLocation", _checkpoint(processed_table, checkpoint)).foreachBatch(on_batch))
    return processed_table


PROCESSED = "file_create_time timestamp, n_sources bigint, batch_id bigint"


def snapshot_folder(day: dt.date | None) -> str:
    return f"snapshot_date={day or '__HIVE_DEFAULT_PARTITION__'}"


def raw_schema(posts: DataFrame) -> T.StructType:
    """The schema of the gate's table of these posts, so that reading it opens no file for that."""
    fields = [f for f in posts.schema.fields if f.name not in ("_tie",)]
    return T.StructType([*fields, *T._parse_datatype_string("snapshot_date date, batch int").fields])


def run_pending(spark: SparkSession, processed_table: str, job: Callable[[dt.datetime], None], newest_only: bool = False) -> list[dt.datetime]:
    """Start `job` with each recorded snapshot that has no commit marker, oldest first, and
    set the marker once it returns. A job that is stopped half way is started again by the
    next call, so it must overwrite what it wrote; a finished one is never started again.
    With `newest_only` the job is started for the newest of them alone, which stands for the
    others too. Returns the snapshots that the job was started with."""
    recorded = spark.read.schema(f"{PROCESSED}, batch int").parquet(processed_table).select("file_create_time").where("file_create_time is not null").distinct()
    marks = f"{processed_table.rstrip('/')}-done"
    if files.existing(spark, [marks]):
        recorded = recorded.join(spark.read.schema("file_create_time timestamp").parquet(marks), "file_create_time", "left_anti")
    pending = sorted(r[0] for r in recorded.collect())  # the snapshots since the last call
    groups = [pending] if newest_only and pending else [[t] for t in pending]
    for group in groups:
        job(group[-1])
        rows = spark.createDataFrame([(t,) for t in group], "file_create_time timestamp")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{marks}/snapshot={group[-1]:%Y-%m-%dT%H-%M-%S}")
    return [group[-1] for group in groups]


def committed_stage_stream(
    spark: SparkSession, rows: DataFrame, stage: Callable[[DataFrame], DataFrame], table: str, checkpoint: str | None = None
) -> str:
    """R2 + R4: a stage whose output folder is the next stage's source. A batch is written
    aside and then renamed to `<table>/batch_id=N`, which commits it; a batch that has been
    committed is not written again when it is replayed. So a reader of the folder sees
    whole batches only, each file once and for ever, however often the stage was stopped.
    (The rename has to be atomic, as on HDFS; on other stores use a table format.)"""

    def on_batch(df: DataFrame, batch_id: int) -> None:
        final = f"{table}/batch_id={batch_id}"
        if files.existing(spark, [final]):
            return
        aside = f"{table}/_staging/batch_id={batch_id}"
        stage(df).write.mode("overwrite").parquet(aside)
        files.rename(spark, aside, final)

    _run(rows.writeStream.option("checkpointLocation", _checkpoint(table, checkpoint)).foreachBatch(on_batch))
    return table


def stage_files(spark: SparkSession, table: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The committed batches of a stage as the next stage's source."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(f"{table}/batch_id=*")


def publish_model(model: DataFrame, root: str) -> int:
    """Append a model table as the next version of `root`; it appears as a whole."""
    spark = model.sparkSession
    version = 1 + max(files.versions(spark, root), default=0)
    aside = f"{root}/_staging/version={version}"
    model.write.mode("overwrite").parquet(aside)
    files.rename(spark, aside, f"{root}/version={version}")
    return version


def latest_model(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, int]:
    """The newest version of a model table, looked up anew by each caller (once a batch)."""
    found = files.versions(spark, root)
    if not found:
        raise ValueError(f"no model has been published in {root}")
    return spark.read.schema(schema).parquet(f"{root}/version={max(found)}"), max(found)


def replayable_stage_stream(
    spark: SparkSession,
    posts: DataFrame,
    stage: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
    table: str,
    partition_col: str = "src_file_id",
    checkpoint: str | None = None,
) -> str:
    """R1 + R2 + R4: stateless stages; each micro-batch overwrites exactly the partitions it
    writes (dynamic partition overwrite, one partition per input file: a file is never
    split across micro-batches), so replays do not duplicate rows. A stage that returns
    (good rows, refused rows) has the latter written to `<table>-quarantine`."""

    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            out = stage(df)
            for rows, path in zip(out if isinstance(out, tuple) else (out,), (table, f"{table}-quarantine")):
                rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(partition_col).parquet(path)
        finally:
            df.unpersist()

    _run(posts.writeStream.option("checkpointLocation", _checkpoint(table, checkpoint)).foreachBatch(on_batch))
    return table


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Streaming parquet file source with a declared schema; `src_file_id` identifies
    the input file of each row (the replay unit)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path).withColumn("src_file_id", F.xxhash64(F.col("_metadata.file_path")))


def compact_messages_stream(
    spark: SparkSession,
    messages: str,
    schema: T.StructType,
    out: str,
    partition_cols=("snapshot_key", "data_source"),
    quarantine: str | None = None,
    max_files: int | None = None,
    checkpoint: str | None = None,
) -> str:
    """Drain message files (one JSON post per message) into JSON lines per snapshot,
    source and micro-batch (`<snapshot>/<source>/batch=<n>/`). A batch without messages
    writes nothing; a replayed batch overwrites its own folders and no other's.

    A message that is not a JSON object, or lacks a folder column, goes with its text to
    `quarantine` (default `<out>-quarantine`), so no message is lost."""
    r = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())]))
    raw = (r.option("maxFilesPerTrigger", max_files) if max_files else r).text(messages)
    corrupt = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_bad"})
    posts = raw.select("value", parsed.alias("m"))
    broken = F.col("m").isNull() | F.col("m._bad").isNotNull()
    for c in partition_cols:
        broken = broken | (F.coalesce(F.length(F.trim(F.col(f"m.{c}"))), F.lit(0)) == 0)
    aside = quarantine or f"{out.rstrip('/')}-quarantine"

    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.withColumn("_broken", broken).persist()
        try:
            good = df.where(~F.col("_broken")).select(*[f"m.{f.name}" for f in schema.fields], F.lit(batch_id).alias("batch"))
            if not good.isEmpty():
                write = good.hint("rebalance", *partition_cols).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
                write.partitionBy(*partition_cols, "batch").json(out)
            bad = df.where("_broken").select("value")
            if not bad.isEmpty():
                bad.write.mode("overwrite").text(f"{aside}/batch={batch_id}")
        finally:
            df.unpersist()

    _run(posts.writeStream.option("checkpointLocation", _checkpoint(out, checkpoint)).foreachBatch(on_batch))
    return out


CLOSED = "snapshot_key string, path string, batches array<int>"


def _closed(spark: SparkSession, out: str) -> list:
    root = f"{out.rstrip('/')}-closed-manifest"
    return latest_model(spark, root, CLOSED)[0].collect() if files.versions(spark, root) else []  # a row a closed snapshot


def _batches_of(spark: SparkSession, out: str, snapshot: str) -> dict[int, list[str]]:
    """The folders of one snapshot's batches."""
    found: dict[int, list[str]] = {}
    for path in files.folders(spark, f"{out.rstrip('/')}/snapshot_key={snapshot}/data_source=*/batch=*"):
        found.setdefault(int(path.rsplit("=", 1)[1]), []).append(path)
    return found


def compact_closed(spark: SparkSession, out: str, snapshot: str) -> str | None:
    """Gather a complete snapshot's batches into one folder a source (files of about 128 MB)
    and publish the manifest that names it; the gate calls this once a snapshot (`run_pending`).

    Readers go by the manifest (`read_messages`), so they see the batches or the gathered
    form, never both. Batches that arrive after that are read beside it, and gathered by a
    further call. The folders that an earlier call has gathered are deleted by the next
    one, when no reader uses the manifest before it any more. A repeated call over the
    same batches changes nothing."""
    closed = {r["snapshot_key"]: r for r in _closed(spark, out)}
    mine = closed.get(snapshot)
    batches = _batches_of(spark, out, snapshot)
    done = set(mine["batches"]) if mine else set()
    fresh = sorted(set(batches) - done)
    if not fresh:
        return mine["path"] if mine else None
    base = out.rstrip("/")
    path = f"{base}-closed/snapshot_key={snapshot}/through={fresh[-1]}"
    rows = spark.read.option("basePath", base).text([p for n in fresh for p in batches[n]]).select("data_source", "value")
    if mine:
        rows = rows.unionByName(spark.read.text(mine["path"]).select("data_source", "value"))
    rows.hint("rebalance", "data_source").write.mode("overwrite").partitionBy("data_source").text(path)
    gathered = {r["snapshot_key"]: (r["snapshot_key"], r["path"], r["batches"]) for r in closed.values()} | {snapshot: (snapshot, path, sorted(done | set(fresh)))}
    publish_model(spark.createDataFrame(list(gathered.values()), CLOSED).coalesce(1), f"{base}-closed-manifest")
    old = [p for key, r in closed.items() for n, ps in _batches_of(spark, out, key).items() if n in r["batches"] for p in ps]
    files.remove(spark, old)
    return path


def read_messages(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The messages of all snapshots: gathered ones by the manifest, the others by their batches."""
    base = out.rstrip("/")
    closed = _closed(spark, out)
    gone = {(r["snapshot_key"], n) for r in closed for n in r["batches"]}
    every = files.folders(spark, f"{base}/snapshot_key=*/data_source=*/batch=*")
    parts = [(p.rsplit("/", 3), p) for p in every]
    open_ = [p for (_, key, _, batch), p in parts if (unquote(key.removeprefix("snapshot_key=")), int(batch.removeprefix("batch="))) not in gone]
    names = [f.name for f in schema.fields]
    body = T.StructType([f for f in schema.fields if f.name not in ("snapshot_key", "data_source")])
    out_df = None
    if open_:
        out_df = spark.read.option("basePath", base).schema(schema).json(open_).select(*names)
    if closed:
        held = spark.read.option("basePath", f"{base}-closed").schema(T.StructType([*body.fields, *[f for f in schema.fields if f.name not in body.names]])).json([r["path"] for r in closed]).select(*names)
        out_df = held if out_df is None else out_df.unionByName(held)
    return spark.createDataFrame([], schema) if out_df is None else out_df
