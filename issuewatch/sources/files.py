"""Snapshot files in, tables out.

Crawler files are named `<source>_<model>_<ISO time>.jsonl` (parsed by
`parse_file_meta`); files written by this engine live in
`<root>/snapshot_key=<time>/data_source=<source>/`. Everything is one DataFrame plan:
the file listing comes from the reader's hidden `_metadata` column (no driver-side
listing loop), the url dedupe is one partial `max_by` aggregate keyed by the file's
folder, and the union of sources is a single multi-file read with a declared schema
(so missing columns are NULL, not misaligned).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Declared schema of a raw post line; `comments` is kept as raw JSON text and parsed by
# the per-source rules (C1), `viewed`/`liked`/`num_of_comments` as text (naver writes
# `조회 2,394`), so one schema reads all four sources.
RAW_POST = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("modified_at", T.StringType()),
        T.StructField("viewed", T.StringType()),
        T.StructField("liked", T.StringType()),
        T.StructField("num_of_comments", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("sentiment", T.DoubleType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

# Partition columns of the warehouse tables that are appended to once per snapshot.
SNAPSHOT_PARTITIONS = ("snapshot_date", "snapshot_hour")

FILE_TIME = r"(\d{4}-\d{2}-\d{2})[T_ ](\d{2})[:-](\d{2})[:-](\d{2})"


def parse_file_meta(path: Column) -> dict[str, Column]:
    """`.../<source>_<model>_<time>.<ext>` -> data_source, model, snapshot time.
    Accepts `T` or `_` between date and time and `:` or `-` inside the time (SURVEY D20);
    url-encoded keys are decoded first."""
    name = F.regexp_extract(F.url_decode(path), r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    t = F.regexp_extract(stem, FILE_TIME + "$", 0)
    head = F.regexp_replace(stem, "_" + FILE_TIME + "$", "")
    ts = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(t, "T|_", " "), r"(\d{2})-(\d{2})-(\d{2})$", "$1:$2:$3"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return {
        "file_name": name,
        "data_source": F.regexp_extract(head, r"^([^_]+)", 1),
        "model": F.regexp_extract(head, r"^[^_]+_(.*)$", 1),
        "snapshot": ts,
    }


def read_jsonl_tolerant(spark: SparkSession, paths, schema: T.StructType = RAW_POST, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S3: read JSON lines; broken lines go to a quarantine DataFrame instead of failing
    the job. Returns (good rows with file metadata, quarantine rows by their text and their
    bytes). A line whose bytes are no UTF-8 is broken too: the reader keeps its bytes, and
    decoding it would put replacement characters in their place. Columns of the folder
    names (`key=value`, below `base` if given) override those of the records."""
    lines = (spark.read.option("basePath", base) if base else spark.read).text(paths)
    folders = [c for c in lines.columns if c != "value"]
    kinds = {f.name: f.dataType for f in schema.fields if f.name != "_corrupt_record"}
    fields = [T.StructField(n, t) for n, t in kinds.items() if n not in folders]
    record = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("value", record, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    meta = [F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_modification_time").alias("file_mtime")]
    df = lines.where(F.trim("value") != "").select("*", *meta).withColumn("m", parsed)
    broken = F.col("m").isNull() | F.col("m._corrupt_record").isNotNull() | ~F.is_valid_utf8("value")
    columns = [F.col(n).cast(t).alias(n) if n in folders else F.col(f"m.{n}") for n, t in kinds.items()]
    good = df.where(~broken).select(*columns, "src_file", "file_mtime")
    bad = df.where(broken).select("src_file", F.col("value").alias("_corrupt_record"), F.col("value").cast("binary").alias("raw"))
    return good, bad


def drop_failed_posts(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Drop `{}` / null / blank-date rows."""
    return df.filter(F.length(F.trim(F.col(col))) > 0)


def file_listing(df: DataFrame) -> DataFrame:
    """Distinct files of a read with their modification time and parsed name."""
    m = parse_file_meta(F.col("src_file"))
    return df.select("src_file", "file_mtime").distinct().select("src_file", "file_mtime", *[v.alias(k) for k, v in m.items()])


def newest_files(files: DataFrame, k: int = 4, by: str = "snapshot") -> DataFrame:
    """The k most recently modified files per snapshot (ties by name)."""
    w = Window.partitionBy(by).orderBy(F.desc("file_mtime"), F.asc("file_name"))
    return files.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def complete_snapshots(files: DataFrame, required: int = 4) -> DataFrame:
    """Snapshots that have files from >= `required` distinct sources."""
    g = files.groupBy("snapshot").agg(F.count_distinct("data_source").alias("n_sources"), F.max("file_mtime").alias("last_mtime"))
    return g.withColumn("is_complete", F.col("n_sources") >= required)


def latest_snapshot(files: DataFrame) -> Column:
    """Snapshot of the newest file overall (scalar subquery)."""
    return files.select(F.max(F.struct("file_mtime", "snapshot"))["snapshot"]).scalar()


def snapshot_listing(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame:
    """(snapshot_key, data_source, file_mtime) of a stage folder, from file metadata only:
    the `binaryFile` source without its content column opens no file. With `snapshot`
    given only its folder is listed."""
    folder = f"snapshot_key={snapshot}" if snapshot else "snapshot_key=*"
    found = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{folder}/data_source=*")
    path = F.url_decode("path")
    return found.select(
        F.regexp_extract(path, r"/snapshot_key=([^/]*)/", 1).alias("snapshot_key"),
        F.regexp_extract(path, r"/data_source=([^/]*)/", 1).alias("data_source"),
        F.col("modificationTime").alias("file_mtime"),
    )


def read_snapshot_lines(
    spark: SparkSession, root: str, snapshot: str | None = None, k: int | None = None, with_model: bool = False
) -> tuple[DataFrame, DataFrame]:
    """S1 + S3: (posts, broken lines) of one snapshot of a stage folder laid out as
    `<root>/snapshot_key=<time>/data_source=<src>/part-*.json` (as `write_posts_jsonl`
    writes it). Takes the newest snapshot when none is given, and all its sources, or with
    `k` only the k most recently written ones (S2). A named snapshot's folder alone is
    listed and read. Drops failed rows (P4) and `modified_at` (P3), and dedupes by url
    within each source file set (A6). `with_model` stamps each post with the model in its
    file's name (P10, see `parse_file_meta`); it is empty where the name holds none, and of
    a url in the files of several models one post is kept, by the same order."""
    schema = T.StructType(RAW_POST.fields + [T.StructField("snapshot_key", T.StringType()), T.StructField("data_source", T.StringType())])
    root = root.rstrip("/")
    if snapshot is None:
        snapshot = snapshot_listing(spark, root).select(F.max("snapshot_key")).first()[0]  # one name
    good, bad = read_jsonl_tolerant(spark, f"{root}/snapshot_key={snapshot}", schema, base=root)
    rows = drop_failed_posts(good)
    if with_model:
        rows = rows.withColumn("model", parse_file_meta(F.col("src_file"))["model"])
    rows = rows.drop("modified_at", "src_file", "file_mtime")
    if k is not None:
        listing = snapshot_listing(spark, root, snapshot)
        per_source = listing.groupBy("snapshot_key", "data_source").agg(F.max("file_mtime").alias("file_mtime"))
        w = Window.partitionBy("snapshot_key").orderBy(F.desc("file_mtime"), F.asc("data_source"))
        chosen = per_source.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).select("snapshot_key", "data_source")
        rows = rows.join(chosen, ["snapshot_key", "data_source"], "left_semi")
    return dedupe_by_url(rows, ["snapshot_key", "data_source"], ["created_at", "viewed", "title", "content", *(["model"] if with_model else [])]), bad


def read_snapshot(spark: SparkSession, root: str, snapshot: str | None = None, k: int | None = None) -> DataFrame:
    """The posts of `read_snapshot_lines`."""
    return read_snapshot_lines(spark, root, snapshot, k)[0]


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """X1 + P3: the rows of all sources under one schema, by column name; a column that a
    source lacks is NULL there, and `modified_at` is dropped."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.drop("modified_at")


def dedupe_by_url(df: DataFrame, scope: list[str], order: list[str], url: str = "url") -> DataFrame:
    """One row per url within `scope`; the survivor is the row with the largest
    `order` values (deterministic, unlike dropDuplicates). max_by is a partial
    aggregate, so a url repeated in a third of the rows is pre-reduced map-side."""
    keys = scope + [url]
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return g.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def write_posts_jsonl(df: DataFrame, out: str, partition_cols=("snapshot_key", "data_source"), compression: str = "none") -> None:
    """UTF-8 JSON lines (non-ASCII kept), one folder per snapshot and source; with
    `compression` (as "gzip") compressed files, which the readers here take as well.

    The rows are rebalanced on the folder columns: AQE gathers small folders into one
    task each and splits a folder that holds a large share of the rows over several
    tasks (and files), by measured size."""
    df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).json(out, compression=compression)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: tuple[str, ...] = SNAPSHOT_PARTITIONS) -> None:
    """Append / overwrite a Parquet table. Appends are idempotent per snapshot: the
    table is partitioned by snapshot date *and* hour, and dynamic partition overwrite
    replaces only the pairs being written. A replayed batch does not duplicate rows, and
    an hourly batch leaves the day's other hours alone."""
    w = (df.hint("rebalance", *partition_by) if partition_by else df).write.option("compression", "zstd")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.mode("overwrite" if partition_by else mode).parquet(path)


def with_snapshot_partitions(df: DataFrame, snapshot: Column) -> DataFrame:
    """`df` with the partition columns of its snapshot time."""
    date, hour = SNAPSHOT_PARTITIONS
    return df.withColumns({date: F.to_date(snapshot), hour: F.hour(snapshot)})


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of a few paths that exist, on whatever store they are."""
    return [p for p in paths if (lambda path, fs: fs.exists(path))(*_path(spark, p))]


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that does not exist yet."""
    old, fs = _path(spark, source)
    new, _ = _path(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def versions(spark: SparkSession, root: str, prefix: str = "version=") -> list[int]:
    """The numbers N of the folders `<root>/version=N`."""
    path, fs = _path(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern with `*` matches, in order."""
    path, fs = _path(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(path) or [])


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that nothing names any more."""
    for p in paths:
        path, fs = _path(spark, p)
        fs.delete(path, True)


# Fixed value: the columns of the flat post/comment file, in their order.
POST_COMMENT_COLUMNS = ("content", "created_at", "viewed", "liked", "post_type", "num_of_comments", "seconds_per_comment")


def write_post_comment_csv(rows: DataFrame, path: str) -> None:
    """The flat post/comment file, header and 7 columns."""
    write_csv(rows.select(*POST_COMMENT_COLUMNS), path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header + columns as CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)
