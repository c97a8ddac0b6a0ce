"""Token-ID output: texts to token ids in Parquet list columns, and selective reads.

The file format is a Parquet folder `data/` with one row per document in ascending id
order (part files in name order), and a small Parquet folder `index/` with one row per
part file: its name, first position and first and last id. Columns of `data/`: doc_id,
part, offset (ids in the part before this document), until (offset + n_tokens), n_tokens,
tokens (list of int). Ids sit in dictionary pages, the other columns are delta-encoded
(writer version 2). Row groups and pages have set sizes and a page index. A reader with a
range of positions or document ids opens only the files that the index names and decodes
only the pages that meet the range; a reader of the metadata never touches token pages.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import per_worker

#: Appended to each document.
END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
#: Parts of words whose ids a worker remembers; the memory bound of its cache.
CACHE_PARTS = 1_000_000
#: Documents tokenised at a time.
BATCH_DOCS = 256
#: Word parts given to the tokenizer in one call.
JOIN_PARTS = 4096
#: Text of ASCII and Latin-1 letters, and the vocabulary's own splitting rule
#: for it. Other words (and its special tokens) go to the tokenizer as they are.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
SPECIAL = "<|"
#: Marks a whole word in the cache of parts.
WHOLE = "\0"


class WordEncoder:
    """Ids of whole texts, part by part.

    The vocabulary cuts a text at white space and by its splitting rule, and joins nothing
    across the cuts, so a text's ids are the ids of its parts in order. A part's ids are
    looked up once and remembered, as packed 32-bit integers. `encode_batch` equals the
    tokenizer's own result on the whole texts.
    """

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.cache_parts = cache_parts
        self.known: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return SPLIT.findall(text.lower())
        out = []
        for word in text.encode("utf-8", "surrogatepass").split():
            word = word.decode("utf-8", "surrogatepass")
            out += SPLIT.findall(word.lower()) if PLAIN.fullmatch(word) and SPECIAL not in word else [WHOLE + word]
        return out

    def learn(self, parts: set[str]) -> None:
        whole = [p for p in parts if p[0] == WHOLE]
        self.known.update((p, array("I", self.tokenizer.encode(p[1:], add_special_tokens=False).ids).tobytes()) for p in whole)
        rest = list(parts.difference(whole))
        for at in range(0, len(rest), JOIN_PARTS):
            some = rest[at : at + JOIN_PARTS]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = array("I", found.ids).tobytes()
            cuts = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(some) + 1))).tolist()
            self.known.update((p, ids[a:b]) for p, a, b in zip(some, cuts, cuts[1:], strict=False))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > self.cache_parts:
            self.known = {}
        split = [self.parts(t or "") for t in texts]
        found = [list(map(self.known.get, parts)) for parts in split]
        gaps = [(parts, ids) for parts, ids in zip(split, found, strict=True) if None in ids]
        self.learn({p for parts, ids in gaps for p, x in zip(parts, ids, strict=True) if x is None})
        for parts, ids in gaps:
            ids[:] = [self.known[p] if x is None else x for p, x in zip(parts, ids, strict=True)]
        end = array("I", [END_ID]).tobytes()
        return [np.frombuffer(b"".join([*ids, end]), np.uint32).astype(np.int32) for ids in found]


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None
) -> None:
    """Encode every whole text and write the folder `path` in the format above.

    `vocabulary` is the path of a tokenizers file; it must be readable on every
    executor. A null text counts as empty and gets the end id alone. Rows sort by id
    (nulls first); those of one id by text within a part, and by the text's hash from part
    to part. Repeated rows stay. An empty table gives a folder
    without documents. Other columns are not written. A lost executor costs its tasks:
    files appear only when Spark commits the job.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the last key spreads rows that share one id
    rows = rows.repartitionByRange(partitions, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"tokenizer {vocabulary}", lambda: WordEncoder(vocabulary))
        part, offset = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                some = batch.slice(at, BATCH_DOCS)
                ids = encoder.encode_batch(some.column("text").to_pylist())
                sizes = np.array([len(x) for x in ids], np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                columns = [some.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(offset + ends[:-1]), pa.array(offset + ends[1:]), pa.array(sizes), tokens]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "offset", "until", "n_tokens", "tokens"])
                offset += int(ends[-1])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, part int, offset long, until long, n_tokens long, tokens array<int>")
    out.write.mode("overwrite").options(
        **{
            "compression": "zstd",
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(ROW_GROUP_BYTES),
            "parquet.page.size": str(PAGE_BYTES),
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#tokens.list.element": "true",
        }
    ).parquet(f"{path}/data")
    data = spark.read.parquet(f"{path}/data")
    data = data.withColumn("file", F.col("_metadata.file_name"))
    totals = data.groupBy("part").agg(
        F.sum("n_tokens").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.min("file").alias("file")
    )
    base, index = 0, []  # one row per part file: bounded by `partitions`
    for row in totals.orderBy("part").collect():
        index.append((row["part"], base, row["n"], row["first_id"], row["last_id"], row["file"]))
        base += row["n"]
    schema = f"part int, base long, n long, first_id {kind}, last_id {kind}, file string"
    spark.createDataFrame(index, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) of every document, without reading a token."""
    return _with_start(spark, path).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of the documents that hold a token of [first, last).

    Both limits are positions in the sequence of all ids; None leaves a side open. With a
    limit, the index chooses the files, and the first and last of them are read from and up
    to the limit's offset (pushed to the scan). A range without a token gives no row.
    """
    if first is None and last is None:
        return _with_start(spark, path).select("doc_id", "start", "n_tokens", "tokens")
    parts = spark.read.parquet(f"{path}/index").where(F.col("n") > 0)
    if first is not None:
        parts = parts.where(F.col("base") + F.col("n") > first)
    if last is not None:
        parts = parts.where(F.col("base") < last)
    if first is not None and last is not None and first >= last:
        parts = parts.where(F.lit(False))
    chosen = parts.orderBy("part").collect()  # one row per part file at most
    rows = _with_start(spark, path, [r["file"] for r in chosen])
    if chosen and first is not None:
        rows = rows.where((F.col("part") > chosen[0]["part"]) | (F.col("until") > first - chosen[0]["base"]))
    if chosen and last is not None:
        rows = rows.where((F.col("part") < chosen[-1]["part"]) | (F.col("offset") < last - chosen[-1]["base"]))
    return rows.select("doc_id", "start", "n_tokens", "tokens")


def read_documents(spark: SparkSession, path: str, first_id, last_id) -> DataFrame:
    """The rows of the ids from `first_id` to `last_id`, both included: the index chooses the
    files, the limits are pushed to their scan. A null id lies in no range."""
    parts = spark.read.parquet(f"{path}/index").where((F.col("last_id") >= F.lit(first_id)) & (F.col("first_id") <= F.lit(last_id)))
    rows = _with_start(spark, path, [r["file"] for r in parts.select("file").collect()])
    return rows.where(F.col("doc_id").between(first_id, last_id)).select("doc_id", "start", "n_tokens", "tokens")


def _with_start(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """The rows of `data/`, or of these of its files, with their `start`."""
    index = spark.read.parquet(f"{path}/index").select("part", "base")
    data = spark.read.parquet(f"{path}/data")
    if files:
        data = spark.read.schema(data.schema).parquet(*[f"{path}/data/{f}" for f in files])
    elif files is not None:
        data = data.where(F.lit(False))
    return data.join(index, "part").withColumn("start", F.col("base") + F.col("offset"))


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the rows that `read_tokens` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("tokens")
            values, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("doc_id", "start", "n_tokens", "tokens")
    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
