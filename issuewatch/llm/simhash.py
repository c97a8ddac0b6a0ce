"""SimHash near-duplicate detection with pigeonhole blocks.

A fingerprint is 64 bits: bit k is set if more than half of the text's shingle hashes
have it set. Two fingerprints that differ in at most `max_bits` bits, cut into `blocks`
blocks, agree on at least `blocks - max_bits` of them, so every choice of that many
blocks is one join key and no close pair is missed. Candidates are checked by their true
Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected_components

BITS = 64
HASH_SEED = 42
#: Shingles hashed at a time; bounds a task's memory on very long texts.
CHUNK = 1 << 18
#: Expected members of a key, beyond which one more block is used.
KEY_MEMBERS = 8

_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set (index 0: lowest bit)."""
    counts = np.zeros((8, 8), np.int64)  # [bit in byte, byte]
    starts = np.arange(0, len(hashes), 255)  # a byte lane holds sums up to 255
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, starts)
        counts[k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.T.reshape(-1)


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint of one text; 0 for a null text or one without words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and the white space of WORD
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    total = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        hashes = b"".join([digest(s, HASH_SEED) for s in shingles])
        total += bit_counts(np.frombuffer(hashes, ">u8").astype(np.uint64))
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp): one row per input row, the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), signed], ["id", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """One 64-bit mask per choice of `blocks - max_bits` blocks."""
    if not max_bits < blocks <= BITS:
        raise ValueError(f"blocks must be over max_bits ({max_bits}) and at most {BITS}")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - max_bits)]


def blocks_for(n: int, max_bits: int) -> int:
    """The fewest blocks whose join keys have few chance members among `n` fingerprints."""
    blocks = max_bits + 2
    while n / 2 ** (BITS * (blocks - max_bits) / blocks) > KEY_MEMBERS and blocks < 16:
        blocks += 1
    return blocks


def close_pairs(fps: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct longs in `fps.fp` within `max_bits` bits."""
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in block_masks(blocks, max_bits)]
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k")) for i, m in enumerate(signed)])
    keyed = fps.select("fp", F.inline(keys))
    a, b = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return a.join(b, ["c", "k"]).where(close).select("a", "b").distinct()


def simhash_near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, blocks: int | None = None
) -> DataFrame:
    """One row per document: (`id_col`, fingerprint, component_id).

    `fingerprint` is 16 lowercase hex digits, `component_id` the smallest id reachable
    over links of at most `max_bits` differing bits (the document's own id included).
    Equal fingerprints are one class from the start; pairs are formed between classes
    only. `blocks` fixes the number of pigeonhole blocks; by default it follows the
    number of distinct fingerprints. Every choice finds the same links.

    Null, empty and blank texts have fingerprint 0 and are linked like any other.
    Repeated rows each give a row. Null ids are kept, and never become a component id
    unless the whole component has none. Other columns, whatever their names, are
    ignored. An empty table gives an empty result.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = materialise(fps.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    links = close_pairs(classes.select("fp"), max_bits, blocks or blocks_for(classes.count(), max_bits))
    labels = connected_components(links, "a", "b").withColumnRenamed("node", "fp")
    named = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of `docs` that stay: of each component the document with the smallest id.

    An id names a document: if its rows differ in text, they stay together as soon as one
    of them is the smallest of its component, and rows equal in id and text become one.
    Rows with a null id are kept, since nothing names them.
    """
    found = materialise(simhash_near_dedup(docs, id_col, text_col, shingle, max_bits), "found")
    stay = found.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.count("*").alias("__n"))
    kept = docs.join(stay.select(id_col), id_col, "left_semi")
    if not stay.where("__n > 1").isEmpty():
        again = stay.where("__n > 1").select(id_col)
        once = kept.join(again, id_col, "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(again, id_col, "left_anti").unionByName(once)
    return kept.unionByName(docs.where(F.col(id_col).isNull())).select(*docs.columns)
