"""Keyword extraction by maximal marginal relevance (MMR).

MMR runs as `top_n` unrolled Spark steps over (document, candidate) rows instead of a
per-document Python loop:

  step 1: pick = argmax_c sim(c, doc)
  step k: pick = argmax_c (1 - d) * sim(c, doc) - d * max_{p picked} sim(c, p)

Each step of `mmr` is two hash aggregates per document (best score, then the lowest
candidate with it), reduced map-side. The candidates are joined with one small row per
document holding the picks so far. `extract_keywords` needs no such rows: a document
and its candidates are one row there, and MMR runs inside an Arrow batch. Ties go to the lowest candidate id (the reference's candidates are sorted and
numpy's argmax takes the first maximum).

The tagger and sentence encoder of the reference are not available offline; the
pluggable defaults here are a letter tokenizer (a column expression) and a hashed
character-trigram encoder (an Arrow pandas UDF), documented stand-ins, see README.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import dot_fixed, norm_fixed
from ..session import scratch_path

TOP_N = 5  # fixed value: keywords per document
DIVERSITY = 0.2  # fixed value: MMR diversity
ENCODER_DIM = 64
MIN_WORD_CHARS = 2  # candidates are words of 2+ letters, lower-cased
BUCKET_ROWS = 100_000  # candidates of a document per salt of the MMR join


def mean_vectors(items: DataFrame, key: str, vec: str, dim: int | None = None) -> DataFrame:
    """Mean of the item vectors per key (element-wise), as array<double>. With the width
    `dim` known the elements are plain averages of one partial aggregate; otherwise each
    element is a row of it."""
    if dim:
        means = [F.avg(F.col(vec)[i].cast("double")).alias(f"_m{i}") for i in range(dim)]
        return items.groupBy(key).agg(*means).select(key, F.array(*[f"_m{i}" for i in range(dim)]).alias("doc_vec"))
    ex = items.select(key, F.posexplode(vec).alias("_pos", "_x"))
    g = ex.groupBy(key, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return g.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_m"))), lambda s: s["_m"]).alias("doc_vec"))


def mmr(
    cands: DataFrame,
    doc_vecs: DataFrame,
    doc: str,
    item: str,
    emb: str,
    top_n: int = TOP_N,
    diversity: float = DIVERSITY,
    dim: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """MMR selection where the candidates are rows. cands: (doc, item, emb); doc_vecs:
    (doc, doc_vec). Returns (doc, rank, item) for the picked items, rank 1..top_n.

    The scored candidates are written once to the shared scratch folder and read by every
    step. A step needs two hash aggregates on fixed-width buffers per document: the best
    score, and the lowest item among the candidates with that score; both are reduced
    map-side, so a document with a huge candidate list is never whole in one task. Only
    the winner's vector is then fetched, by a join on (document, item). The state
    between steps is one small row per document (at most top_n picks), joined to the
    candidates on (document, salt): the number of salts follows the largest document's
    measured candidate count. With `dim` given, dot products are unrolled (codegen)."""
    d = float(diversity)
    spark = cands.sparkSession

    def dot(a, b):
        return dot_fixed(a, b, dim) if dim else _dot_hof(a, b)

    def nrm(a):
        return norm_fixed(a, dim) if dim else F.sqrt(_dot_hof(a, a))

    def cut(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    j0 = cands.join(doc_vecs, doc).select(doc, item, emb, nrm(F.col(emb)).alias("_n"), "doc_vec", nrm(F.col("doc_vec")).alias("_dn"))
    base = cut(j0.select(doc, item, emb, "_n", (dot(F.col(emb), F.col("doc_vec")) / (F.col("_n") * F.col("_dn"))).alias("_sim_doc")), "mmr-candidates")
    most = base.groupBy(doc).count().agg(F.max("count")).first()[0] or 1
    salts = max(1, -(-most // bucket_rows))
    base = base.withColumn("_salt", F.pmod(F.xxhash64(item), F.lit(salts)).cast("int"))
    salt_ids = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    picked = None  # doc, _items, _embs, _norms
    for rank in range(1, top_n + 1):
        if picked is None:
            cand, score = base, F.col("_sim_doc")
        else:
            cand = base.join(picked.select("*", salt_ids), [doc, "_salt"]).filter(~F.array_contains(F.col("_items"), F.col(item)))
            sims = [dot(F.col(emb), F.col("_embs")[j]) / (F.col("_n") * F.col("_norms")[j]) for j in range(rank - 1)]
            maxsim = F.greatest(*sims) if len(sims) > 1 else sims[0]
            score = F.lit(1.0 - d) * F.col("_sim_doc") - F.lit(d) * maxsim
        scored = cut(cand.select(doc, item, score.alias("_score")), "mmr-scores")
        best = scored.groupBy(doc).agg(F.max("_score").alias("_score"))
        pick = scored.join(best, [doc, "_score"]).groupBy(doc).agg(F.min(item).alias(item))
        pick = base.join(pick, [doc, item], "left_semi").select(doc, F.col(item).alias("_pick"), F.col(emb).alias("_pick_emb"), F.col("_n").alias("_pick_n"))
        if picked is None:
            nxt = pick.select(doc, F.array("_pick").alias("_items"), F.array("_pick_emb").alias("_embs"), F.array("_pick_n").alias("_norms"))
        else:
            jn = picked.join(pick, doc, "left")
            add = F.col("_pick").isNotNull()
            nxt = jn.select(
                doc, *[F.when(add, F.concat(c, F.array(f))).otherwise(F.col(c)).alias(c) for c, f in (("_items", "_pick"), ("_embs", "_pick_emb"), ("_norms", "_pick_n"))]
            )
        picked = cut(nxt, "mmr-picked")
    return picked.select(doc, F.posexplode("_items").alias("rank", item)).withColumn("rank", F.col("rank") + 1)


def _dot_hof(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


# --- pluggable stand-ins for tagger and encoder ------------------------------------------


def letter_words(text: Column, min_chars: int = MIN_WORD_CHARS) -> Column:
    """Tokenizer stand-in: lower-cased runs of `min_chars` or more letters (whole text)."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{%d,}" % min_chars), 0)


ENCODE_CHUNK_CHARS = 1 << 20  # characters encoded per vectorised numpy pass
KEYWORD_DOCS = 256  # documents whose candidates are encoded together


def hashed_counts(texts: list[str], dim: int = ENCODER_DIM) -> np.ndarray:
    """Encoder stand-in (the 'model'): (len(texts), dim) signed hashed character-trigram
    counts of ' text '. Bucket = (961 a + 31 b + c) mod dim, sign = +1 when a + 7 b + 13 c
    is even, for the code points a b c of each trigram. The code points of many texts
    are concatenated, every trigram gets (row, bucket), and one bincount adds them up."""
    out, at = [], 0
    sizes = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + ENCODE_CHUNK_CHARS, side="right")))
        out.append(_hashed_counts(texts[at:to], dim))
        at = to
    return np.concatenate(out) if out else np.zeros((0, dim))


def _hashed_counts(texts: list[str], dim: int) -> np.ndarray:
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 2
    cp = np.frombuffer(f" {'  '.join(texts)} ".encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    a, b, c = cp[:-2], cp[1:-1], cp[2:]  # products of code points fit 31 bits
    bucket = (a * 961 + b * 31 + c) % dim
    sign = 1.0 - 2.0 * ((a ^ b ^ c) & 1)  # a + 7 b + 13 c is odd where a + b + c is
    ends = np.cumsum(lens)[:-1]
    sign[ends - 2] = sign[ends - 1] = 0.0  # these begin in one text and end in the next
    cell = np.repeat(np.arange(0, len(texts) * dim, dim), lens)[:-2] + bucket
    return np.bincount(cell, weights=sign, minlength=len(texts) * dim).reshape(len(texts), dim)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """The rows' lengths, 1 for a vector without length: its products are 0, and so its cosines."""
    norms = np.sqrt((vectors * vectors).sum(axis=-1))
    return np.where(norms > 0, norms, 1.0)


def mmr_order(vectors: np.ndarray, target: np.ndarray, top_n: int, diversity: float, norms: np.ndarray | None = None) -> list[int]:
    """Greedy MMR over the rows of `vectors`, whose `lengths` may be given; of equal scores the
    first row wins. A vector without length has similarity 0 to everything."""
    norms = lengths(vectors) if norms is None else norms
    score = (vectors @ target) / (norms * lengths(target))
    relevance = (1.0 - diversity) * score  # -inf for the picked ones
    picked: list[int] = []
    nearest = np.full(len(vectors), -np.inf)
    for _ in range(min(top_n, len(vectors))):
        if picked:
            score = relevance - diversity * nearest
        best = int(score.argmax())
        picked.append(best)
        relevance[best] = -np.inf
        np.maximum(nearest, (vectors @ vectors[best]) / (norms * norms[best]), out=nearest)
    return picked


def extract_keywords(
    docs: DataFrame,
    key: str,
    text: str | Column,
    top_n: int = TOP_N,
    diversity: float = DIVERSITY,
    tokenizer: Callable[[Column], Column] = letter_words,
    encoder: Callable[[list[str]], np.ndarray] = hashed_counts,
) -> DataFrame:
    """(key, rank, keyword). Candidates = distinct words of the whole text; the
    document vector and each candidate's vector come from the encoder; MMR picks.

    A document and its candidates are one row, so the plan is one map: `tokenizer` (a
    column expression) runs in the scan, `encoder` (texts -> one vector each) sees the
    distinct words of a batch of rows once, and each row picks its own keywords. The words
    of a batch are numbered in ascending order by Arrow, so a row's candidates are numbers
    and are sorted as such. Nothing is shuffled or written. A null text has no keywords."""
    x = F.lower(F.col(text) if isinstance(text, str) else text)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(x, F.lit("")).alias("t")).select("k", "t", F.coalesce(F.array_distinct(tokenizer(F.col("t"))), F.array().cast("array<string>")).alias("w"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, KEYWORD_DOCS):
                some = batch.slice(at, KEYWORD_DOCS)
                coded = some.column("w").flatten().dictionary_encode()
                order = pc.sort_indices(coded.dictionary).to_numpy()
                words = coded.dictionary.take(pa.array(order)).to_numpy(zero_copy_only=False).tolist()
                numbers = np.argsort(order)[coded.indices.to_numpy()]
                ends = np.cumsum(pc.list_value_length(some.column("w")).to_numpy())
                vectors = np.asarray(encoder(words), dtype=np.float64)
                norms = lengths(vectors)
                targets = np.asarray(encoder(some.column("t").to_pylist()), dtype=np.float64)
                places, ranks, found = [], [], []
                for k, own in enumerate(np.split(numbers, ends[:-1])):
                    if not len(own):
                        continue
                    own = np.sort(own)
                    picked = mmr_order(vectors[own], targets[k], top_n, diversity, norms[own])
                    places += [k] * len(picked)
                    ranks += range(1, len(picked) + 1)
                    found += [words[own[i]] for i in picked]
                ids = some.column("k").take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(ranks, pa.int32()), pa.array(found, pa.string())], ["k", "rank", "keyword"])

    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, rank int, keyword string").withColumnRenamed("k", key)
