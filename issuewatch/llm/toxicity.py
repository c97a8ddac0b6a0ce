"""Toxicity scores from a factorization machine over hashed terms.

Terms of a text are its lower-cased words (runs of letters) and their leading 5 to 7
characters, each as a 64-bit hash; a term's value is 1 + log(count). The machine learns a weight for each term and, through
`RANK` factors a term, one for each pair of terms that meet in a text, so an insult
beside a group mention can weigh more than the two alone.

The fit is on a bounded sample of labelled documents: Spark draws it and counts the
terms, the driver gets only the terms that a bounded vocabulary keeps. Scoring runs in
Arrow batches over whole texts with the broadcast model (`MAX_TERMS` rows of weights).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, materialise

#: Labelled documents that the fit uses at most (about; drawn by a hash of the id).
TRAIN_DOCS = 20_000
#: Terms that the model keeps at most.
MAX_TERMS = 2000
#: Training documents in which a kept term occurs at least.
MIN_DOCS = 3
RANK = 4
EPOCHS = 12
#: Least number of batches; a small training set is gone through more often.
MIN_STEPS = 1000
BATCH = 256
RATE = 0.05
DECAY = 1e-4
#: Words whose terms a task remembers.
CACHE_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 6, 7)


def word_terms(word: str) -> list[int]:
    """The signed 64-bit hashes of a word's terms."""
    parts = [f"w{word}", *(f"p{word[:n]}" for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh64_intdigest(p) - (1 << 63) for p in parts]


@dataclass(frozen=True)
class FactorizationMachine:
    terms: np.ndarray  # sorted hashes
    bias: float
    weight: np.ndarray  # (terms,)
    factors: np.ndarray  # (terms, RANK)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        z = self.bias + float(self.weight[index] @ value) + pairs
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


class Features:
    """Texts to (index, value) of the terms that a vocabulary (sorted hashes) holds."""

    def __init__(self, terms: np.ndarray) -> None:
        self.places = {int(t): i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        if word not in self.known:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = tuple(self.places[t] for t in word_terms(word) if t in self.places)
        return self.known[word]

    def of_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts: Counter[int] = Counter()
        for word, n in Counter(_WORD.findall((text or "").lower())).items():
            for i in self.of_word(word):
                counts[i] += n
        index = np.fromiter(counts.keys(), np.int64, len(counts))
        return index, 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, terms: np.ndarray, seed: int = 3) -> FactorizationMachine:
    """Adagrad on the logistic loss over small batches; deterministic for equal input."""
    rng = np.random.default_rng(seed)
    n = len(terms)
    share = (labels.sum() + 0.5) / (len(labels) + 2)
    w, v, bias = np.zeros(n), rng.normal(0, 0.01, (n, RANK)), math.log(share / (1 - share))
    if not n:
        return FactorizationMachine(terms, bias, w, v)
    gw, gv, gb = np.full(n, 1e-6), np.full((n, RANK), 1e-6), 1e-6
    for _ in range(max(EPOCHS, MIN_STEPS * BATCH // max(1, len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(rows[i][0]) for i in some])
            index = np.concatenate([rows[i][0] for i in some])
            value = np.concatenate([rows[i][1] for i in some])
            doc = np.repeat(np.arange(len(some)), sizes)
            vx = v[index] * value[:, None]
            total = np.zeros((len(some), RANK))
            np.add.at(total, doc, vx)
            square = np.zeros((len(some), RANK))
            np.add.at(square, doc, vx * vx)
            z = bias + np.bincount(doc, w[index] * value, len(some)) + 0.5 * (total**2 - square).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[some]
            e = error[doc]
            touched, inverse = np.unique(index, return_inverse=True)
            dw = np.bincount(inverse, e * value, len(touched)) / len(some) + DECAY * w[touched]
            dv = np.zeros((len(touched), RANK))
            np.add.at(dv, inverse, (e * value)[:, None] * (total[doc] - vx))
            dv = dv / len(some) + DECAY * v[touched]
            gw[touched] += dw**2
            gv[touched] += dv**2
            w[touched] -= RATE * dw / np.sqrt(gw[touched])
            v[touched] -= RATE * dv / np.sqrt(gv[touched])
            db = error.mean()
            gb += db**2
            bias -= RATE * db / math.sqrt(gb)
    return FactorizationMachine(terms, float(bias), w, v)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_docs: int, seed: int) -> DataFrame:
    """(id, text, label): about `train_docs` labelled documents whose id remainder (mod 5) is not 0."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (id_remainder(F.col("id"), 5) != 0))
    share = min(1.0, train_docs / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    known = known.where(draw < share).groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(known), "id")  # about train_docs ids at most
    return rows.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def count_terms(rows: DataFrame) -> DataFrame:
    """(term, pos, neg): the documents of either label that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                counts[int(label > 0)].update({t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)})
            terms = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(x, pa.int64()) for x in (terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms])]
            yield pa.RecordBatch.from_arrays(columns, ["term", "pos", "neg"])

    return rows.mapInArrow(run, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
    seed: int = 3,
) -> FactorizationMachine:
    """Learn from a sample of about `train_docs` labelled documents outside the held-out fifth.

    The vocabulary is the `MAX_TERMS` terms whose share differs most between the labels.
    An id with several labels counts as its largest, one with several texts by its first.
    Without labelled documents the model is its prior: a score under one half for all.
    """
    rows = materialise(sample(docs, labels, id_col, text_col, label_col, train_docs, seed), "labelled")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.expr("int(label > 0)")), F.lit(0)).alias("pos")).first()
    odds = F.log(((F.col("pos") + 0.5) / (size["pos"] + 1)) / ((F.col("neg") + 0.5) / (size["n"] - size["pos"] + 1)))
    rank = F.round(F.abs(odds) * F.sqrt(F.col("pos") + F.col("neg")), 9)
    best = count_terms(rows).where(F.col("pos") + F.col("neg") >= MIN_DOCS).orderBy(rank.desc(), "term").limit(MAX_TERMS)
    terms = np.array(sorted(r["term"] for r in best.select("term").collect()), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(terms)
        for batch in batches:
            found = [features.of_text(t) for t in batch.column("text").to_pylist()]
            index = pa.array([f[0].tolist() for f in found], pa.list_(pa.int64()))
            value = pa.array([f[1].tolist() for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), index, value], ["id", "label", "index", "value"])

    wanted = rows.select(F.col("id").cast("string").alias("id"), "label", "text")
    got = wanted.mapInArrow(run, "id string, label int, index array<long>, value array<double>").toPandas()
    got = got.sort_values("id")
    pairs = [(np.asarray(i, np.int64), np.asarray(v, np.float64)) for i, v in zip(got["index"], got["value"], strict=True)]
    return train(pairs, (got["label"].to_numpy(np.float64) > 0).astype(np.float64), terms, seed)


def predict(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (`id_col`, score, predicted). Only the text is looked at; a null
    or empty text has the score of the bias alone."""
    # plain arrays: a broadcast class would have to be installed on the executors
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.bias, model.weight, model.factors))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = FactorizationMachine(*shared.value)
        features = Features(known.terms)
        for batch in batches:
            scores = [known.score(*features.of_text(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, score double")
    return found.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Fit on the labelled share of `docs`, then score every row.

    Returns (`id_col`, held_out, score, predicted); `held_out` marks the ids whose remainder
    (crc32 of the id's text, mod 5) is 0, whose labels the fit never reads. A null id counts
    as the empty text and is never learnt from. Repeated rows each give a row; empty
    tables give an empty result or a prior score. Other columns are ignored.
    """
    found = predict(docs, fit(docs, labels, id_col, text_col, label_col), id_col, text_col)
    return found.select(id_col, (id_remainder(F.col(id_col), 5) == 0).alias("held_out"), "score", "predicted")
