"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes lower-case letters with every other run as one blank; its n-grams of 1 to
`MAX_N` characters are hashed into `BUCKETS` buckets. Training counts n-grams per
language in Spark. The log-probability matrix (languages x buckets, floats) is the only
thing that is broadcast; its size is bounded by `BUCKETS` and `MAX_LANGUAGES`. Scoring
takes the texts of a batch together: their sparse (bucket, count) pairs gather rows of the
matrix, which are weighted by the counts and added up per text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, per_worker

BUCKETS = 1 << 15
MAX_N = 3
MAX_LANGUAGES = 256
#: Expected number of training documents per language; the fit is on a sample of this bound.
TRAIN_DOCS = 4000
UNKNOWN = "und"
#: Characters scored at a time; bounds a task's memory on very long texts.
CHUNK = 1 << 18
#: Numbers of the matrix gathered at a time (rows by languages); bounds a task's memory.
GATHER = 1 << 21

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)

def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    flags = np.zeros(0x110000, bool)
    flags[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]] = True
    return flags


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """The buckets of the n-grams of a text, with repeats, in pieces of bounded size."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = per_worker("letters", letter_table)[codes]
    if not letter.any():
        return
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the run
    codes = np.concatenate(([32], np.where(letter, codes, 32)[keep], [32])).astype(np.uint64)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for at in range(0, len(codes), CHUNK):
        part = codes[at : at + CHUNK + MAX_N - 1]
        fresh = min(CHUNK, len(codes) - at)
        gram = np.zeros(len(part), np.uint64)
        for n in range(MAX_N):
            gram = (gram[: len(part) - n] * _MULTIPLIERS[2] + part[n:] + np.uint64(n + 1)) * _MULTIPLIERS[0]
            yield ((gram * np.uint64(0x9E3779B97F4A7C15)) >> shift)[:fresh].astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray  # log, (languages,)
    log_prob: np.ndarray  # (languages, BUCKETS), float64

    def posteriors(self, texts: Iterable[str | None]) -> np.ndarray:
        """(texts, languages): the posterior of every text; zeros for a null text."""
        rows = np.ascontiguousarray(self.log_prob.T)
        most = max(1, GATHER // max(1, len(self.languages)))
        totals: list[np.ndarray] = []
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0

        def gather() -> None:
            starts = np.cumsum([0, *(len(p[1]) for p in waiting[:-1])])
            part = rows[np.concatenate([p[1] for p in waiting])]
            part *= np.concatenate([p[2] for p in waiting])[:, None]
            for (k, _, _), one in zip(waiting, np.add.reduceat(part, starts), strict=True):
                totals[k] += one
            waiting.clear()

        for k, text in enumerate(texts):
            totals.append(np.full(len(self.languages), -np.inf) if text is None else self.prior.copy())
            for bucket, count in sparse_counts(text) if text is not None else ():
                waiting.append((k, bucket, count))
                size += len(bucket)
                if size >= most:
                    gather()
                    size = 0
        if waiting:
            gather()
        total = np.array(totals).reshape(len(totals), len(self.languages))
        known = np.isfinite(total[:, :1])
        best = np.where(known, total.max(axis=1, initial=-np.inf, keepdims=True), 0)
        share = np.exp(total - best)
        return share / np.where(known, share.sum(axis=1, keepdims=True), 1)


def sparse_counts(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of a text's n-grams, per `CHUNK` characters."""
    pieces: list[np.ndarray] = []
    for piece in ngram_buckets(text):
        pieces.append(piece)
        if len(pieces) == MAX_N:
            count = np.bincount(np.concatenate(pieces), minlength=BUCKETS)
            bucket = np.flatnonzero(count)
            yield bucket, count[bucket].astype(np.float64)
            pieces.clear()


def count_ngrams(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of (lang, text); one row per language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if lang not in counts and len(counts) == MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                row = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for buckets in ngram_buckets(text.as_py()):
                    row += np.bincount(buckets, minlength=BUCKETS)
        for lang, row in counts.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(row[at])], ["lang", "bucket", "n"])

    partial = rows.mapInArrow(run, "lang string, bucket long, n long")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS, seed: int = 1
) -> LanguageModel:
    """Learn from the rows with a language, a text and an id remainder (mod 3) other than 1.

    The fit is on a sample: of each language about `train_docs` whole documents, chosen by
    a hash of the id (all of them if there are fewer). Without any such row the model has
    no language and predicts `und`.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & has_letter(F.col("text")) & (id_remainder(F.col("id"), 3) != 1))
    sizes = docs.where(F.col(lang_col).isNotNull() & (id_remainder(F.col(id_col), 3) != 1)).groupBy(F.col(lang_col).alias("lang")).count()
    sizes = sizes.limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return LanguageModel([], np.zeros(0), np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, train_docs / r["count"]))])
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    got = count_ngrams(rows.where(draw < share[F.col("lang")]).select("lang", "text")).toPandas()
    languages = sorted(got["lang"].unique())
    smooth = np.full((len(languages), BUCKETS), 0.5)
    smooth[np.searchsorted(languages, got["lang"]), got["bucket"].to_numpy(np.int64)] += got["n"].to_numpy(np.float64)
    log_prob = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    known = {r["lang"]: r["count"] for r in sizes}
    prior = np.log(np.array([known[x] for x in languages], float) / sum(known[x] for x in languages)) if languages else np.zeros(0)
    return LanguageModel(languages, prior, log_prob)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (`id_col`, lang_pred, score). Only the text is looked at.

    `score` is the posterior probability of `lang_pred`; `und` has score 0 and stands for a
    null text, one without a letter, or a model without languages. Ties go to the language
    that sorts first.
    """
    # plain arrays: a broadcast class would have to be installed on the executors
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.log_prob))
    rows = docs.select(F.col(id_col).alias("id"), F.when(has_letter(F.col(text_col)), F.col(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        for batch in batches:
            scores, langs = [0.0] * len(batch), [UNKNOWN] * len(batch)
            if known.languages:
                posterior = known.posteriors(t.as_py() for t in batch.column("text"))
                scores = posterior.max(axis=1)
                langs = [known.languages[k] if s else UNKNOWN for k, s in zip(posterior.argmax(axis=1), scores, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Fit on the labelled share of `docs`, then predict every row.

    Returns (`id_col`, held_out, lang_pred, score); `held_out` marks the rows whose id
    remainder (crc32 of the id's text, mod 3) is 1, which the fit never saw. A null id
    counts as the empty text. Rows without a language are predicted and not learned from.
    Repeated rows each give a row; an empty table gives an empty result.
    """
    found = predict(docs, fit(docs, id_col, text_col, lang_col, train_docs), id_col, text_col)
    return found.select(id_col, (id_remainder(F.col(id_col), 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` whose language is recognised, with `lang_col` set to it.

    Rejected are texts without a letter and those whose best language has a posterior
    under `min_score`. The columns stay as they are.
    """
    model = fit(docs, id_col, text_col, lang_col)
    # plain arrays: a broadcast class would have to be installed on the executors
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.log_prob))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        for batch in batches:
            keep, langs = [False] * len(batch), [UNKNOWN] * len(batch)
            if known.languages:
                texts = (t.as_py() for t in batch.column(text_col))
                posterior = known.posteriors(t if t and has_letters(t) else None for t in texts)
                score = posterior.max(axis=1)
                keep = (score > 0) & (score >= min_score)
                langs = [known.languages[k] for k in posterior.argmax(axis=1)]
            columns = [pa.array(langs, pa.string()) if n == lang_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def has_letters(text: str) -> bool:
    return any(c.isalpha() for c in text)
