"""U4 / M6: negativity score = 1 - P(clean | text).

The reference runs a transformer classifier behind an HTTP server. The scorer here is
pluggable; the default is a multinomial naive-Bayes lexicon fitted on labelled rows
(`labels.toxic`), expressed entirely as Spark joins and aggregations:

  weight(t) = ln P(t | toxic) - ln P(t | clean),  P(t | c) = (n_tc + 1) / (N_c + |V|)
  logit(doc) = ln P(toxic) - ln P(clean) + sum over tokens of count * weight
  P(clean | doc) = 1 / (1 + exp(logit))

The weights come from the labelled documents alone and are one small row per token of
theirs. Scoring joins them to the exploded tokens of all documents and sums per document
map-side, so the only shuffle over all documents is one row per document; the weights
are broadcast after their count is checked. The whole text is scored (no truncation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import negativity
from ..session import scratch_path


def tokens(text: Column) -> Column:
    """Lower-cased letter runs of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


#: Weights up to this count are broadcast (a token and a double each); more are shuffled.
MAX_BROADCAST_WEIGHTS = 2_000_000


def fit_naive_bayes(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str) -> tuple[DataFrame, Column]:
    """(token weights, prior log-odds) from the documents with a 0/1 label (1 = toxic). The
    token counts by label are written once to the shared scratch folder."""
    spark = docs.sparkSession
    marked = docs.select(key, text).join(labels.select(key, F.col(label).alias("_y")), key)
    per_token = marked.select(F.explode(tokens(F.col(text))).alias("token"), "_y").groupBy("token")
    per_token = per_token.agg(F.sum(F.expr("int(_y = 1)")).alias("n1"), F.sum(F.expr("int(_y = 0)")).alias("n0"))
    path = scratch_path(spark, "token-counts")
    per_token.write.parquet(path)
    per_token = spark.read.schema(per_token.schema).parquet(path)
    totals = per_token.select(F.sum("n1").alias("N1"), F.sum("n0").alias("N0"), F.count(F.lit(1)).alias("V"))
    n1, n0, v = (totals.select(c).scalar() for c in ("N1", "N0", "V"))
    w = F.log((F.col("n1") + 1) / (n1 + v)) - F.log((F.col("n0") + 1) / (n0 + v))
    known = labels.join(docs.select(key), key, "left_semi")
    docs1 = known.select(F.sum(F.when(F.col(label) == 1, 1).otherwise(0))).scalar()
    docs0 = known.select(F.sum(F.when(F.col(label) == 0, 1).otherwise(0))).scalar()
    return per_token.select("token", w.alias("weight")), F.log(docs1.cast("double")) - F.log(docs0.cast("double"))


def score_naive_bayes(docs: DataFrame, key: str, text: str, weights: DataFrame, prior: Column) -> DataFrame:
    """key, p_clean. Documents without known tokens get the prior."""
    weights = F.broadcast(weights) if weights.count() <= MAX_BROADCAST_WEIGHTS else weights
    each = docs.select(key, F.explode_outer(tokens(F.col(text))).alias("token")).join(weights, "token", "left")
    s = each.groupBy(key).agg(F.sum("weight").alias("_s"))
    logit = prior + F.coalesce(F.col("_s"), F.lit(0.0))
    return s.select(key, (F.lit(1.0) / (F.lit(1.0) + F.exp(logit))).alias("p_clean"))


def score_sentiment(
    docs: DataFrame,
    key: str,
    text: str,
    labels: DataFrame | None = None,
    label: str = "toxic",
    scorer: Callable[[DataFrame, str, str], DataFrame] | None = None,
) -> DataFrame:
    """U4: (key, p_clean, sentiment = 1 - p_clean). `scorer` (documents, key, text) -> (key,
    p_clean) takes the place of the default, which is fitted on `labels`."""
    if scorer is not None:
        scored = scorer(docs, key, text)
    else:
        scored = score_naive_bayes(docs, key, text, *fit_naive_bayes(docs, key, text, labels, label))
    return scored.select(key, "p_clean", negativity(F.col("p_clean")).alias("sentiment"))
