"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each
stage's result to the shared scratch folder and gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issuewatch.llm import decontaminate, language, mixing, simhash, tokens
from issuewatch.llm.common import materialise, read
from issuewatch.llm.params import MIX_SEED, MIX_WEIGHTS
from issuewatch.llm.queries import domain_of_source, vocabulary
from issuewatch.session import scratch_path

#: Shingle length and maximum bit distance of the near-dedup stage.
SHINGLE, MAX_BITS = 4, 4
#: Documents whose best language has a lower posterior are rejected.
MIN_LANGUAGE_SCORE = 0.5
#: The mix's budget in percent of the tokens that reach it, and how often it may hold a document.
MIX_BUDGET_PERCENT, MIX_MAX_EPOCHS = 80, 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a recognised language and sets `lang` on the others."""
    return language.keep_known(docs, MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest id, of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that overlap with a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix holds it; a second epoch repeats its rows."""
    mixed = mixing.mix(docs, domain_of_source(), MIX_WEIGHTS, MIX_BUDGET_PERCENT, MIX_MAX_EPOCHS, MIX_SEED)
    return mixing.take_mix(docs, mixed)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns their digest, read back from them."""
    path = scratch_path(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, vocabulary())
    return tokens.digests(tokens.read_tokens(spark, path))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
    ("token-ID output", token_output),
]

#: Language ID and tokenising have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage{k}")
    return docs
