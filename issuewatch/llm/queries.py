"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import decontaminate, html, identifiers, language, licenses, lines, mixing, periodic, quality, simhash, tokens, toxicity, variants
from .common import read, words
from .params import MIX_BUDGET_PERCENT, MIX_MAX_EPOCHS, MIX_SEED, MIX_WEIGHTS
from .sql import SQL


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file."""
    return public_tokenizers.path(name)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(read(spark, sf_dir, "documents"), path, vocabulary())
    return tokens.digests(tokens.read_tokens(spark, path))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def domain_of_source() -> Column:
    """The domain of a source: its number's range (web to 9, reference to 14, forum beyond)."""
    number = F.expr("try_cast(substr(source, 4) as int)")
    return F.when(number <= 9, "web").when(number <= 14, "reference").when(number.isNotNull(), "forum").otherwise("other")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.mix(docs, domain_of_source(), MIX_WEIGHTS, MIX_BUDGET_PERCENT, MIX_MAX_EPOCHS, MIX_SEED)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(read(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def looped_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a tail of every tenth text made periodic, as the id's checksum says:
    from word a on, the p words there are repeated to the text's end. Null ids: unchanged."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("loops"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("loops"), words(F.col("text"))))
    rows = rows.withColumn("n", F.size("w")).withColumn("loops", F.col("loops") & (F.col("n") > 0))
    rows = rows.withColumn("a", F.when(F.col("loops"), (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), int((n - a) div p + 1))), 1, n - a)")
    looped = F.array_join(F.concat(F.expr("slice(w, 1, a)"), tail), " ")
    return rows.select("doc_id", F.when(F.col("loops"), looped).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.periodic_runs(looped_texts(read(spark, sf_dir, "documents"))))


def letter_words(docs: DataFrame) -> DataFrame:
    """(word): the letter runs of all texts with 5 letters or more; of every 97th (document, run), as
    their checksum says, one letter is left out."""
    runs = variants.letter_runs(docs, least=5)
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    rows = runs.select("run", h.alias("h"), (h % F.length("run")).cast("int").alias("at"))
    word = F.when(F.col("h") % 97 == 0, F.expr("concat(substr(run, 1, at), substr(run, at + 2))")).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= 5)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(letter_words(read(spark, sf_dir, "documents")))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.span_digest(identifiers.find_identifiers(read(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_token_output": op2_token_output,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_extract": op7_html_extract,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_decontaminate": op10_decontaminate,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_personal_data": op13_personal_data,
}
__all__ = ["QUERIES", "SQL"]
