"""The registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import decontamination, license_scan, line_dedup, lm_scoring, ngram_join, oracles, packing, quality_model, quality_rules, substring_dedup, suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), n=3, percent=90).drop("node")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` has no paths: source, hundred of ids and id stand for one, and a document with a licence of its own for its directory's licence file."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    place = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("null")), name)
    files = _table(spark, sf_dir, "documents").select(place.alias("path"), "text")
    found = license_scan.license_scan(files, is_license_file=lambda f: f["own_license"].isNotNull())
    return found.select(F.expr("try_cast(regexp_extract(path, '[^/]*$', 0) as bigint)").alias("doc_id"), "own_license", "own_kind", "license", "license_source", "from_dir")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(_table(spark, sf_dir, "documents"))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that do not depend on estimated accuracies."""
    return op8_quality_rules(spark, sf_dir).drop("kept", "p_good")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (quality_base_counts, op1_line_dedup, op2_suffix_array_dedup, op3_benchmark_decontamination, op4_ngram_jaccard_join, op5_license_scans, op6_quality_classifier, op7_substring_dedup, op8_quality_rules, op9_lm_scoring, op10_packing)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
