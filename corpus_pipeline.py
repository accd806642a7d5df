"""A training-corpus pipeline over ``documents``: five stages, each on all that the one before kept.

1. ``quality_rules``: documents that the rules reject go.
2. ``line_dedup``: of similar lines all but the first leave the texts; documents
   that lose lines and keep no word go.
3. ``ngram_join``: of each group of near-duplicates (five-word n-grams, Jaccard
   similarity of 0.8 or more) the document with the least id stays.
4. ``decontamination``: documents that hold a benchmark passage go.
5. ``packing``: the documents left get length buckets and batches.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import decontamination, line_dedup, ngram_join, packing, quality_rules
from harrow.llm.textops import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; where an id is repeated, all its rows stay if any does."""
    found = ngram_join.jaccard_components(docs, n=5, percent=80)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", cut_lines),
    ("ngram_join", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack_batches),
]

#: Estimated rule accuracies and MinHash candidates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
