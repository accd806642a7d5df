"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import settle, shared_folder  # noqa: F401

#: Characters that separate words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of maximal runs of characters other than the six ASCII blanks."""
    bare = F.btrim(whole(text), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def lines(text: Column) -> Column:
    """The text split at newlines; an empty text has one empty line."""
    return F.split(whole(text), "\n")


def doc_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, found by one aggregating scan."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder: narrower than a checkpoint, and columns are read one by one."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "harrow", f"table-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver drop what no query refers to any more, so that the shuffle files behind settled tables go.

    The scheduler still refers to the last job, so those of the jobs before it go.
    """
    spark.sparkContext._jvm.java.lang.System.gc()
