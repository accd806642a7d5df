"""Session construction for local runs, tests and the benchmark."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Bytes, as the planner estimates them, of a part that ``spread`` deals, and parts of small tables.
PART_BYTES, LEAST_PARTS = 4 << 20, 16


def local_session(cpus: int = 8, shuffle_partitions: int = 8, app: str = "harrow", **conf: str) -> SparkSession:
    """A local session with the settings that the library relies on.

    On a cluster these come from the submit configuration; only the UTC time
    zone matters for results.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return carry(session)


def carry(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (root, known.get("PYTHONPATH", "")) if x)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's setting, or, in a local session only, a temporary one where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = getattr(spark, "_harrow_folder", None) or tempfile.mkdtemp(prefix="harrow-checkpoints-")
        spark._harrow_folder = named
    return named


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(os.path.join(shared_folder(spark), "harrow"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by keys into parts whose number grows with it, so that what a task holds of them does not.

    Adaptive execution joins parts of other shuffles by their packed size, which says little of a
    hash table over them.  A plan of unknown size is dealt as the session says.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(math.ceil(size / PART_BYTES), min(LEAST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return df.repartition(parts, *keys) if parts < 1 << 16 else df.repartition(*keys)
