"""Pauses and worker changes from a stream of requests, with the crawl's streak rules as state.

The rules are global and ordered, so the stream has one key; what it holds is a
few numbers.  Order inside a micro-batch is by ``seq``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from harrow.control import ControlConfig, Pace

EVENT = "seq bigint, what string, workers int, pause double"
STATE = "active int, transient int, forbidden int, successes int"


def pace_events(requests: DataFrame, config: ControlConfig) -> DataFrame:
    """One event for each request of the stream (seq, http_status): what becomes of it, workers after it, pause due."""

    def step(_key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        pace = Pace(config)
        if held.exists:
            pace.active, pace.transient, pace.forbidden, pace.successes = held.get
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for seq, status in zip(rows["seq"], rows["http_status"], strict=True):
            what = pace.see(None if pd.isna(status) else int(status), item=True)
            out.append((seq, what, pace.active, pace.take_pause()))
        held.update((pace.active, pace.transient, pace.forbidden, pace.successes))
        yield pd.DataFrame(out, columns=["seq", "what", "workers", "pause"])

    keyed = requests.select(F.lit(0).alias("all"), "seq", F.col("http_status").cast("double").alias("http_status"))
    return keyed.groupBy("all").applyInPandasWithState(step, EVENT, STATE, "append", GroupStateTimeout.NoTimeout)


def outcome_counts(requests: DataFrame, every: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Requests by outcome and time window of a stream with a ``ts``."""
    from harrow.operators.requests import outcome

    seen = requests.withWatermark("ts", late).withColumn("outcome", outcome(F.col("http_status")))
    return seen.groupBy(F.window("ts", every), "outcome").agg(F.count("*").alias("n")).select("window.start", "window.end", "outcome", "n")
