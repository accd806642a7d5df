"""The request log: failure classes, streaks, pauses and worker usage.

Streaks are global over all workers, so they need the order of the whole log.  To
keep that order out of one task, the log is cut into spans of ``SPAN`` numbers and
these into blocks of ``SPAN`` spans: what a streak brings along is worked out inside
spans, then over the spans of a block, then over blocks, of which there is one for
ten billion requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPAN = 100_000


def outcome(http_status: Column) -> Column:
    """ok, transient (no status or 5xx), forbidden (403), missing (404) or failed."""
    return (
        F.when(http_status.isNull() | (http_status >= 500), "transient")
        .when(http_status == 403, "forbidden")
        .when(http_status == 404, "missing")
        .when(http_status.between(200, 299), "ok")
        .otherwise("failed")
    )


def _since(units: DataFrame, group: str | None, order: str) -> DataFrame:
    """``_since``: what ``_add`` adds up to after the last ``_reset`` so far in the group; ``_open``: there was none."""
    over = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = units.withColumn("_sum", F.sum("_add").over(over))
    start = F.max(F.when(F.col("_reset"), F.col("_sum") - F.col("_add"))).over(over)  # sums never fall
    return summed.withColumn("_start", start).withColumn("_since", F.col("_sum") - F.coalesce("_start", F.lit(0))).withColumn("_open", F.col("_start").isNull())


def _totals(units: DataFrame, order: str, *by: str) -> DataFrame:
    return units.groupBy(*by).agg(F.max_by("_since", order).alias("_add"), F.max("_reset").alias("_reset"))


def _carry(units: DataFrame, group: str | None, order: str, name: str) -> DataFrame:
    """What each unit is handed by those before it in the group, and whether that still lacks a reset."""
    before = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(order)
    return units.withColumn(name, F.coalesce(F.lag("_since").over(before), F.lit(0))).withColumn(f"{name}_open", F.coalesce(F.lag("_open").over(before), F.lit(True)))


def _streak(log: DataFrame, name: str, adds: Column, resets: Column) -> DataFrame:
    """Length of the current streak after each request: adds since the last reset."""
    marked = log.withColumns({"_add": adds.cast("long"), "_reset": F.coalesce(resets, F.lit(False)), "_span": F.floor(F.col("seq") / SPAN)})
    rows = _since(marked.withColumn("_block", F.floor(F.col("_span") / SPAN)), "_span", "seq")
    spans = _since(_totals(rows, "seq", "_span", "_block"), "_block", "_span")
    blocks = _since(_totals(spans, "_span", "_block"), None, "_block")
    handed = _carry(spans, "_block", "_span", "_c").join(_carry(blocks, None, "_block", "_b").select("_block", "_b"), "_block")
    carry = handed.select("_span", (F.col("_c") + F.when(F.col("_c_open"), F.col("_b")).otherwise(0)).alias("_carry"))
    joined = rows.join(carry, "_span")
    return joined.withColumn(name, F.col("_since") + F.when(F.col("_open"), F.col("_carry")).otherwise(0)).select(*log.columns, name)


def error_streaks(log: DataFrame) -> DataFrame:
    """Transient and 403 streaks at each request.

    A transient streak is reset by success alone; 403 and 404 leave it.  A 403
    streak is reset by everything else.
    """
    kind = outcome(F.col("http_status"))
    seen = log.withColumn("outcome", kind)
    seen = _streak(seen, "transient_streak", F.col("outcome") == "transient", F.col("outcome") == "ok")
    return _streak(seen, "forbidden_streak", F.col("outcome") == "forbidden", F.col("outcome") != "forbidden")


def success_streaks(log: DataFrame) -> DataFrame:
    seen = log.withColumn("outcome", outcome(F.col("http_status")))
    return _streak(seen, "success_streak", F.col("outcome") == "ok", F.col("outcome") == "transient")


def with_pauses(streaks: DataFrame, transient_after: int, forbidden_after: int) -> DataFrame:
    """Where a pause would start: each time a streak reaches its threshold and starts anew."""

    def fires(name: str, kind: str, after: int) -> Column:
        return (F.col("outcome") == kind) & (F.col(name) % after == 0)

    return streaks.withColumn("pause", F.when(fires("transient_streak", "transient", transient_after), "transient").when(fires("forbidden_streak", "forbidden", forbidden_after), "forbidden"))


def default_thresholds(workers: int) -> tuple[int, int]:
    """Errors in a row before a pause: transient ones, and 403s."""
    return max(20, 4 * workers), max(4, workers)


def known_page_streaks(pages: DataFrame) -> DataFrame:
    """search_key, page, found, fresh (ids no page before had) and the streak of pages without fresh ids.

    Empty pages leave the streak as it is.
    """
    order = Window.partitionBy("search_key").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    isle = pages.withColumn("isle", F.sum((F.col("fresh") > 0).cast("int")).over(order))
    inside = Window.partitionBy("search_key", "isle").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    known = (F.col("found") > 0) & (F.col("fresh") == 0)
    return isle.withColumn("known_streak", F.sum(known.cast("int")).over(inside)).drop("isle")


def page_freshness(members: DataFrame) -> DataFrame:
    """Ids found on each page, and how many no earlier page of the shard had."""
    first = members.groupBy("search_key", "id").agg(F.min("page").alias("page")).groupBy("search_key", "page").agg(F.count("*").alias("fresh"))
    found = members.groupBy("search_key", "page").agg(F.count_distinct("id").alias("found"))
    return found.join(first, ["search_key", "page"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(0)))


def usage(steps: DataFrame, key: str, end: Column) -> DataFrame:
    """Time-weighted average, least, most and last value of a step function (at, value) of each key."""
    order = Window.partitionBy(key).orderBy("at", "seq")
    spans = steps.withColumn("span", F.coalesce(F.lead("at").over(order), end) - F.col("at"))
    last = F.max_by("value", F.struct("at", "seq"))
    return spans.groupBy(key).agg(
        F.coalesce(F.try_divide(F.sum(F.col("value") * F.col("span")), F.sum("span")), last.cast("double")).alias("average"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        last.alias("final"),
    )
