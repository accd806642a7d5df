"""Coverage analytics: shards of a search, groups of shards, summary and reports.

Only reports of a chosen length reach a driver.  Sizes: search pages are
aggregated before the shuffle.  Memberships are dealt by id, into parts whose
number grows with them, for the distinct counts of shards and of groups; groups are
known there by their least search key.  Shards and groups read one shuffle of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.functions.scalars import group_key, parsed_params, shard_label
from harrow.session import spread

WINDOW_LIMIT, FACETS = 9990, ("lang", "idlibrary")


class CoverageError(ValueError):
    """No shard is left to validate."""


def missing(total: Column, found: Column) -> Column:
    """How many of the reported results are not found; null without a report."""
    return F.when(total.isNotNull(), F.greatest(total - found, F.lit(0)))


def _by_id(members: DataFrame) -> DataFrame:
    """Shard and id of every membership, where rows of one id lie together: distinct ids are counted without another shuffle of them."""
    return spread(members.select("search_key", "id"), "id")


def shard_coverage(pages: DataFrame, members: DataFrame) -> DataFrame:
    """One row a shard: page counts by status, results found and reported."""

    def count(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    done = F.col("status") == "done"
    latest = F.max_by("total_results", F.when(done & (F.col("result_count") > 0) & F.col("total_results").isNotNull(), F.col("page")))
    shards = pages.groupBy("search_key").agg(
        F.min("params_json").alias("params_json"),
        F.count("*").alias("pages"),
        *[count(F.col("status") == s).alias(f"{s}_pages") for s in ("done", "pending", "in_progress", "failed")],
        count(done & (F.col("result_count") == 0)).alias("empty_done_pages"),
        F.coalesce(F.sum(F.when(done, F.col("result_count"))), F.lit(0)).cast("long").alias("discovered"),
        F.coalesce(latest, F.max("total_results")).alias("total"),
        F.max(F.when(done, F.col("page"))).alias("max_done_page"),
    )
    unique = _by_id(members).groupBy("search_key").agg(F.count_distinct("id").alias("unique_items"))
    return shards.join(unique, "search_key", "left").withColumn("unique_items", F.coalesce("unique_items", F.lit(0)))


def flagged(shards: DataFrame, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """Shards with missing, unfinished, gap, window_limited and ended_empty."""
    gap = F.coalesce(F.col("missing") > 0, F.lit(False))
    return (
        shards.withColumn("missing", missing(F.col("total"), F.col("discovered")))
        .withColumn("unfinished", (F.col("pending_pages") + F.col("in_progress_pages") + F.col("failed_pages")) > 0)
        .withColumn("gap", gap)
        .withColumn("window_limited", gap & (F.col("discovered") >= window_limit))
        .withColumn("ended_empty", F.col("empty_done_pages") > 0)
    )


def flags_text() -> Column:
    return F.concat_ws(",", F.when(F.col("unfinished"), "unfinished"), F.when(F.col("gap"), "gap"), F.when(F.col("window_limited"), "window-limit"))


def filter_shards(shards: DataFrame, catalogs: Sequence[str] = (), access: Sequence[str] = (), require_year: bool = False) -> DataFrame:
    """Shards that search all the catalogs and accesses asked for; unreadable parameters never do."""
    p = parsed_params(F.col("params_json"))
    keep = F.lit(True)
    for name, wanted in (("catalogs", catalogs), ("access", access)):
        if wanted:
            keep = keep & (F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), F.coalesce(p[name], F.array().cast("array<string>")))) == 0)
    if require_year:
        keep = keep & (p["publishyear_prev"].isNotNull() | p["publishyear_next"].isNotNull())
    return shards.filter(keep) if catalogs or access or require_year else shards


def group_coverage(shards: DataFrame, members: DataFrame, facets: Sequence[str] = FACETS) -> DataFrame:
    """Shards of one search under different sortings and facets, taken together.

    The union of ids over a group is one distinct count over memberships joined
    to the map of shards to the least shard of their group, which stands for the long key.
    """
    keyed = flagged(shards).withColumn("group_key", group_key(F.col("params_json"), facets))
    keyed = keyed.withColumn("lead", F.min("search_key").over(Window.partitionBy("group_key")))
    union = _by_id(members).join(keyed.select("search_key", "lead"), "search_key").groupBy("lead").agg(F.count_distinct("id").alias("stored"))
    groups = keyed.groupBy("group_key").agg(
        F.min("lead").alias("lead"),
        F.min_by("params_json", "search_key").alias("first_params"),
        F.count("*").alias("shard_count"),
        F.count_if("unfinished").alias("unfinished_shards"),
        F.max("discovered").alias("most_discovered"),
        F.max("total").alias("total"),
        F.array_join(F.array_sort(F.collect_list("search_key")), ",").alias("search_keys"),
    )
    found = groups.join(union, "lead", "left").withColumn("unique_items", F.greatest(F.coalesce("stored", F.lit(0)), "most_discovered"))
    return (
        found.withColumn("missing", missing(F.col("total"), F.col("unique_items")))
        .withColumn("gap", F.coalesce(F.col("missing") > 0, F.lit(False)))
        .withColumn("label", shard_label(group_key(F.col("first_params"), facets)))
        .drop("lead", "stored", "most_discovered", "first_params")
    )


def group_for(shards: DataFrame, members: DataFrame, params_json: str, facets: Sequence[str] = FACETS) -> DataFrame:
    """The group of one set of parameters, over all shards."""
    target = group_key(F.lit(params_json), facets)
    return group_coverage(shards.filter(group_key(F.col("params_json"), facets) == target), members, facets)


def coverage_summary(shards: DataFrame, members: DataFrame, facets: Sequence[str] = FACETS, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """One row of totals over shards and groups, and whether all groups are whole."""
    of_shards = flagged(shards, window_limit).agg(
        F.count("*").alias("shards"),
        F.count_if("unfinished").alias("unfinished_shards"),
        F.count_if("gap").alias("gap_shards"),
        F.count_if("window_limited").alias("window_limited_shards"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("per_query_missing"),
    )
    of_groups = group_coverage(shards, members, facets).agg(
        F.count("*").alias("groups"),
        F.count_if(F.col("unfinished_shards") > 0).alias("unfinished_groups"),
        F.count_if("gap").alias("gap_groups"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("grouped_missing"),
    )
    return of_shards.crossJoin(of_groups).withColumn("ok", (F.col("unfinished_groups") == 0) & (F.col("gap_groups") == 0))


def validate(pages: DataFrame, members: DataFrame, catalogs: Sequence[str] = (), access: Sequence[str] = (), require_year: bool = False, facets: Sequence[str] = FACETS, window_limit: int = WINDOW_LIMIT) -> dict:
    """The summary as a dict; an error when no shard passes the filters."""
    shards = filter_shards(shard_coverage(pages, members), catalogs, access, require_year)
    row = coverage_summary(shards, members, facets, window_limit).first().asDict()
    if not row["shards"]:
        raise CoverageError("coverage validation failed: no search pages found")
    return row


def suspicious_shards(shards: DataFrame, top: int = 50, show_all: bool = False, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """The shards to look at first."""
    seen = flagged(shards, window_limit)
    seen = seen if show_all else seen.filter(F.col("unfinished") | F.col("gap"))
    return seen.orderBy(F.coalesce("missing", F.lit(0)).desc(), F.desc("discovered"), "search_key").limit(top)


def suspicious_groups(groups: DataFrame, top: int = 50, show_all: bool = False) -> DataFrame:
    seen = groups if show_all else groups.filter((F.col("unfinished_shards") > 0) | F.col("gap"))
    return seen.orderBy(F.coalesce("missing", F.lit(0)).desc(), F.desc("unique_items"), "group_key").limit(top)


def shown(value: Column) -> Column:
    return F.when(value.isNull(), "None").otherwise(F.concat(F.lit("Some("), value.cast("string"), F.lit(")")))


def shard_line() -> Column:
    """A report line of a flagged shard."""
    flags = flags_text()
    counts = [F.concat(F.lit(f"{n}="), F.col(c).cast("string")) for n, c in (("pages", "pages"), ("done", "done_pages"), ("pending", "pending_pages"), ("in_progress", "in_progress_pages"), ("failed", "failed_pages"), ("discovered", "discovered"), ("unique", "unique_items"))]
    rest = [F.concat(F.lit("total="), shown(F.col("total"))), F.concat(F.lit("missing="), F.coalesce("missing", F.lit(0)).cast("string")), F.concat(F.lit("max_done_page="), shown(F.col("max_done_page")))]
    return F.concat(F.lit("  "), F.col("search_key"), F.lit(" | "), shard_label(F.col("params_json")), F.lit(" | "), F.concat_ws(" ", *counts, *rest), F.when(flags != "", F.concat(F.lit(" flags="), flags)).otherwise(""))


def group_line() -> Column:
    counts = [F.concat(F.lit(f"{n}="), F.col(c).cast("string")) for n, c in (("shards", "shard_count"), ("unfinished", "unfinished_shards"), ("unique", "unique_items"))]
    rest = [F.concat(F.lit("total="), shown(F.col("total"))), F.concat(F.lit("missing="), F.coalesce("missing", F.lit(0)).cast("string")), F.concat(F.lit("keys="), F.col("search_keys"))]
    return F.concat(F.lit("  "), F.col("group_key"), F.lit(" | "), F.col("label"), F.lit(" | "), F.concat_ws(" ", *counts, *rest))
