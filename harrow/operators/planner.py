"""Shard planning: initial searches, and more searches where a shard hits the result window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.scalars import abbreviate, facet_depth, fnv1a64, group_key, parsed_params, with_facet, with_sort
from harrow.operators.coverage import FACETS, flagged, group_coverage, shard_coverage
from harrow.session import settle

# The sortings tried on an overflowing shard, and the sorting of the search without years.
DEFAULT_SORTS = (
    ("document_titlesort", "asc"),
    ("document_titlesort", "desc"),
    ("document_authorsort", "asc"),
    ("document_authorsort", "desc"),
    ("document_publishyearsort", "asc"),
    ("document_publishyearsort", "desc"),
)
NO_YEAR_SORT = ("document_publishyearsort", "asc")
JOB = "label string, search_key string, params_json string, max_pages bigint, stop_after_known_pages bigint"


class PlanError(ValueError):
    """The plan's options contradict one another."""


@dataclass(frozen=True)
class SearchSpec:
    base_url: str
    query: str = ""
    catalogs: tuple[str, ...] = ()
    access: tuple[str, ...] = ()
    publishyear_prev: str | None = None
    publishyear_next: str | None = None
    sort_by: str | None = None
    order: str | None = None
    extra: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class PlannerConfig:
    shard_years: bool = False
    no_year_shard: bool = True
    no_year_max_pages: int = 666
    no_year_stop_after_known_pages: int = 5
    overflow_years: tuple[int, ...] = ()
    overflow_sorts: tuple[tuple[str, str], ...] = ()
    auto_overflow: bool = True
    overflow_facets: tuple[str, ...] | None = None
    auto_overflow_facets: bool = True
    max_overflow_facet_depth: int = 2
    window_limit: int = 9990
    start_page: int = 1

    @property
    def sorts(self) -> tuple[tuple[str, str], ...]:
        """Explicit sortings; else the defaults, where years are sharded and overflow is handled."""
        wanted = tuple(dict.fromkeys(self.overflow_sorts))
        return wanted or (DEFAULT_SORTS if self.shard_years and (self.auto_overflow or self.overflow_years) else ())

    @property
    def facets(self) -> tuple[str, ...]:
        if not (self.shard_years and self.auto_overflow and self.auto_overflow_facets):
            return ()
        named = tuple(dict.fromkeys(f.strip() for f in self.overflow_facets or () if f.strip()))
        return named or FACETS


def parse_pair(text: str) -> tuple[str, str]:
    """key=value, cut at the first sign."""
    key, sign, value = text.partition("=")
    if not sign:
        raise PlanError(f"expected key=value: {text}")
    return key, value


def parse_sort(text: str) -> tuple[str, str]:
    """field:order with a lower-cased order of asc or desc."""
    name, sign, order = text.partition(":")
    order = order.strip().lower()
    if not sign or not name.strip() or order not in ("asc", "desc"):
        raise PlanError(f"expected field:asc or field:desc: {text}")
    return name.strip(), order


def parse_year(name: str, value: str | None) -> int:
    if value is None:
        raise PlanError(f"{name} is required when years are sharded")
    if not (value.isascii() and value.isdigit()):
        raise PlanError(f"{name} must be an unsigned year: {value}")
    return int(value)


def _params(spec: SearchSpec, first: Column, last: Column, sort_by: Column, order: Column) -> Column:
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")
    extra = F.array(*[texts(p) for p in spec.extra]) if spec.extra else F.array().cast("array<array<string>>")
    cols = {"base_url": F.lit(spec.base_url), "query": F.lit(spec.query), "catalogs": texts(spec.catalogs), "access": texts(spec.access), "publishyear_prev": first, "publishyear_next": last, "sort_by": sort_by, "order": order, "extra": extra}
    return F.to_json(F.struct(*[c.cast("string").alias(n) if n not in ("catalogs", "access", "extra") else c.alias(n) for n, c in cols.items()]), {"ignoreNullFields": "false"})


def as_jobs(rows: DataFrame, max_pages: int | None = None, stop: int | None = None) -> DataFrame:
    """label and params_json with the key, and the limits if any."""
    return rows.select("label", fnv1a64(F.col("params_json")).alias("search_key"), "params_json", F.lit(max_pages).cast("long").alias("max_pages"), F.lit(stop).cast("long").alias("stop_after_known_pages"))


def initial_jobs(spark: SparkSession, spec: SearchSpec, config: PlannerConfig | None = None) -> DataFrame:
    """The searches to begin with: one, or one a year with the sortings of overflow years and a search without years."""
    config = config or PlannerConfig()
    none = F.lit(None)
    one = spark.range(1)
    if not config.shard_years:
        if config.overflow_years or config.overflow_sorts:
            raise PlanError("overflow years and sortings require sharding by year")
        return as_jobs(one.select(F.lit("default").alias("label"), _params(spec, F.lit(spec.publishyear_prev), F.lit(spec.publishyear_next), F.lit(spec.sort_by), F.lit(spec.order)).alias("params_json")))
    if config.overflow_sorts and not config.overflow_years and not config.auto_overflow:
        raise PlanError("overflow sortings without overflow years require automatic overflow")
    if config.no_year_shard and config.no_year_max_pages == 0:
        raise PlanError("the page limit of the search without years must be greater than zero")
    first, last = parse_year("publishyear_prev", spec.publishyear_prev), parse_year("publishyear_next", spec.publishyear_next)
    if first > last:
        raise PlanError("publishyear_prev must not exceed publishyear_next")
    if outside := [y for y in config.overflow_years if not first <= y <= last]:
        raise PlanError(f"overflow years outside the range: {outside}")
    years = spark.range(first, last + 1).select(F.col("id").cast("string").alias("year"), F.col("id"))
    year = F.col("year")
    jobs = as_jobs(years.select(F.concat(F.lit("year "), year).alias("label"), _params(spec, year, year, F.lit(spec.sort_by), F.lit(spec.order)).alias("params_json")))
    if config.overflow_years and config.sorts:
        sorts = spark.createDataFrame(list(config.sorts), "field string, way string")
        over = years.filter(F.col("id").isin(*config.overflow_years)).crossJoin(F.broadcast(sorts))  # a short list of sortings
        jobs = jobs.unionByName(as_jobs(over.select(F.concat(F.lit("year "), year, F.lit(" sort "), "field", F.lit(":"), "way").alias("label"), _params(spec, year, year, F.col("field"), F.col("way")).alias("params_json"))))
    if config.no_year_shard:
        stop = config.no_year_stop_after_known_pages or None
        rest = one.select(F.lit(f"no-year prefix sort {':'.join(NO_YEAR_SORT)}").alias("label"), _params(spec, none, none, F.lit(NO_YEAR_SORT[0]), F.lit(NO_YEAR_SORT[1])).alias("params_json"))
        jobs = jobs.unionByName(as_jobs(rest, config.no_year_max_pages, stop))
    return jobs


def overflowing(pages: DataFrame, members: DataFrame, facets: Sequence[str], window_limit: int) -> DataFrame:
    """Finished exact-year shards with a gap whose whole group is finished and has a gap too."""
    shards = shard_coverage(pages, members)
    groups = group_coverage(shards, members, facets).select("group_key", F.col("gap").alias("group_gap"), "unfinished_shards")
    p = parsed_params(F.col("params_json"))
    ended = flagged(shards, window_limit).filter(~F.col("unfinished") & F.col("ended_empty") & F.col("gap") & (p["publishyear_prev"] == p["publishyear_next"]))
    whole = ended.withColumn("group_key", group_key(F.col("params_json"), facets)).join(groups, "group_key")
    return whole.filter(F.col("group_gap") & (F.col("unfinished_shards") == 0)).withColumn("year", parsed_params(F.col("params_json"))["publishyear_prev"])


def sort_variants(shards: DataFrame, sorts: Sequence[tuple[str, str]]) -> DataFrame:
    """source, label and params_json of every shard in every sorting but its own."""
    if not sorts:
        return shards.select(F.col("search_key").alias("source"), F.lit("").alias("label"), "params_json").limit(0)
    table = shards.sparkSession.createDataFrame(list(sorts), "field string, way string")
    p = parsed_params(F.col("params_json"))
    both = shards.crossJoin(F.broadcast(table)).filter(~(p["sort_by"].eqNullSafe(F.col("field")) & p["order"].eqNullSafe(F.col("way"))))  # a short list of sortings
    label = F.concat(F.lit("year "), "year", F.lit(" auto overflow sort "), "field", F.lit(":"), "way")
    return both.select(F.col("search_key").alias("source"), label.alias("label"), with_sort(F.col("params_json"), F.col("field"), F.col("way")).alias("params_json"))


def facet_variants(shards: DataFrame, values: DataFrame, facets: Sequence[str], depth: int) -> DataFrame:
    """source, label and params_json of every shard under depth, narrowed to every value (field, value) it does not fix."""
    p = parsed_params(F.col("params_json"))
    open_ = shards.filter(facet_depth(F.col("params_json"), facets) < depth)
    used = F.exists(F.coalesce(p["extra"], F.array().cast("array<array<string>>")), lambda e: F.get(e, F.lit(0)) == F.col("field"))
    both = open_.join(values.filter(F.col("field").isin(*facets)), ~used)  # all values for each shard: what is planned
    others = F.array_join(F.transform(F.filter(p["extra"], lambda e: F.get(e, F.lit(0)) != F.col("field")), lambda e: F.concat(F.get(e, F.lit(0)), F.lit("="), abbreviate(F.get(e, F.lit(1))))), " ")
    label = F.concat_ws(" ", F.concat(F.lit("year "), "year", F.lit(" auto overflow facet")), F.nullif(others, F.lit("")), F.concat("field", F.lit("="), abbreviate(F.col("value"))))
    return both.select(F.col("search_key").alias("source"), label.alias("label"), with_facet(F.col("params_json"), F.col("field"), F.col("value")).alias("params_json"))


def overflow_jobs(pages: DataFrame, members: DataFrame, values: DataFrame, config: PlannerConfig, known: DataFrame | None = None) -> DataFrame:
    """New searches for overflowing shards: sortings first, facets for those whose sortings are all known.

    ``known``: search keys that are planned already, beside those with pages.
    """
    shards = settle(overflowing(pages, members, config.facets, config.window_limit))
    keys = pages.select("search_key") if known is None else pages.select("search_key").unionByName(known.select("search_key"))
    keys = keys.distinct()

    def fresh(rows: DataFrame) -> DataFrame:
        return rows.withColumn("search_key", fnv1a64(F.col("params_json"))).join(keys, "search_key", "left_anti")

    sorted_ = settle(fresh(sort_variants(shards, config.sorts)))
    jobs = sorted_
    if config.facets:
        left = shards.join(sorted_.select(F.col("source").alias("search_key")).distinct(), "search_key", "left_anti")
        jobs = jobs.unionByName(fresh(facet_variants(left, values, config.facets, config.max_overflow_facet_depth)))
    return jobs.groupBy("search_key").agg(F.min(F.struct("label", "source", "params_json")).alias("j")).select("search_key", "j.label", "j.source", "j.params_json")
