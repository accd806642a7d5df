"""Crawl state: analytics over the queue and its transitions as functions from DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.session import spread

STATUSES = ("pending", "in_progress", "done", "missing", "failed")
COUNTED = ("items", "search_pages")


def status_counts(table: DataFrame, name: str) -> DataFrame:
    """Rows by status; only the two queue tables have one."""
    if name not in COUNTED:
        raise ValueError(f"unsupported table for status counts: {name}")
    return table.groupBy("status").agg(F.count("*").alias("n"))


def status_pivot(table: DataFrame, prefix: str = "") -> DataFrame:
    known = [F.count_if(F.col("status") == s).alias(f"{prefix}{s}") for s in STATUSES]
    return table.agg(*known, F.count_if(~F.col("status").isin(*STATUSES)).alias(f"{prefix}other"))


def http_error(error: Column, status: int) -> Column:
    """Whether an error text names the HTTP status, in any case."""
    return F.coalesce(error.ilike(f"%HTTP {status}%"), F.lit(False))


def _failures(table: DataFrame, prefix: str, max_attempts: int, by_status: bool) -> DataFrame:
    failed = F.col("status") == "failed"
    forbidden = http_error(F.col("last_error"), 403)
    if by_status:
        forbidden = forbidden | F.coalesce(F.col("last_http_status") == 403, F.lit(False))
    return table.agg(
        F.count_if(failed & (F.col("attempts") < max_attempts)).alias(f"{prefix}retryable"),
        F.count_if(failed & (F.col("attempts") >= max_attempts)).alias(f"{prefix}exhausted"),
        F.count_if(failed & forbidden).alias(f"{prefix}failed_403"),
    )


def completion_summary(items: DataFrame, pages: DataFrame, records: DataFrame, max_attempts: int = 5) -> DataFrame:
    """One row: records, statuses of items and pages, failures that can and can't be retried, 403 failures."""
    parts = [
        status_pivot(items, "items_"),
        _failures(items, "items_", max_attempts, True),
        status_pivot(pages, "pages_"),
        _failures(pages, "pages_", max_attempts, False),
    ]
    out = records.agg(F.count("*").alias("records"))
    for part in parts:  # one-row tables
        out = out.crossJoin(part)
    return out


def unfinished_work(summary: DataFrame) -> DataFrame:
    names = [f"{p}{s}" for p in ("items_", "pages_") for s in ("pending", "in_progress", "retryable")]
    return summary.withColumn("unfinished", sum((F.col(n) for n in names), F.lit(0)))


def verdict(summary: DataFrame, stopped: bool = False) -> DataFrame:
    """complete, partial or failed; ``stopped``: by a signal or a limit."""
    exhausted = F.col("items_exhausted") + F.col("pages_exhausted")
    return unfinished_work(summary).withColumn(
        "verdict", F.when(exhausted > 0, "failed").when(F.col("unfinished") == 0, "complete").when(F.lit(stopped), "partial").otherwise("failed")
    )


def time_bounds(pages: DataFrame, items: DataFrame, records: DataFrame) -> DataFrame:
    at = pages.select(F.col("updated_at").alias("at")).unionAll(items.select("updated_at")).unionAll(records.select("fetched_at"))
    return at.agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def failed_by_http_status(items: DataFrame) -> DataFrame:
    counts = items.filter(F.col("status") == "failed").groupBy("last_http_status").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_first("last_http_status"))


def failed_sample(items: DataFrame, n: int = 50) -> DataFrame:
    return items.filter(F.col("status") == "failed").orderBy(F.desc("attempts"), F.desc("updated_at"), "id").limit(n)


def retryable(max_attempts: int) -> Column:
    return F.col("status").isin("pending", "failed") & (F.col("attempts") < max_attempts)


def backlog(items: DataFrame, max_attempts: int = 5) -> DataFrame:
    waiting = F.col("status").isin("pending", "in_progress") | ((F.col("status") == "failed") & (F.col("attempts") < max_attempts))
    return items.filter(waiting).agg(F.count("*").alias("backlog"))


def next_pages(pages: DataFrame, max_attempts: int = 5) -> DataFrame:
    return pages.filter(retryable(max_attempts)).groupBy("search_key").agg(F.min("page").alias("page"))


def claim_batch(items: DataFrame, n: int, max_attempts: int = 5) -> DataFrame:
    """The next items to fetch, longest unchanged first."""
    return items.filter(retryable(max_attempts)).orderBy("updated_at", "id").limit(n).select("id")


# Transitions.  ``when`` picks the rows; the others pass unchanged.


def _change(table: DataFrame, when: Column, **changes: Column) -> DataFrame:
    kinds = dict(table.dtypes)
    return table.withColumns({c: F.when(when, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in changes.items()})


def start(table: DataFrame, when: Column, now: Column) -> DataFrame:
    """in_progress, one more attempt, errors cleared (pages and items)."""
    cleared = {c: F.lit(None) for c in ("last_error", "last_http_status") if c in table.columns}
    return _change(table, when, status=F.lit("in_progress"), attempts=F.col("attempts") + 1, updated_at=now, **cleared)


def fail(table: DataFrame, when: Column, error: Column, now: Column, http_status: Column | None = None, status: str = "failed") -> DataFrame:
    more = {"last_http_status": http_status if http_status is not None else F.lit(None)} if "last_http_status" in table.columns else {}
    return _change(table, when, status=F.lit(status), last_error=error, updated_at=now, **more)


def mark_missing(items: DataFrame, when: Column, error: Column, now: Column) -> DataFrame:
    return fail(items, when, error, now, F.lit(404), "missing")


def defer(table: DataFrame, when: Column, error: Column, now: Column, http_status: Column | None = None) -> DataFrame:
    """Back to pending with the attempt given back; the error stays to be seen."""
    more = {"last_http_status": http_status if http_status is not None else F.lit(None)} if "last_http_status" in table.columns else {}
    return _change(table, when, status=F.lit("pending"), attempts=F.greatest(F.col("attempts") - 1, F.lit(0)), last_error=error, updated_at=now, **more)


def reset_interrupted(table: DataFrame, now: Column) -> DataFrame:
    """What a stopped run left in progress is pending again; its attempts stay."""
    return _change(table, F.col("status") == "in_progress", status=F.lit("pending"), updated_at=now)


def retry_failed(table: DataFrame, now: Column, http_status: int | None = None) -> DataFrame:
    """Failed rows start afresh: all, or those of one HTTP status."""
    when = F.col("status") == "failed"
    if http_status is not None:
        same = http_error(F.col("last_error"), http_status)
        if "last_http_status" in table.columns:
            same = same | F.coalesce(F.col("last_http_status") == http_status, F.lit(False))
        when = when & same
    cleared = {c: F.lit(None) for c in ("last_error", "last_http_status") if c in table.columns}
    return _change(table, when, status=F.lit("pending"), attempts=F.lit(0), updated_at=now, **cleared)


def insert_new(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key the table does not have, once each, beside the table's own."""
    fresh = rows.dropDuplicates(key).join(table.select(*key), key, "left_anti")
    return table.unionByName(fresh.select(*[F.col(c).cast(k).alias(c) if c in rows.columns else F.lit(None).cast(k).alias(c) for c, k in table.dtypes]))


def new_items(items: DataFrame, found: DataFrame) -> DataFrame:
    """Rows to insert for ids first seen in ``found`` (id, search_key, page, seq): the first sighting counts."""
    first = found.groupBy("id").agg(F.min_by(F.struct("search_key", "page"), "seq").alias("f"))
    fresh = first.join(items.select("id"), "id", "left_anti")
    return fresh.select("id", F.col("f.search_key").alias("first_seen_search_key"), F.col("f.page").alias("first_seen_page"))


def backfill_members(members: DataFrame, items: DataFrame) -> DataFrame:
    """Memberships with those that first sightings imply."""
    seen = items.filter(F.col("first_seen_search_key").isNotNull() & F.col("first_seen_page").isNotNull())
    both = members.select("search_key", "page", "id").unionByName(seen.select(F.col("first_seen_search_key").alias("search_key"), F.col("first_seen_page").alias("page"), "id"))
    return spread(both, "search_key", "page", "id").dropDuplicates()


def replace_members(members: DataFrame, page: DataFrame, found: DataFrame) -> DataFrame:
    """Memberships of the pages (search_key, page) replaced by ``found``."""
    return members.join(page, ["search_key", "page"], "left_anti").unionByName(found.dropDuplicates())


def latest(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key: what an upsert leaves."""
    whole = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), seq).alias("r"))
    return whole.select("r.*")


def ranked_claims(items: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Claim order inside each shard, for fair batches."""
    order = Window.partitionBy("first_seen_search_key").orderBy("updated_at", "id")
    return items.filter(retryable(max_attempts)).withColumn("turn", F.row_number().over(order))
