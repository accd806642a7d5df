"""The crawl: rounds of discovery and fetching over the versioned state.

A round picks a bounded batch on the driver, fetches it in tasks, and commits
what came back in one version.  Only keys and statuses of the batch reach the
driver, where the streak rules decide, in order, what becomes of each answer;
bodies stay in the staged Parquet of the round.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.scalars import search_url, total_results
from harrow.operators import planner, state
from harrow.operators.extract import ids_column
from harrow.operators.requests import default_thresholds
from harrow.sources.transport import Transport
from harrow.sources.web import fetch_pages, fetch_records
from harrow.store import StateStore


@dataclass(frozen=True)
class RunLimits:
    start_page: int = 1
    max_pages: int | None = None
    max_items: int | None = None
    max_attempts: int = 5
    discover: bool = True
    batch: int = 256


@dataclass(frozen=True)
class ControlConfig:
    workers: int = 1
    min_workers: int = 1
    adaptive: bool = True
    decrease_after: int = 3
    increase_after: int = 50
    transient_after: int | None = None
    transient_pause: float = 60.0
    forbidden_after: int | None = None
    forbidden_pause: float = 600.0


@dataclass
class Pace:
    """Streaks over all requests in order: how many workers run, when to pause, what a failure means."""

    config: ControlConfig = field(default_factory=ControlConfig)
    active: int = 0
    transient: int = 0
    forbidden: int = 0
    successes: int = 0
    pause: float = 0.0
    usage: list[tuple[float, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.active = self.active or self.config.workers
        transient, forbidden = default_thresholds(self.config.workers)
        self.transient_after = transient if self.config.transient_after is None else self.config.transient_after
        self.forbidden_after = forbidden if self.config.forbidden_after is None else self.config.forbidden_after
        self.usage.append((time.time(), self.active))

    def _workers(self, n: int) -> None:
        if n != self.active:
            self.active = n
            self.usage.append((time.time(), n))

    def see(self, status: int | None, item: bool) -> str:
        """ok, defer, missing or failed for an answer; items alone can be missing and count as successes."""
        c = self.config
        if status is not None and 200 <= status < 300:
            self.transient = self.forbidden = 0
            if item and c.adaptive:
                self.successes += 1
                if self.successes >= c.increase_after:
                    self.successes = 0
                    self._workers(min(self.active + 1, c.workers))
            return "ok"
        if status is None or 500 <= status < 600:
            self.forbidden = 0
            self.transient += 1
            if c.adaptive:
                self.successes = 0
                if c.decrease_after and self.transient % c.decrease_after == 0:
                    self._workers(max(self.active - 1, c.min_workers))
            if self.transient_after and self.transient >= self.transient_after:
                self.transient, self.pause = 0, max(self.pause, c.transient_pause)
            return "defer"
        if status == 403:
            self.forbidden += 1
            if self.forbidden_after and self.forbidden >= self.forbidden_after:
                self.forbidden, self.pause = 0, max(self.pause, c.forbidden_pause)
                return "defer"
        else:
            self.forbidden = 0
        if item and status == 404:
            return "missing"
        if item and c.adaptive:
            self.successes = 0
        return "failed"

    def take_pause(self) -> float:
        due, self.pause = self.pause, 0.0
        return due


class Crawl:
    """Discovery and fetching until nothing is left, a limit is reached or ``stop`` is called."""

    def __init__(
        self,
        spark: SparkSession,
        store: StateStore,
        transport: Transport,
        spec: planner.SearchSpec,
        plan: planner.PlannerConfig | None = None,
        limits: RunLimits | None = None,
        control: ControlConfig | None = None,
        facets: Callable[[], DataFrame] | None = None,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        self.spark, self.store, self.transport, self.spec = spark, store, transport, spec
        self.plan, self.limits = plan or planner.PlannerConfig(), limits or RunLimits()
        self.pace, self.sleep, self._facets = Pace(control or ControlConfig()), sleep, facets
        self.stopped, self.started_items, self.outcomes = False, 0, {"ok": 0, "missing": 0, "failed": 0, "defer": 0}
        self._streak: dict[str, int] = {}
        self._ended: set[str] = set()
        self._values: DataFrame | None = None
        self._limits_of: dict[str, tuple[int | None, int | None]] = {}

    def stop(self) -> None:
        self.stopped = True

    # planning

    def _seed(self, jobs: DataFrame) -> int:
        pages = self.store.table("search_pages")
        before = pages.count()
        rows = jobs.select("search_key", F.lit(self.limits.start_page).alias("page"), "params_json", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(int(time.time())).alias("updated_at"))
        whole = state.insert_new(pages, rows, ["search_key", "page"])
        self.store.commit({"search_pages": whole})
        return self.store.table("search_pages").count() - before

    def begin(self, ids: DataFrame | None = None) -> None:
        """Recover what a stopped run left, enqueue given ids, plan and seed the searches."""
        now = F.lit(int(time.time()))
        self.store.commit({t: state.reset_interrupted(self.store.table(t), now) for t in ("items", "search_pages")})
        if ids is not None:
            self.enqueue(ids)
        if self.limits.discover:
            jobs = planner.initial_jobs(self.spark, self.spec, self.plan).collect()
            self._limits_of = {j["search_key"]: (j["max_pages"], j["stop_after_known_pages"]) for j in jobs}
            self._seed(self.spark.createDataFrame(jobs, planner.JOB))
            meta = self.spark.createDataFrame([("search_jobs", "\n".join(j["params_json"] for j in jobs), 1)], "key string, value string, seq int")
            old = self.store.table("meta").withColumn("seq", F.lit(0))
            self.store.commit({"meta": state.latest(old.unionByName(meta), "key", "seq").drop("seq")})

    def enqueue(self, ids: DataFrame, key: str | None = None, page: int | None = None) -> int:
        items = self.store.table("items")
        before = items.count()
        rows = ids.select("id", F.lit(key).alias("first_seen_search_key"), F.lit(page).alias("first_seen_page"), F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(int(time.time())).alias("updated_at"))
        self.store.commit({"items": state.insert_new(items, rows, ["id"])})
        return self.store.table("items").count() - before

    def _last_page(self, key: str) -> int | None:
        job = self._limits_of.get(key, (None, None))[0]
        n = min((x for x in (self.limits.max_pages, job) if x is not None), default=None)
        return None if n is None else self.limits.start_page + n - 1

    # rounds

    def _staged(self, answers: DataFrame) -> tuple[DataFrame, str]:
        """Answers written once: fetching again would give others."""
        at = f"{self.store.path}/staged/{uuid.uuid4().hex}"
        answers.write.parquet(at)
        return self.spark.read.parquet(at), at

    def _drop(self, at: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _pause(self) -> None:
        left = self.pace.take_pause()
        while left > 0 and not self.stopped:
            self.sleep(min(left, 5.0))
            left -= 5.0

    def search_round(self) -> int:
        """Fetch the next page of every shard that has one; the number fetched."""
        pages = self.store.table("search_pages")
        waiting = state.next_pages(pages, self.limits.max_attempts)
        if self._ended:
            waiting = waiting.join(self.spark.createDataFrame([(k,) for k in self._ended], "search_key string"), "search_key", "left_anti")
        known = [(k, last) for k in self._limits_of if (last := self._last_page(k)) is not None]
        waiting = waiting.join(self.spark.createDataFrame(known, "search_key string, last long"), "search_key", "left")
        others = F.lit(self._last_page("")).cast("long")
        nxt = waiting.filter(F.coalesce(F.col("page") <= F.coalesce("last", others), F.lit(True))).orderBy("search_key").limit(self.limits.batch).collect()
        if not nxt:
            return 0
        now = F.lit(int(time.time()))
        picked = self.spark.createDataFrame([(r["search_key"], r["page"], True) for r in nxt], "search_key string, page long, hit boolean")
        marked = pages.join(F.broadcast(picked), ["search_key", "page"], "left")  # at most a batch of rows
        self.store.commit({"search_pages": state.start(marked, F.coalesce("hit", F.lit(False)), now).drop("hit")})
        pages = self.store.table("search_pages")
        asked = pages.join(F.broadcast(picked), ["search_key", "page"]).select("search_key", "page", search_url(F.col("params_json"), F.col("page")).alias("url"))
        answers, at = self._staged(fetch_pages(asked.repartition(max(1, self.pace.active)), self.transport))
        read = answers.withColumn("ids", F.coalesce(ids_column("body"), F.array().cast("array<string>"))).withColumn("total", total_results(F.col("body")))
        found = read.filter("status between 200 and 299").select("search_key", "page", F.explode("ids").alias("id"))
        items = self.store.table("items")
        seen = found.withColumn("seq", F.concat("search_key", F.lpad(F.col("page").cast("string"), 12, "0")))
        fresh = state.new_items(items, seen)
        new_on = {(r["k"], r["p"]): r["n"] for r in fresh.groupBy(F.col("first_seen_search_key").alias("k"), F.col("first_seen_page").alias("p")).agg(F.count("*").alias("n")).collect()}
        rows = []
        for r in read.select("search_key", "page", "status", "error", F.size("ids").alias("n")).orderBy("search_key", "page").collect():
            key, page = r["search_key"], r["page"]
            what = self.pace.see(r["status"], item=False)
            nxt_page = None
            if what == "ok" and r["n"]:
                self._streak[key] = 0 if new_on.get((key, page)) else self._streak.get(key, 0) + 1
                stop = self._limits_of.get(key, (None, None))[1]
                if stop and self._streak[key] >= stop:
                    self._ended.add(key)
                elif (last := self._last_page(key)) is None or page < last:
                    nxt_page = page + 1
            error = r["error"] if r["status"] is None else f"search page HTTP {r['status']}"
            rows.append((key, page, what, None if what == "ok" else error, nxt_page))
        decided = self.spark.createDataFrame(rows, "search_key string, page long, what string, error string, next_page long")
        counts = read.select("search_key", "page", F.size("ids").alias("n"), "total")
        table = pages.join(F.broadcast(decided), ["search_key", "page"], "left").join(counts, ["search_key", "page"], "left")
        ok = F.coalesce(F.col("what") == "ok", F.lit(False))
        table = table.withColumn("status", F.when(ok, "done").otherwise(F.col("status"))).withColumn("result_count", F.when(ok, F.col("n").cast("long")).otherwise(F.col("result_count")))
        table = table.withColumn("total_results", F.when(ok, F.col("total")).otherwise(F.col("total_results"))).withColumn("last_error", F.when(ok, None).otherwise(F.col("last_error")))
        table = state.fail(table, F.coalesce(F.col("what") == "failed", F.lit(False)), F.col("error"), now)
        table = state.defer(table, F.coalesce(F.col("what") == "defer", F.lit(False)), F.col("error"), now)
        params = pages.select("search_key", "params_json").distinct()
        more = decided.filter("next_page is not null").join(params, "search_key").select("search_key", F.col("next_page").alias("page"), "params_json", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), now.alias("updated_at"))
        done = decided.filter("what = 'ok'").select("search_key", "page")
        enqueued = state.insert_new(items, fresh.withColumns({"status": F.lit("pending"), "attempts": F.lit(0), "updated_at": now}), ["id"])
        changed = {
            "search_pages": state.insert_new(table.select(*pages.columns), more, ["search_key", "page"]),
            "search_items": state.replace_members(self.store.table("search_items"), done, found),
            "items": enqueued,
        }
        self.store.commit(changed)
        self._drop(at)
        self._pause()
        return len(rows)

    def item_round(self) -> int:
        """Claim, fetch and store a batch of items; the number fetched."""
        left = self.limits.batch if self.limits.max_items is None else min(self.limits.batch, self.limits.max_items - self.started_items)
        if left <= 0:
            return 0
        items = self.store.table("items")
        ids = [r["id"] for r in state.claim_batch(items, left, self.limits.max_attempts).collect()]
        if not ids:
            return 0
        self.started_items += len(ids)
        now = F.lit(int(time.time()))
        picked = self.spark.createDataFrame([(i, n, True) for n, i in enumerate(ids)], "id string, turn int, hit boolean")
        marked = items.join(F.broadcast(picked), "id", "left")  # at most a batch of rows
        self.store.commit({"items": state.start(marked, F.coalesce("hit", F.lit(False)), now).select(*items.columns)})
        answers, at = self._staged(fetch_records(picked.repartition(max(1, self.pace.active)), self.spec.base_url, self.transport))
        rows = []
        for r in answers.join(F.broadcast(picked), "id").orderBy("turn").select("id", "status", "error").collect():
            what = self.pace.see(r["status"], item=True)
            self.outcomes[what] += 1
            rows.append((r["id"], what, r["status"], r["error"]))
        decided = self.spark.createDataFrame(rows, "id string, what string, http int, error string")
        items = self.store.table("items")
        table = items.join(F.broadcast(decided), "id", "left")
        is_ = lambda w: F.coalesce(F.col("what") == w, F.lit(False))
        table = table.withColumn("status", F.when(is_("ok"), "done").otherwise(F.col("status")))
        for what, change in (("failed", state.fail), ("defer", state.defer)):
            table = change(table, is_(what), F.col("error"), now, F.col("http"))
        table = state.mark_missing(table, is_("missing"), F.col("error"), now)
        self.store.commit({"items": table.select(*items.columns)}, {"records": answers.filter("json is not null").select("id", "json", "fetched_at")})
        self._drop(at)
        self._pause()
        return len(rows)

    def _overflow(self) -> int:
        """Seed more searches for overflowing shards; how many pages that added."""
        if not (self.plan.shard_years and self.plan.auto_overflow):
            return 0
        if self._values is None:
            self._values = self._facets() if self._facets else self.spark.createDataFrame([], "field string, value string")
        pages, members = self.store.table("search_pages"), self.store.table("search_items")
        return self._seed(planner.overflow_jobs(pages, members, self._values, self.plan))

    def run(self, ids: DataFrame | None = None) -> str:
        """Crawl to the end; complete, partial or failed."""
        self.begin(ids)
        while not self.stopped:
            backlog = state.backlog(self.store.table("items"), self.limits.max_attempts).first()[0]
            full = self.limits.max_items != 0 and backlog >= max(15, 3 * self.pace.config.workers)
            pages = self.search_round() if self.limits.discover and not full else 0
            fetched = self.item_round() if not self.stopped else 0
            if not pages and not fetched and not (self.limits.discover and self._overflow()):
                break
        summary = state.completion_summary(self.store.table("items"), self.store.table("search_pages"), self.store.table("records"), self.limits.max_attempts)
        limited = self.stopped or self.limits.max_items is not None or self.limits.max_pages is not None
        return state.verdict(summary, limited).first()["verdict"]
