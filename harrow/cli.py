"""The command line: crawl, enqueue-ids, retry-failed, exports, stats, validate-coverage and report."""

from __future__ import annotations

import argparse
import json
import signal
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from harrow.control import ControlConfig, Crawl, RunLimits
from harrow.operators import coverage, export, planner, state
from harrow.session import local_session
from harrow.sources.transport import FixtureTransport, HttpTransport
from harrow.sources.web import fetch_pages, read_ids
from harrow.store import StateStore


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="harrow", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--db", required=True, help="folder of the state")
        return c

    def shards(c: argparse.ArgumentParser) -> None:
        for flag in ("--catalog", "--access", "--overflow-facet"):
            c.add_argument(flag, action="append", default=[])
        c.add_argument("--require-year", action="store_true")
        c.add_argument("--window-limit-results", type=int, default=9990)
        c.add_argument("--top", type=int, default=50)
        c.add_argument("--show-all", action="store_true")

    crawl = command("crawl")
    crawl.add_argument("--base-url", required=True)
    crawl.add_argument("--query", default="")
    for flag in ("--catalog", "--access", "--extra-param", "--overflow-year", "--overflow-sort", "--overflow-facet", "--id"):
        crawl.add_argument(flag, action="append", default=[])
    for flag in ("--publishyear-prev", "--publishyear-next", "--sort-by", "--order", "--ids-file", "--export-jsonl", "--fixtures", "--proxy"):
        crawl.add_argument(flag)
    for flag in ("--shard-years", "--skip-no-year-shard", "--no-auto-overflow", "--no-auto-overflow-facets", "--no-discover", "--fixed-workers"):
        crawl.add_argument(flag, action="store_true")
    for flag, n in (("--no-year-max-pages", 666), ("--no-year-stop-after-known-pages", 5), ("--max-overflow-facet-depth", 2), ("--search-window-limit-results", 9990), ("--start-page", 1), ("--max-attempts", 5), ("--workers", 1), ("--min-workers", 1), ("--adaptive-decrease-after", 3), ("--adaptive-increase-after", 50)):
        crawl.add_argument(flag, type=int, default=n)
    for flag in ("--max-pages", "--max-items", "--error-pause-threshold", "--http-403-pause-threshold"):
        crawl.add_argument(flag, type=int)
    for flag, n in (("--delay-ms", 0.0), ("--timeout-secs", 45.0), ("--error-pause-secs", 60.0), ("--http-403-pause-secs", 600.0)):
        crawl.add_argument(flag, type=float, default=n)
    crawl.add_argument("--user-agent", default="harrow/1.0")

    ids = command("enqueue-ids")
    ids.add_argument("--id", action="append", default=[])
    ids.add_argument("--ids-file")
    command("retry-failed").add_argument("--http-status", type=int)
    command("export-jsonl").add_argument("--output", required=True)
    flat = command("export-parquet")
    flat.add_argument("--output", required=True)
    flat.add_argument("--batch-size", type=int, default=2048)
    m = command("export-manifest")
    m.add_argument("--output", required=True)
    m.add_argument("--dataset-name", required=True)
    m.add_argument("--crawl-command")
    m.add_argument("--file", action="append", default=[])
    m.add_argument("--max-attempts", type=int, default=5)
    m.add_argument("--failed-item-sample", type=int, default=50)
    command("stats")
    shards(command("validate-coverage"))
    r = command("report")
    shards(r)
    r.add_argument("--max-attempts", type=int, default=5)
    r.add_argument("--failed-item-sample", type=int, default=20)
    return p


def _coverage(store: StateStore, a: argparse.Namespace) -> bool:
    pages, members = store.table("search_pages"), store.table("search_items")
    facets = tuple(dict.fromkeys(f.strip() for f in a.overflow_facet if f.strip())) or coverage.FACETS
    row = coverage.validate(pages, members, a.catalog, a.access, a.require_year, facets, a.window_limit_results)
    for k, v in row.items():
        print(f"{k}: {v}")
    kept = coverage.filter_shards(coverage.shard_coverage(pages, members), a.catalog, a.access, a.require_year)
    seen = coverage.suspicious_shards(kept, a.top, a.show_all, a.window_limit_results)
    groups = coverage.suspicious_groups(coverage.group_coverage(kept, members, facets), a.top, a.show_all)
    for frame, line in ((seen, coverage.shard_line()), (groups, coverage.group_line())):
        for r in frame.select(line.alias("line")).collect():
            print(r["line"])
    return row["ok"]


def _crawl(spark: SparkSession, store: StateStore, a: argparse.Namespace) -> int:
    transport = FixtureTransport(a.fixtures) if a.fixtures else HttpTransport(a.timeout_secs, a.delay_ms / 1000, a.user_agent, a.proxy)
    spec = planner.SearchSpec(a.base_url, a.query, tuple(a.catalog), tuple(a.access), a.publishyear_prev, a.publishyear_next, a.sort_by, a.order, tuple(planner.parse_pair(x) for x in a.extra_param))
    plan = planner.PlannerConfig(
        a.shard_years, not a.skip_no_year_shard, a.no_year_max_pages, a.no_year_stop_after_known_pages, tuple(int(y) for y in a.overflow_year), tuple(planner.parse_sort(x) for x in a.overflow_sort),
        not a.no_auto_overflow, tuple(a.overflow_facet) or None, not a.no_auto_overflow_facets, a.max_overflow_facet_depth, a.search_window_limit_results, a.start_page,
    )
    limits = RunLimits(a.start_page, a.max_pages, a.max_items, a.max_attempts, not a.no_discover)
    control = ControlConfig(a.workers, a.min_workers, not a.fixed_workers, a.adaptive_decrease_after, a.adaptive_increase_after, a.error_pause_threshold, a.error_pause_secs, a.http_403_pause_threshold, a.http_403_pause_secs)

    def facets():  # noqa: ANN202
        from harrow.operators.extract import facet_values

        url = f"{a.base_url.rstrip('/')}/search/extended/"
        asked = spark.createDataFrame([("facets", 1, url)], "search_key string, page long, url string")
        body = fetch_pages(asked, transport).first()["body"] or ""
        return spark.createDataFrame([(f, v) for f, vs in facet_values(body, plan.facets).items() for v in vs], "field string, value string")

    run = Crawl(spark, store, transport, spec, plan, limits, control, facets)
    signal.signal(signal.SIGINT, lambda *_: run.stop())
    ids = read_ids(spark, a.ids_file, tuple(a.id)) if a.ids_file or a.id else None
    verdict = run.run(ids)
    print(json.dumps({"verdict": verdict, **run.outcomes}))
    if a.export_jsonl:
        export.jsonl(store.table("records"), a.export_jsonl)
    return int(verdict == "failed")


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    store = StateStore(spark, a.db)
    now = F.lit(int(time.time()))
    if a.command == "crawl":
        return _crawl(spark, store, a)
    if a.command == "enqueue-ids":
        items = store.table("items")
        ids = read_ids(spark, a.ids_file, tuple(a.id)).select("id", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), now.alias("updated_at"))
        store.commit({"items": state.insert_new(items, ids, ["id"])})
        print(f"enqueued {store.table('items').count() - items.count()}")
    elif a.command == "retry-failed":
        store.commit({t: state.retry_failed(store.table(t), now, a.http_status) for t in ("items", "search_pages")})
    elif a.command == "export-jsonl":
        print(f"exported {export.jsonl(store.table('records'), a.output)}")
    elif a.command == "export-parquet":
        export.parquet(store.table("records"), a.output, a.batch_size, single_file=True)
    elif a.command == "export-manifest":
        export.manifest(store.tables(), a.output, a.dataset_name, a.file, a.crawl_command, sys.argv, a.max_attempts, a.failed_item_sample, a.db)
    elif a.command == "stats":
        for t in ("items", "search_pages"):
            print(t, state.status_pivot(store.table(t)).first().asDict())
        print("records", store.table("records").count())
    elif a.command == "validate-coverage":
        return int(not _coverage(store, a))
    elif a.command == "report":
        summary = state.completion_summary(store.table("items"), store.table("search_pages"), store.table("records"), a.max_attempts)
        row = state.verdict(summary).first().asDict()
        print(row)
        for r in state.failed_by_http_status(store.table("items")).collect():
            print("failed", r["last_http_status"], r["n"])
        for r in state.failed_sample(store.table("items"), a.failed_item_sample).collect():
            print("failed item", r["id"], r["attempts"], r["last_http_status"], r["last_error"])
        return int(not (_coverage(store, a) and row["verdict"] == "complete"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
