"""Crawls over a scripted transport, the state store and exports."""

import json
import lzma

import pytest
from pyspark.sql import functions as F

from harrow.control import ControlConfig, Crawl, Pace, RunLimits
from harrow.operators import coverage, export, planner, requests, state
from harrow.sources import web
from harrow.sources.transport import MemoryTransport
from harrow.store import StateStore
from harrow.streaming.pace import pace_events

BASE = "https://catalog.test/"


def search(ids, total):
    links = "".join(f'<a class="search-list__item_link" href="/catalog/{i}/">x</a>' for i in ids)
    return f"<html>Найдено {total} результатов {links}</html>"


def page(n):
    return f"{BASE}search/?q=x" + (f"&PAGEN_1={n}" if n > 1 else "")


def transport(pages, bad=()):
    answers = {page(n): (200, search(ids, total)) for n, (ids, total) in enumerate(pages, 1)}
    for i in {i for ids, _ in pages for i in ids}:
        answers[f"{BASE}catalog/{i}/"] = dict(bad).get(i, (200, f"<title>{i}</title>"))
        answers[f"{BASE}rest_api/viewer/access/?book_id={i}&viewer=Y"] = (200, '{"access":true,"token":"t"}')
    return MemoryTransport(answers)


def crawl(spark, folder, web_, **options):
    spec = planner.SearchSpec("https://catalog.test", "x")
    run = Crawl(spark, StateStore(spark, str(folder)), web_, spec, sleep=lambda _: None, **options)
    return run, run.run()


def test_persist_resume_export(spark, tmp_path):
    web_ = transport([(["A", "B"], 2), ([], 2)], {"B": (404, "")})
    run, verdict = crawl(spark, tmp_path / "db", web_)
    assert verdict == "complete" and run.outcomes["ok"] == 1 and run.outcomes["missing"] == 1
    again, verdict = crawl(spark, tmp_path / "db", MemoryTransport())
    assert verdict == "complete" and not any(again.outcomes.values())
    tables = run.store.tables()
    record = json.loads(tables["records"].first()["json"])
    assert record["viewer_access"] == {"access": True} and record["fetch_errors"] == ["MARC HTTP 404"]
    assert coverage.validate(tables["search_pages"], tables["search_items"])["ok"]
    export.jsonl(tables["records"], str(tmp_path / "x.jsonl.xz"))
    assert json.loads(lzma.open(tmp_path / "x.jsonl.xz").read()) == record
    files = export.export_all(tables, str(tmp_path / "out"), "mock")
    assert json.loads((tmp_path / "out/manifest.json").read_text())["state"]["items"]["missing"] == 1
    assert len((tmp_path / "out/SHA256SUMS").read_text().splitlines()) == len(files) - 1
    assert spark.read.parquet(files[1]).first()["id"] == "A"
    run.store.vacuum()
    assert run.store.table("items").count() == 2


def test_server_errors_are_deferred_and_forbidden_ones_fail(spark, tmp_path):
    web_ = transport([(["A", "B"], 2), ([], 2)], {"A": (500, ""), "B": (403, "")})
    run, verdict = crawl(spark, tmp_path / "db", web_, limits=RunLimits(max_items=2, max_attempts=1), control=ControlConfig(workers=1))
    rows = {r["id"]: r for r in run.store.table("items").collect()}
    assert verdict == "failed"
    assert (rows["A"]["status"], rows["A"]["attempts"], rows["A"]["last_http_status"]) == ("pending", 0, 500)
    assert (rows["B"]["status"], rows["B"]["attempts"], rows["B"]["last_error"]) == ("failed", 1, "card HTTP 403")
    again = state.retry_failed(run.store.table("items"), F.lit(1), 403).filter("id = 'B'").first()
    assert (again["status"], again["attempts"], again["last_error"]) == ("pending", 0, None)


def test_known_pages_stop(spark, tmp_path):
    web_ = transport([(["A"], 9), (["A"], 9), (["A"], 9), (["A"], 9)])
    run = Crawl(spark, StateStore(spark, str(tmp_path / "db")), web_, planner.SearchSpec("https://catalog.test", "x"), sleep=lambda _: None)
    run.begin()
    run._limits_of = {k: (None, 2) for k in run._limits_of}
    while run.search_round():
        pass
    assert run.store.table("search_pages").filter("status = 'done'").count() == 3
    assert run.store.table("search_items").count() == 3


def test_total_drift_takes_the_latest(spark):
    pages = spark.createDataFrame([("k", 1, "{}", "done", 0, 2, 3, None, 0), ("k", 2, "{}", "done", 0, 1, 2, None, 0), ("k", 3, "{}", "done", 0, 0, 9, None, 0)], "search_key string, page long, params_json string, status string, attempts int, result_count long, total_results long, last_error string, updated_at long")
    members = spark.createDataFrame([("k", 1, "A")], "search_key string, page long, id string")
    row = coverage.flagged(coverage.shard_coverage(pages, members)).first()
    assert (row["total"], row["discovered"], row["unique_items"], row["gap"]) == (2, 3, 1, False)
    with pytest.raises(coverage.CoverageError):
        coverage.validate(pages.limit(0), members)


def test_backfill_and_interrupted(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "db"))
    items = spark.createDataFrame([("A", "k", 1, "in_progress", 2, None, None, 0)], "id string, first_seen_search_key string, first_seen_page long, status string, attempts int, last_error string, last_http_status int, updated_at long")
    store.commit({"items": items})
    opened = StateStore(spark, str(tmp_path / "db"))
    assert opened.table("search_items").count() == 1
    reset = state.reset_interrupted(opened.table("items"), F.lit(1)).first()
    assert (reset["status"], reset["attempts"]) == ("pending", 2)


def test_pace():
    pace = Pace(ControlConfig(workers=3, min_workers=1, decrease_after=2, increase_after=2, transient_after=3, forbidden_after=2, forbidden_pause=7))
    assert [pace.see(s, True) for s in (500, None, 403, 404, 503)] == ["defer", "defer", "failed", "missing", "defer"]
    assert pace.active == 2 and pace.take_pause() == 60
    assert [pace.see(403, True) for _ in range(3)] == ["failed", "defer", "failed"] and pace.take_pause() == 7
    assert [pace.see(200, True) for _ in range(2)] == ["ok", "ok"] and pace.active == 3
    assert pace.see(404, False) == "failed"


def test_usage(spark):
    steps = spark.createDataFrame([("a", 1, 0.0, 4), ("a", 2, 10.0, 1), ("b", 1, 5.0, 3)], "k string, seq int, at double, value int")
    rows = {r["k"]: r for r in requests.usage(steps, "k", F.lit(30.0)).collect()}
    assert rows["a"]["average"] == pytest.approx(2.0) and rows["b"]["final"] == 3


def test_streaming_pace(spark, tmp_path):
    spark.createDataFrame([(i, 500 if i < 4 else 200) for i in range(6)], "seq long, http_status int").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("seq long, http_status int").parquet(str(tmp_path / "in"))
    query = pace_events(stream, ControlConfig(workers=4, decrease_after=2, transient_after=4)).writeStream.format("memory").queryName("pace").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    rows = spark.table("pace").orderBy("seq").collect()
    assert [r["workers"] for r in rows] == [4, 3, 3, 2, 2, 2] and rows[3]["pause"] == 60


def test_search_source(spark, tmp_path):
    web.register(spark)
    lines = [{"url": "http://x/1", "status": 200, "body": search(["A"], 1)}, {"url": "http://x/f", "status": 200, "body": '<i data-id="lang" data-value="ru"></i>'}]
    (tmp_path / "f.jsonl").write_text("\n".join(map(json.dumps, lines)))
    read = spark.read.format("harrow_search").option("fixtures", str(tmp_path / "f.jsonl"))
    assert read.option("urls", "http://x/1 http://x/2").load().orderBy("url").collect()[0]["ids"] == ["A"]
    assert read.option("urls", "http://x/f").option("kind", "facets").load().first()["value"] == "ru"


def test_ids_file(spark, tmp_path):
    (tmp_path / "ids").write_text(" b \n\n# no\na\nb\n")
    assert [r["id"] for r in web.read_ids(spark, str(tmp_path / "ids"), ("#x", " a ")).collect()] == ["#x", "a", "b"]
