"""Fetching as DataFrame operations, and search pages as a Python data source."""

from __future__ import annotations

import datetime
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from harrow.operators.extract import URLS, absolute, assemble, catalog_ids, facet_values
from harrow.sources.transport import FixtureTransport, HttpTransport, Transport

PAGE = "search_key string, page bigint, url string, status int, body string, error string"
RECORD = "id string, status int, error string, json string, fetched_at bigint"


def fetch_pages(requests: DataFrame, transport: Transport) -> DataFrame:
    """The answers to (search_key, page, url), fetched by the tasks that hold the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [transport.get(u) for u in batch["url"]]
            yield batch[["search_key", "page", "url"]].assign(status=pd.array([g[0] for g in got], "Int32"), body=[g[1] for g in got], error=[g[2] for g in got])

    return requests.mapInPandas(run, PAGE)


def fetch_records(ids: DataFrame, base_url: str, transport: Transport) -> DataFrame:
    """Card, MARC and viewer of every id as one record's JSON, or the status and error that stopped it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item in batch["id"]:
                now = int(time.time())
                stamp = datetime.datetime.fromtimestamp(now, datetime.UTC).isoformat()
                get = lambda kind, item=item: transport.get(absolute(base_url, URLS[kind].format(id=item)))
                card = get("card")
                rest = (get("marc"), get("viewer")) if card[0] is not None and 200 <= card[0] < 300 else ((None, None, None),) * 2
                text, status, error = assemble(item, base_url, now, stamp, card, *rest)
                rows.append((item, status, error, text, now))
            frame = pd.DataFrame(rows, columns=["id", "status", "error", "json", "fetched_at"])
            yield frame.assign(status=frame["status"].astype("Int32"))

    return ids.select("id").mapInPandas(run, RECORD)


def read_ids(spark: SparkSession, path: str | None = None, ids: tuple[str, ...] = ()) -> DataFrame:
    """Ids of a text file (blank lines and comments left out) and given ids, once each, in order."""
    bare = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    given = spark.createDataFrame([(i,) for i in ids], "id string").select(bare("id").alias("id"))
    if path:
        lines = spark.read.text(path).select(bare("value").alias("id")).filter(~F.col("id").startswith("#"))
        given = given.unionByName(lines)
    return given.filter(F.col("id") != "").distinct().orderBy("id")


class _Part(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class SearchSource(DataSource):
    """``spark.read.format("harrow_search")``: ids and totals of search URLs, or facet values.

    Options: urls (separated by blanks), kind (ids, facets), fields (separated by
    commas), fixtures (a JSON Lines file) or HTTP, timeout, delay, partitions.
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_search"

    def schema(self) -> str:
        if self.options.get("kind", "ids") == "facets":
            return "url string, field string, value string"
        return "url string, status int, ids array<string>, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _SearchReader(self.options)


class _SearchReader(DataSourceReader):
    def __init__(self, options) -> None:  # noqa: ANN001
        self.options = dict(options)

    def partitions(self) -> list[_Part]:
        urls = self.options.get("urls", "").split()
        n = max(1, min(len(urls) or 1, int(self.options.get("partitions", "8"))))
        return [_Part(urls[i::n]) for i in range(n)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        opts = self.options
        transport = FixtureTransport(opts["fixtures"]) if "fixtures" in opts else HttpTransport(float(opts.get("timeout", 45)), float(opts.get("delay", 0)))
        for url in partition.urls:
            status, body, error = transport.get(url)
            if opts.get("kind", "ids") == "facets":
                for field, values in facet_values(body or "", opts.get("fields", "lang,idlibrary").split(",")).items():
                    yield from ((url, field, v) for v in values)
            else:
                yield url, status, catalog_ids(body or "") if status == 200 else [], error


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SearchSource)
