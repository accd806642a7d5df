"""Versioned state: tables as Parquet folders, versions as small files that name them.

A commit writes the changed tables to new folders and then creates the next
version file, which must not exist yet: readers see the old state or the new one,
and two writers cannot both commit.  Paths may lie in any file system that Spark
reaches.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.state import backfill_members, latest
from harrow.schemas import TABLES

#: Folders that a table that is added to may have before they become one.
FOLDERS = 32


class StateStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._root)
        if self.version() < 0:
            self.commit({})
        # An older state may lack memberships that first sightings imply.
        if "items" in self._tables() and self.table("items").filter("first_seen_search_key is not null").limit(1).count():
            members = self.table("search_items")
            whole = backfill_members(members, self.table("items"))
            if whole.count() > members.count():
                self.commit({"search_items": whole})

    def version(self) -> int:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=-1)

    def _tables(self) -> dict[str, list[str]]:
        v = self.version()
        if v < 0:
            return {}
        return self._named(v)

    def _named(self, version: int) -> dict[str, list[str]]:
        """The folders of each table; a table that is only added to has several, and the last row of a key counts."""
        named = json.loads(self.spark.read.text(f"{self.path}/versions/{version}.json", wholetext=True).first()[0])
        return {name: [at] if isinstance(at, str) else at for name, at in named.items()}

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        parts = [self.spark.read.schema(TABLES[name]).parquet(at) for at in folders]
        if len(parts) == 1:
            return parts[0]
        numbered = [p.withColumn("_turn", F.lit(n)) for n, p in enumerate(parts)]
        return latest(reduce(DataFrame.unionAll, numbered), "id", "_turn").drop("_turn")

    def table(self, name: str) -> DataFrame:
        folders = self._tables().get(name)
        return self._read(name, folders) if folders else self.spark.createDataFrame([], TABLES[name])

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def _write(self, name: str, df: DataFrame) -> str:
        at = f"{self.path}/tables/{name}/{uuid.uuid4().hex}"
        fields = [f.split(" ") for f in TABLES[name].split(", ")]
        df.select(*[df[n].cast(k).alias(n) for n, k in fields]).write.parquet(at)
        return at

    def commit(self, changed: dict[str, DataFrame], added: dict[str, DataFrame] | None = None) -> int:
        """Write ``changed`` and make the next version of it and the tables that stay.

        ``added``: rows that replace those of their id in tables that stay otherwise;
        only these rows are written, and now and then the folders become one.
        """
        v, now = self.version() + 1, self._tables()
        for name, df in changed.items():
            now[name] = [self._write(name, df)]
        for name, df in (added or {}).items():
            now[name] = [*now.get(name, []), self._write(name, df)]
            if len(now[name]) > FOLDERS:
                now[name] = [self._write(name, self._read(name, now[name]))]
        out = self._fs.create(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{v}.json"), False)
        try:
            out.write(bytearray(json.dumps(now).encode()))
        finally:
            out.close()
        return v

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions but the last ``keep``, and the tables that only they name."""
        last = self.version()
        kept = set()
        for v in range(max(0, last - keep + 1), last + 1):
            kept |= {at for folders in self._named(v).values() for at in folders}
        path = self._jvm.org.apache.hadoop.fs.Path
        for v in range(max(0, last - keep + 1)):
            self._fs.delete(path(f"{self.path}/versions/{v}.json"), False)
        for name in TABLES:
            folder = path(f"{self.path}/tables/{name}")
            if self._fs.exists(folder):
                for s in self._fs.listStatus(folder):
                    if f"{self.path}/tables/{name}/{s.getPath().getName()}" not in kept:
                        self._fs.delete(s.getPath(), True)
