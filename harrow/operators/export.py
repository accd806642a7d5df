"""Exports of a dataset: JSON Lines, flat Parquet, manifest and hashes."""

from __future__ import annotations

import datetime
import gzip
import hashlib
import json
import lzma
import os
import shutil
import subprocess
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators import state
from harrow.operators.flatten import parquet_rows


def _beside(target: Path) -> Path:
    target.parent.mkdir(parents=True, exist_ok=True)
    return target.with_name(f".{target.name}.tmp")


def codec_of(path: str) -> str:
    """gzip, xz or none, by the last extension."""
    return {".gz": "gzip", ".xz": "xz"}.get(Path(path).suffix, "none")


def jsonl(records: DataFrame, output: str) -> int:
    """Stored JSON, a line each, ordered by id, in one file that appears when whole.

    The order is made by a range shuffle; lines then stream to the driver a
    partition at a time, since one file has one writer.
    """
    target = Path(output)
    tmp, n = _beside(target), 0
    kind = codec_of(output)
    opened = gzip.open(tmp, "wb") if kind == "gzip" else lzma.open(tmp, "wb", preset=6) if kind == "xz" else open(tmp, "wb")
    with opened as f:
        for row in records.select("id", "json").orderBy("id").select("json").toLocalIterator():
            f.write(row["json"].encode() + b"\n")
            n += 1
        if kind == "none":
            f.flush()
            os.fsync(f.fileno())
    os.replace(tmp, target)
    return n


def jsonl_folder(records: DataFrame, output: str, compression: str = "gzip") -> None:
    """The same lines as a folder of ordered part files, written in parallel: the form for large datasets."""
    records.select("id", "json").orderBy("id").select("json").write.mode("overwrite").option("compression", compression).text(output)


def parquet(records: DataFrame, output: str, batch_size: int = 2048, single_file: bool = False) -> None:
    """The flat rows; one file on request, else a folder of files of at most ``batch_size`` * 512 rows."""
    rows = parquet_rows(records)
    if not single_file:
        rows.write.mode("overwrite").option("maxRecordsPerFile", str(max(batch_size, 1) * 512)).parquet(output)
        return
    target = Path(output)
    tmp = _beside(target)
    folder = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    rows.orderBy("id").coalesce(1).write.parquet(folder.as_uri())
    os.replace(next(folder.glob("part-*.parquet")), tmp)
    os.replace(tmp, target)
    shutil.rmtree(folder)


def hashed(path: str) -> dict:
    """Path, bytes and SHA-256 of a regular file."""
    p = Path(path)
    if not p.is_file():
        raise ValueError(f"not a regular file: {path}")
    with p.open("rb") as f:
        digest = hashlib.file_digest(f, "sha256")
    return {"path": str(path), "bytes": p.stat().st_size, "sha256": digest.hexdigest()}


def hashed_folder(spark, path: str) -> DataFrame:  # noqa: ANN001
    """Hashes of the files of a folder, by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_sums(paths: Sequence[str], output: str) -> None:
    target = Path(output)
    tmp = _beside(target)
    tmp.write_text("".join(f"{hashed(p)['sha256']}  {Path(p).name}\n" for p in paths))
    os.replace(tmp, target)


def _git(*args: str) -> str | None:
    try:
        done = subprocess.run(["git", *args], capture_output=True, text=True, timeout=10, check=False)
    except OSError:
        return None
    return done.stdout.strip() if done.returncode == 0 else None


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def manifest(tables: dict[str, DataFrame], output: str, dataset_name: str, files: Sequence[str] = (), crawl_command: str | None = None, argv: Sequence[str] = (), max_attempts: int = 5, failed_sample: int = 50, path: str = "") -> dict:
    """Describe the dataset: tool, commands, counts, time range, failures, output files."""
    began = _now()
    items, pages, records = tables["items"], tables["search_pages"], tables["records"]
    s = state.completion_summary(items, pages, records, max_attempts).first().asDict()
    bounds = state.time_bounds(pages, items, records).first()
    of = lambda prefix: {k: s[f"{prefix}{k}"] for k in (*state.STATUSES, "other")}
    stamp = lambda t: None if t is None else datetime.datetime.fromtimestamp(t, datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    dirty = _git("status", "--porcelain")
    whole = {
        "schema_version": 1,
        "dataset_name": dataset_name,
        "manifest_started_at": began,
        "manifest_finished_at": _now(),
        "tool": {"name": "harrow", "version": "1.0", "git_commit": _git("rev-parse", "HEAD"), "git_describe": _git("describe", "--tags", "--dirty", "--always"), "git_dirty": None if dirty is None else bool(dirty)},
        "commands": {"export_manifest": list(argv), "crawl": crawl_command},
        "state": {
            "path": path,
            "records": s["records"],
            "items": of("items_"),
            "search_pages": of("pages_"),
            "retryable_failed_items": s["items_retryable"],
            "exhausted_failed_items": s["items_exhausted"],
            "retryable_failed_search_pages": s["pages_retryable"],
            "exhausted_failed_search_pages": s["pages_exhausted"],
            "failed_403_items": s["items_failed_403"],
            "failed_403_search_pages": s["pages_failed_403"],
            "time_range": {"first_unix": bounds["first_at"], "last_unix": bounds["last_at"], "first": stamp(bounds["first_at"]), "last": stamp(bounds["last_at"])},
        },
        "failed_items": {
            "total": s["items_failed"],
            "by_http_status": [{"http_status": r["last_http_status"], "count": r["n"]} for r in state.failed_by_http_status(items).collect()],
            "sample": [r.asDict() for r in state.failed_sample(items, failed_sample).collect()],
        },
        "outputs": [hashed(f) for f in files],
    }
    target = Path(output)
    tmp = _beside(target)
    tmp.write_text(json.dumps(whole, indent=2, ensure_ascii=False) + "\n")
    os.replace(tmp, target)
    return whole


def export_all(tables: dict[str, DataFrame], folder: str, dataset_name: str) -> list[str]:
    """JSON Lines, Parquet, manifest and SHA256SUMS of a dataset in one folder."""
    out = [f"{folder}/{dataset_name}.jsonl.gz", f"{folder}/{dataset_name}.parquet", f"{folder}/manifest.json"]
    jsonl(tables["records"], out[0])
    parquet(tables["records"], out[1], single_file=True)
    manifest(tables, out[2], dataset_name, out[:2])
    write_sums(out, f"{folder}/SHA256SUMS")
    return [*out, f"{folder}/SHA256SUMS"]
