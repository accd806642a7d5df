"""Messages between blocks of documents and shards of keys.

A block of documents asks the shard of a key once for all its documents, a shard
gathers what all blocks sent and answers each.  Messages are rows (to, source,
payload); a payload is a few arrays.  Row counts follow blocks times shards,
bytes follow the distinct keys of the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.arrays import U64, sorted_groups

NULL_ID = -(1 << 63)
SCHEMA = pa.schema([("to", pa.int64()), ("source", pa.int64()), ("payload", pa.binary())])
SENT = "to long, source long, payload binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one binary value, byte planes apart so that the shuffle's codec finds the zeros."""
    out = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(a.dtype.char.encode() + len(a).to_bytes(8, "little"))
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    found, at = [], 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind = np.dtype(chr(raw[at]))
        n = int.from_bytes(raw[at + 1 : at + 9], "little")
        at += 9
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return found


def sent(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA, strict=True)] if rows else [pa.array([], f.type) for f in SCHEMA], schema=SCHEMA)


def n_blocks(total: int, size: int | None = None, least: int = 2 << 20) -> int:
    """Blocks for ``total`` bytes of text: by default 4,000, but of ``least`` bytes at least and 64 MB at most."""
    return max(1, math.ceil(total / (size or min(max(total // 4000, least), 64 << 20))))


def in_blocks(docs: DataFrame, blocks: int, text: str, doc_id: str, together: bool = True, **more: Column) -> DataFrame:
    """id, text, block and ``more`` of every row; ``together``: rows with one id (or none) share a block, else the text deals them too."""
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), *[c.alias(n) for n, c in more.items()])
    key = [F.coalesce("id", F.lit(NULL_ID))] + ([] if together else [F.col("text")])
    return own.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(blocks)))


def block_rows(table: pa.Table) -> tuple[np.ndarray, list[bytes], list[int]]:
    """Ids (null: the least) and texts in an order that does not depend on how the rows arrived, and that order."""
    raw = table.column("text").cast(pa.large_binary()).to_pylist()
    ids = table.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = [t or b"" for t in raw]
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], order


def slices(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes, so that arrays stay small whatever a block holds."""
    a, size = 0, 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size >= most or b == len(texts):
            yield a, b
            a, size = b, 0


def by_shard(key: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Each shard that has keys, and where they are, in order."""
    shard = (key % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    g = sorted_groups(shard[order])
    return [(int(shard[order[a]]), order[a:b]) for a, b in zip(g[:-1], g[1:], strict=True) if b > a]
