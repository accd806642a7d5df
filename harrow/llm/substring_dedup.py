"""Substring dedup over words with a count-min prefilter.

First pass: every partition sketches how often each trigger occurs (the trigger
of a window is its ``GRAM``-word string of least hash; a window can't occur more
often than its trigger), two rows of cells.  The partial sketches are sparse,
are added up by cell range, and only one bit of a cell, whether it reached two,
is broadcast: ``2 * width / 8`` bytes, where the width is a fixed power of two
of at most ``MOST_CELLS``, 64 MB in all.  Counts in a sketch are never too low,
so a window that occurs twice always passes.

Second pass: windows estimated as repeated are grouped exactly
(:mod:`harrow.llm.repeats`), and all but the first place of each lose their words.
When a corpus outgrows the sketch, more windows pass it; results stay the same.

A window is ``k`` consecutive words.  A word goes when a window over it also
starts earlier: in a document with a smaller id, or earlier in the same one;
windows are judged on the input.  Words and windows are compared by hashes: 64
bits a word, 128 bits a window.

Edge cases: a null text has no words.  A null id is less than any other.  Rows
with the same id count as one document whose rows share word places: a place is
compared by (id, word number).  Texts of fewer than ``k`` words and empty tables
give rows (or none) with nothing removed.  Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm import repeats
from harrow.llm.arrays import BASES, U64, byte_values, chunks, joined, mix, sorted_groups, spans_hash, windows_hash, word_spans
from harrow.llm.textops import doc_bytes

K, GRAM = 20, 8
ROWS, RANGE, MOST_CELLS = 2, 1 << 20, 1 << 28
_SALT = (U64(0), U64(0x5851F42D4C957F2D))
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
COLUMNS = [("n_words", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("kept", pa.binary(), "binary"), ("spans", SPANS, "array<struct<start:int,end:int>>")]


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, at = joined(texts)
    start, end = word_spans(data)
    words = spans_hash(byte_values(data), start, end)
    first = np.searchsorted(start, at)
    return words, words, first[:-1], np.diff(first)


def window_classes(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    a, b = windows_hash(words, k)[starts], windows_hash(words, k, BASES[1])[starts]
    order = np.lexsort((b, a))
    new = np.zeros(len(order), np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    cls = np.empty(len(order), np.int64)
    cls[order] = np.cumsum(new)
    return cls


def cells(trigger: np.ndarray, row: int, width: int) -> np.ndarray:
    return mix(trigger ^ _SALT[row]) & U64(width - 1)


def _partial(kind: repeats.Kind, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sparse partial sketches: touched cells of a range and their counts, two at most."""
    schema = pa.schema([("range", pa.int32()), ("payload", pa.binary())])

    def told(triggers: list[np.ndarray]) -> pa.RecordBatch:
        rows = []
        for row in range(ROWS):
            cell, n = np.unique(cells(np.concatenate(triggers), row, width), return_counts=True)
            part = (cell // U64(RANGE)).astype(np.int64)
            for a, b in zip((g := sorted_groups(part))[:-1], g[1:], strict=True):
                if b > a:
                    inside = (cell[a:b] % U64(RANGE)).astype(np.int32)
                    rows.append((row * (MOST_CELLS // RANGE) + int(part[a]), repeats.pack(np.diff(inside, prepend=np.int32(0)), np.minimum(n[a:b], 2).astype(np.uint8))))
        return pa.record_batch([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(2)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, texts in chunks(batch, "text"):
                values, _, at, lengths = kind.symbols(texts)
                r = repeats.runs_of(values, at, lengths, kind)
                held.append(r.trigger)
                size += len(r.trigger)
                if size > 1 << 21:
                    yield told(held)
                    held, size = [], 0
        if size:
            yield told(held)

    return run


def _merge(table: pa.Table) -> pa.Table:
    total = np.zeros(RANGE, np.uint16)
    for p in table.column("payload"):
        gap, n = repeats.unpack(p.as_py())
        at = np.cumsum(gap)
        total[at] = np.minimum(total[at] + n, 2)
    return pa.table({"range": pa.array([table.column("range")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(total >= 2).tobytes()], pa.binary())})


def sketch(docs: DataFrame, kind: repeats.Kind, width: int, text: str = "text") -> np.ndarray:
    """Bits by sketch row and cell: whether the cell counted two or more over all documents."""
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_partial(kind, width), "range int, payload binary")
    rows = parts.groupBy("range").applyInArrow(_merge, "range int, bits binary").collect()
    bits = np.zeros((ROWS, max(width, RANGE) // 8), np.uint8)
    for r in rows:
        row, part = divmod(r["range"], MOST_CELLS // RANGE)
        bits[row, part * RANGE // 8 : (part + 1) * RANGE // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _finish(text: bytes, spans: list[tuple[int, int]]) -> tuple:
    words = text.split()  # bytes split at exactly the six ASCII blanks
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept), [{"start": a, "end": b} for a, b in spans]


def substring_dedup(docs: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id", block_bytes: int | None = None, width: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, the kept words and the removed spans of every document."""
    kind = repeats.Kind(k, min(GRAM, k), word_symbols, window_classes, by_place=True)
    total = doc_bytes(docs, text)
    width = width or min(MOST_CELLS, 1 << max(total // 10, 1 << 16).bit_length())
    shared = docs.sparkSession.sparkContext.broadcast(sketch(docs, kind, width, text))

    def may_repeat(trigger: np.ndarray) -> np.ndarray:
        keep = np.ones(len(trigger), bool)
        for row in range(ROWS):
            c = cells(trigger, row, width).astype(np.int64)
            keep &= (shared.value[row, c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
        return keep

    exact = repeats.Kind(k, kind.gram, word_symbols, window_classes, by_place=True, wanted=may_repeat)
    return repeats.cut_repeats(docs, exact, _finish, COLUMNS, text, doc_id, block_bytes, total)
