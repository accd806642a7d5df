"""Benchmark decontamination by random-walk embedding and bit-sampling hashing.

A document is contaminated by a benchmark item of n words when some passage of it
is within ``floor(n * slack)`` word edits of the item.  Words are runs of ASCII
letters, digits and non-ASCII characters, A-Z lower-cased, so case and
punctuation do not matter.

At every place of a text an item-sized window could start.  By the q-gram lemma
a matching one shares at least n - q + 1 - qe strings of q words with the item (e
edits, each breaks q); windows with fewer such strings of any item are left out,
which loses nothing.  q is 3, or 2 for short items for which 3 says too little.  The others are embedded by random walks (Chakraborty, Goldenberg and
Koucky): the walk copies a word and steps on or stays by a random bit of step and
word, so that edit distance becomes Hamming distance.  ``WALKS`` walks with
``SAMPLES`` samples of ``BITS`` coordinates each make the hash tables in which
windows meet items; with ``BITS`` = 3 and a Hamming similarity of 0.5 the tables
find all but (1 - 1/8)**48 = 0.2 % of the matches at one alignment, and a match
has several.  What meets is verified by exact edit distance.

Items are broadcast in blocks of at most ``ITEMS`` rows and ``ITEM_BYTES`` bytes;
larger benchmarks take more blocks, each against all documents.

Edge cases: null or empty texts match nothing.  Items of fewer than ``least_words``
words, which any text may hold by chance, are not searched for; ``short_items``
reports them.  Ids may have any type; null ids are reported as null.  Of passages
with equally few edits the first is reported.  Very long texts are single rows.  Repeated rows are reported each.
An empty table gives an empty result.  Extra columns do not matter;
``decontaminate`` returns all columns of its input unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from harrow.llm.arrays import LOWER, U64, byte_values, chunks, joined, mix, spans_hash, windows_hash

WALKS, SAMPLES, BITS = 8, 6, 3
ITEMS, ITEM_BYTES = 20_000, 32 << 20
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PAD = U64(0)


def folded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and the first word of each text (and the end)."""
    data, at = joined(texts)
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = _IN_WORD[data]
    step = np.diff(solid)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return spans_hash(byte_values(LOWER[data]), start, end), np.searchsorted(start, at)


def grams(words: np.ndarray, q: int) -> np.ndarray:
    return windows_hash(words, q)


def needed(n: int, e: int) -> tuple[int, int]:
    """q, and how many strings of q words a window within e edits of n words shares with them at least."""
    q = 3 if n - 2 - 3 * e >= 2 else 2
    return q, max(n - q + 1 - q * e, 1)


def walk(words: np.ndarray, start: np.ndarray, length: np.ndarray, steps: int, walks: int = WALKS) -> np.ndarray:
    """Embeddings [walk, window, step] of the windows words[start:start + length]."""
    at = np.zeros((walks, len(start)), np.int64)
    out = np.empty((walks, len(start), steps), U64)
    padded = np.r_[words, _PAD]
    salt = mix(np.arange(1, walks + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))[:, None]
    for j in range(steps):
        inside = at < length
        x = np.where(inside, padded[np.minimum(start + at, len(words))], _PAD)
        out[:, :, j] = x
        at += (mix(x + salt + U64(j * 2654435761)) >> U64(33) & U64(1)).astype(np.int64) * inside
    return out


@dataclass
class Grams:
    """Strings of q words of the items, sorted; a bit for each hash; the item sizes that hold each string."""

    known: np.ndarray
    bits: np.ndarray
    at: np.ndarray
    sizes: np.ndarray

    def find(self, g: np.ndarray) -> np.ndarray:
        """Places in g of strings that some item holds."""
        at = np.flatnonzero(self.bits[(g & U64((1 << 20) - 1)).astype(np.int64)])
        return at[self.known[np.minimum(np.searchsorted(self.known, g[at]), len(self.known) - 1)] == g[at]]


@dataclass
class Items:
    """Benchmark items as words, and the tables in which windows look them up."""

    ids: list
    words: list[np.ndarray]
    edits: np.ndarray
    grams: dict[int, Grams]
    keys: np.ndarray
    owners: np.ndarray
    sizes: np.ndarray


def _keys(embedded: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One key a table for each window: walk, sample and item size enter the key."""
    walks, n, _ = embedded.shape
    out = np.empty((walks * SAMPLES, n), U64)
    for w in range(walks):
        for s in range(SAMPLES):
            k = np.full(n, U64(w * SAMPLES + s + 1)) + length.astype(U64) * U64(0x51ED270B)
            for b in range(BITS):
                # coordinates spread over the 2 n steps in which most walks move
                r = mix(np.full(n, U64(1 + b + BITS * (s + SAMPLES * w))) + length.astype(U64) * U64(131)) % np.maximum(2 * length, 1).astype(U64)
                k = mix(k ^ embedded[w, np.arange(n), r.astype(np.int64)])
            out[w * SAMPLES + s] = k
    return out


def prepare(rows: list[tuple], slack: float, least_words: int) -> Items:
    words, first = folded_words([(t or "").encode() for _, t in rows])
    found = [(i, words[a:b]) for (i, _), a, b in zip(rows, first[:-1], first[1:], strict=True) if b - a >= max(least_words, 2)]
    n = np.array([len(w) for _, w in found], np.int64)
    flat = np.concatenate([w for _, w in found]) if found else np.zeros(0, U64)
    begin = np.cumsum(n) - n
    known = {}
    for q in {needed(int(k), math.floor(k * slack))[0] for k in n}:
        held = [grams(w, q) for _, w in found]
        both = np.unique(np.stack([np.concatenate(held), np.repeat(n, [len(g) for g in held]).astype(U64)]), axis=1)
        g, at = np.unique(both[0], return_index=True)
        bits = np.zeros(1 << 20, bool)
        bits[(g & U64((1 << 20) - 1)).astype(np.int64)] = True
        known[q] = Grams(g, bits, np.r_[at, both.shape[1]], both[1].astype(np.int64))
    keys = _keys(walk(flat, begin, n, int(2 * n.max(initial=1))), n)
    order = np.argsort(keys.ravel(), kind="stable")
    owners = np.tile(np.arange(len(found)), WALKS * SAMPLES)[order]
    return Items([i for i, _ in found], [w for _, w in found], np.array([math.floor(k * slack) for k in n], np.int64), known, keys.ravel()[order], owners, np.unique(n))


def passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between the item and any passage of the text, and where such a passage ends."""
    row, steps = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, w in enumerate(item):
        best = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        best = np.r_[i + 1, best]
        row = np.minimum.accumulate(best - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def _windows(hits: dict[int, tuple[np.ndarray, np.ndarray]], items: Items, a: int, b: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the windows of the text at words a to b that share enough with items of their size."""
    starts, lengths = [], []
    for q, (place, gram) in hits.items():
        k = items.grams[q]
        lo, hi = np.searchsorted(place, (a, b))
        span = np.diff(k.at)[gram[lo:hi]]
        size = k.sizes[np.repeat(k.at[gram[lo:hi]], span) + np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)]
        where = np.repeat(place[lo:hi], span)
        for n in np.unique(size).tolist():
            e = math.floor(n * slack)
            own, need = needed(n, e)
            here = where[size == n]
            if own != q or len(here) < need:
                continue
            # Only places from n + e words before a hit can have enough of them.
            s = np.unique((here[:, None] - np.arange(n + e)[None, :]).ravel())
            s = s[(s >= a) & (s <= b - (n - e))]
            s = s[np.searchsorted(here, s + n + e - q + 1) - np.searchsorted(here, s) >= need]
            starts.append(s)
            lengths.append(np.full(len(s), n))
    return (np.concatenate(starts), np.concatenate(lengths)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def search(texts: list[bytes], items: Items, slack: float) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, last word) of every item that a text holds; the best passage of each."""
    if not items.ids:
        return []
    words, first = folded_words(texts)
    begin, end = first[:-1], first[1:]
    hits, possible = {}, np.zeros(len(words) + 1, bool)
    for q, k in items.grams.items():
        g = grams(words, q)
        place = k.find(g)
        hits[q] = place, np.searchsorted(k.known, g[place])
        # The widest window and the least need of any size rule out nearly all texts at once.
        own = [(n + math.floor(n * slack), needed(n, math.floor(n * slack))) for n in items.sizes.tolist()]
        wide, need = max(w for w, (o, _) in own if o == q), min(x for _, (o, x) in own if o == q)
        possible[place] |= np.searchsorted(place, place + wide) - np.arange(len(place)) >= need
    seen = np.r_[0, np.cumsum(possible)]
    many = np.flatnonzero(seen[end] > seen[begin])
    found: dict[tuple[int, int], tuple[int, int]] = {}
    got = [(t, *_windows(hits, items, int(begin[t]), int(end[t]), slack)) for t in many.tolist()]
    text = np.concatenate([np.full(len(s), t) for t, s, _ in got]) if got else np.zeros(0, np.int64)
    start, length = (np.concatenate([g[i] for g in got]) if got else text for i in (1, 2))
    done: dict[tuple[int, int], int] = {}
    for c in range(0, len(start), 4096):
        t, s, n = (x[c : c + 4096] for x in (text, start, length))
        keys = _keys(walk(words, s, np.minimum(n, end[t] - s), int(2 * n.max())), n)
        lo, hi = np.searchsorted(items.keys, keys.ravel(), "left"), np.searchsorted(items.keys, keys.ravel(), "right")
        met = np.flatnonzero(hi > lo)
        window = np.tile(np.arange(len(s)), len(keys))[met]
        span = (hi - lo)[met]
        who = items.owners[np.repeat(lo[met], span) + np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)]
        for k in np.unique(who * len(s) + np.repeat(window, span)).tolist():
            i, w = divmod(k, len(s))
            x, own = int(s[w]), int(t[w])
            if x < done.get((own, i), -1):
                continue  # the verification of an earlier window covers this start
            n_i, e = len(items.words[i]), int(items.edits[i])
            low, high = max(int(begin[own]), x - e), min(int(end[own]), x + 2 * n_i + 2 * e)
            edits, stop = passage(items.words[i], words[low:high])
            if edits <= e and ((best := found.get((own, i))) is None or edits < best[0]):
                found[own, i] = (edits, low + stop - int(begin[own]))
            done[own, i] = x + n_i
    return [(t, i, e, w) for (t, i), (e, w) in sorted(found.items())]


def _item_blocks(benchmark: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    blocks = max(1, math.ceil(n / ITEMS), math.ceil((size or 0) / ITEM_BYTES))
    if blocks == 1:
        return [rows]
    blocks *= 2  # hashing deals unevenly
    return [rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def _prepared(block: DataFrame, slack: float, least_words: int) -> Items:
    return prepare([(r["item_id"], r["text"]) for r in block.collect()], slack, least_words)


def contaminations(docs: DataFrame, benchmark: DataFrame, slack: float = 0.2, least_words: int = 5, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_words of the item, edits and end_word of the best passage, for each document and item that match."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = benchmark.schema[item_id].dataType
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType), T.StructField("item_id", kind), *[T.StructField(c, T.LongType()) for c in ("n_words", "edits", "end_word")]])
    found = None
    for block in _item_blocks(benchmark, item_id, text):
        shared = docs.sparkSession.sparkContext.broadcast(_prepared(block, slack, least_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for first, texts in chunks(batch, "text"):
                    got = search(texts, items, slack)
                    if got:
                        ids = batch.column("doc_id").slice(first, len(texts)).take(pa.array([g[0] for g in got]))
                        columns = [[len(items.words[g[1]]) for g in got], [g[2] for g in got], [g[3] for g in got]]
                        yield pa.record_batch([ids, pa.array([items.ids[g[1]] for g in got], to_arrow_type(kind)), *[pa.array(c, pa.int64()) for c in columns]], names=schema.names)

        part = own.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def short_items(benchmark: DataFrame, least_words: int = 5, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """item_id and n_words of the items that are too short to be searched for."""
    counted = benchmark.select(F.col(item_id).alias("item_id"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[A-Za-z0-9\\x{80}-\\x{10FFFF}]+")).cast("long").alias("n_words"))
    return counted.filter(F.col("n_words") < least_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, slack: float = 0.2, least_words: int = 5, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns."""
    for block in _item_blocks(benchmark, item_id, "text"):
        shared = docs.sparkSession.sparkContext.broadcast(_prepared(block, slack, least_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in chunks(batch, text):
                    keep[[first + g[0] for g in search(texts, shared.value, slack)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
