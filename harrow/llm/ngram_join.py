"""N-gram Jaccard join by PartEnum signatures.

The set of a document holds its distinct word n-grams.  Two documents link when
the Jaccard similarity of their sets is at least ``percent`` / 100; components
are the classes that links reach.

Signatures.  Sizes are cut into bands.  In a band whose sets have at most r
elements, linked sets differ in at most k = 2 r (100 - percent) / (100 + percent)
elements.  The domain of elements is split by hash into n1 parts so that one of
them has at most one difference, and each part into pieces (two, or three below 85
percent) of which all but one then agree; so the set emits, for each part, one
signature for each choice of the piece left out.  Linked sets of a band share a
signature without fail.  A set that can link with sets of the next band signs for
that band too.

Sets with equal content have one hash and are one node from the start.  Signatures
go to shards by hash, packed; a shard lists the groups of nodes that share one,
groups of the same nodes once.

Candidates.  A set's *bins* are bits, at least ``BITS`` for each element; each element
turns the one of its hash's class.  Of two sets with unlike numbers of bins, a power of
two, the finer one's are folded.  Bins differ by no more than the sets do, so a pair
whose bins or sizes differ by more than a link allows is no link; this rules out nearly
all that met by chance, and nothing else.

Candidate clusters.  Two nodes are *alike* when they share a group and bins and
sizes allow a link.  Clusters are the components of that relation, so linked nodes
always lie in one.  They are found in two steps: each node with the first of each of
its groups; then, in every group whose nodes are still in different components,
these against one another, in blocks of ``MEMBERS`` dealt among tasks, many rows at
once.  A task emits no more edges than it has components to join.

Verification is exact, on the sets of hashes of the nodes that are alike to another:
small clusters go to one task; larger ones are dealt into blocks of at most ``MEMBERS``
nodes or ``BLOCK_BYTES`` of sets and every two blocks meet in a task, so memory is
bounded and no link is lost.  A task counts common elements with matrix products
and returns a spanning forest of its links.

A group of m nodes costs at most m^2 / 2 comparisons of bins, and a cluster of m
different texts m^2 / 2 entries of a matrix product; that is the price of losing no
link, and no task or shuffle holds that many rows.

Edge cases: texts without words (null, empty) have empty sets and link with
nothing.  A text of fewer than n words is one n-gram.  Very long texts are single
rows with a set of their own size.  A null id is no smallest
id of a component unless all its ids are null.  Repeated rows give repeated
rows.  An empty table gives an empty result.  Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.arrays import BASES, LOWER, U64, byte_values, chunks, joined, mix, sorted_groups, spans_hash, windows_hash, word_spans
from harrow.llm.clusters import EDGES, cluster_links, dealt, joining_edges
from harrow.llm.exchange import n_blocks, pack, unpack
from harrow.llm.graph import components
from harrow.llm.textops import doc_bytes, settle, written

MEMBERS, BLOCK_BYTES = 1024, 16 << 20
#: 64-bit words of the bins of a small set, and bins an element.
WORDS, BITS = 4, 2
#: Rows and bytes of sets that a task of many small groups is dealt.
TASK_ROWS, TASK_BYTES = 50_000, 16 << 20
_PART = U64(0xC2B2AE3D27D4EB4F)


@dataclass
class Sets:
    """Distinct n-gram hashes of all texts one after another, and where each text's begin and end."""

    element: np.ndarray
    at: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.at)


def sets_of(texts: list[bytes], n: int) -> Sets:
    data, at = joined(texts)
    data = LOWER[data]
    start, end = word_spans(data)
    words = spans_hash(byte_values(data), start, end)
    first = np.searchsorted(start, at)
    count = np.diff(first)
    h = windows_hash(words, n)
    row = np.repeat(np.arange(len(texts)), count)
    whole = row[: len(h)] == row[n - 1 :] if len(h) else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < n))
    h = np.r_[h[whole], spans_hash(words, first[short], first[short] + count[short], BASES[1])]
    row = np.r_[row[: len(whole)][whole], short]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return Sets(h[new], np.searchsorted(row[new], np.arange(len(texts) + 1)))


def _sum64(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 by index, from two exact sums of 32-bit halves."""
    low = np.bincount(index, (values & U64(0xFFFFFFFF)).astype(np.float64), n).astype(U64)
    high = np.bincount(index, (values >> U64(32)).astype(np.float64), n).astype(U64)
    return low + (high << U64(32))


def bands(percent: int, most: int) -> np.ndarray:
    """The largest size of each band, up to one that holds ``most``."""
    ratio = 1.25 if percent >= 85 else 1.5
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, int(ends[-1] * ratio)))
    return np.array(ends)


def pieces(percent: int) -> int:
    """Pieces of a part: more where a part holds few elements, so that what agrees is seldom empty."""
    return 2 if percent >= 85 else 3


def signatures(s: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the text of each."""
    size, fine_most = s.size, pieces(percent)
    ends = bands(percent, int(size.max(initial=1)) * 2)
    band = np.searchsorted(ends, size)
    full = np.flatnonzero(size)
    up = full[100 * size[full] >= percent * (ends[band[full]] + 1)]
    text, own = np.r_[full, up], np.r_[band[full], band[up] + 1]
    limit = 2 * ends[own] * (100 - percent) // (100 + percent)
    parts = np.where(limit == 0, 1, (limit + 2) // 2)
    fine = np.where(limit == 0, 1, fine_most)
    # One slot for each part and piece of each (text, band).
    slots = np.cumsum(parts * fine) - parts * fine
    n = size[text]
    of = np.repeat(np.arange(len(text)), n)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    e = s.element[s.at[text][of] + nth]
    deal = mix(e ^ _PART)
    slot = slots[of] + ((deal >> U64(8)) % parts[of].astype(U64)).astype(np.int64) * fine[of] + (deal % fine[of].astype(U64)).astype(np.int64)
    total = int((parts * fine).sum())
    piece = _sum64(slot, mix(e + U64(1)), total)
    who = np.repeat(np.arange(len(text)), parts * fine)
    inside = np.arange(total) - slots[who]
    part, left_out = inside // fine[who], inside % fine[who]
    single = fine[who] == 1
    first = slots[who] + part * fine[who]
    kept = sum((np.where((left_out != j) & ~single, piece[np.minimum(first + j, total - 1)], U64(0)) for j in range(fine_most)), np.zeros(total, U64))
    kept = np.where(single, piece, kept)
    label = (own[who].astype(U64) << U64(40)) + (part.astype(U64) << U64(4)) + left_out.astype(U64)
    return mix(kept + mix(label + U64(77))), text[who]


def set_hash(s: Sets) -> np.ndarray:
    row = np.repeat(np.arange(len(s.size)), s.size)
    return mix(_sum64(row, mix(s.element ^ U64(0xA5A5A5A5)), len(s.size)) + s.size.astype(U64)).view(np.int64)


def bins_of(s: Sets) -> list[bytes]:
    """For each class of hashes whether a set has an odd number of elements of it, a bit each."""
    size = s.size
    width = 64 * WORDS << np.ceil(np.log2(np.maximum(size * BITS / (64 * WORDS), 1))).astype(np.int64)
    at = np.r_[0, np.cumsum(width)]
    row = np.repeat(np.arange(len(size)), size)
    place = at[row] + (mix(s.element + U64(3)) & (width[row] - 1).astype(U64)).astype(np.int64)
    odd = np.packbits((np.bincount(place, minlength=int(at[-1])) & 1).astype(bool), bitorder="little").tobytes()
    return [odd[a:b] for a, b in zip((at[:-1] // 8).tolist(), (at[1:] // 8).tolist(), strict=True)]


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Bins in fewer classes; the class of a hash is its low bits."""
    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), 1) if rows.shape[1] > width else rows


@dataclass
class Bins:
    """Bins of some rows, those of one width (in words) together."""

    width: np.ndarray
    place: np.ndarray
    rows: dict[int, np.ndarray]

    @staticmethod
    def of(column: pa.Array | pa.ChunkedArray) -> Bins:
        held = column.to_pylist()
        width = np.array([len(x) // 8 for x in held], np.int64)
        place = np.zeros(len(held), np.int64)
        rows = {}
        for w in np.unique(width).tolist():
            mine = np.flatnonzero(width == w)
            place[mine] = np.arange(len(mine))
            rows[w] = np.frombuffer(b"".join([held[i] for i in mine]), U64).reshape(-1, w)
        return Bins(width, place, rows)

    def apart(self, mine: np.ndarray, other: Bins, its: np.ndarray) -> np.ndarray:
        """How much the bins of rows differ from those of other rows, one by one (``its`` may be a single row)."""
        its = np.broadcast_to(its, mine.shape)
        out = np.zeros(len(mine), np.int64)
        kinds = self.width[mine] * (1 << 32) + other.width[its]
        for k in np.unique(kinds).tolist():
            a, b = divmod(k, 1 << 32)
            some = np.flatnonzero(kinds == k)
            step = max(1, (1 << 20) // max(a, b))
            for c in range(0, len(some), step):
                part = some[c : c + step]
                x, y = (_folded(bins.rows[w][bins.place[at]], min(a, b)) for bins, w, at in ((self, a, mine[part]), (other, b, its[part])))
                out[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
        return out

    def of_group(self, rows: np.ndarray) -> np.ndarray:
        """The bins of some rows as a matrix, all in as few words as the coarsest has."""
        width = self.width[rows]
        least = int(width.min())
        out = np.empty((len(rows), least), U64)
        for w in np.unique(width).tolist():
            some = np.flatnonzero(width == w)
            out[some] = _folded(self.rows[w][self.place[rows[some]]], least)
        return out


def _described(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size, hash and bins of every text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                s = sets_of(texts, n)
                same = [batch.column(c).slice(first, len(texts)) for c in ("doc_id", "content")]
                yield pa.record_batch([*same, pa.array(s.size.astype(np.int64)), pa.array(set_hash(s)), pa.array(bins_of(s), pa.binary())], names=["doc_id", "content", "n_shingles", "node", "bins"])

    return run


def _signed(n: int, percent: int, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Signatures for their shards: five bytes each, by node; a chance meeting of five bytes only adds a comparison."""

    def told(signature: list[np.ndarray], node: list[np.ndarray]) -> pa.RecordBatch:
        sig, who = np.concatenate(signature), np.concatenate(node)
        shard = (sig % U64(shards)).astype(np.int64)
        order = np.lexsort((who, shard))
        rows = []
        for a, b in zip((g := sorted_groups(shard[order]))[:-1], g[1:], strict=True):
            pick = order[a:b]
            runs = sorted_groups(who[pick])
            high = (sig[pick] >> U64(24)).astype(U64)
            rows.append((int(shard[pick[0]]), pack((high >> U64(8)).astype(np.uint32), (high & U64(255)).astype(np.uint8), who[pick][runs[:-1]], np.diff(runs).astype(np.uint32))))
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["to", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signature, node, held = [], [], 0
        for batch in batches:
            for _, texts in chunks(batch, "text"):
                s = sets_of(texts, n)
                sig, of = signatures(s, percent)
                signature.append(sig)
                node.append(set_hash(s)[of])
                held += len(sig)
                if held > 1 << 21:
                    yield told(signature, node)
                    signature, node, held = [], [], 0
        if held:
            yield told(signature, node)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Groups of nodes that share a signature: each node with the first of them."""
    parts = [unpack(p.as_py()) for p in table.column("payload")]
    sig = np.concatenate([(p[0].astype(U64) << U64(8)) | p[1] for p in parts])
    node = np.concatenate([np.repeat(p[2], p[3]) for p in parts])
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    g = sorted_groups(sig)
    size = np.diff(g)
    # Groups of the same nodes say the same.
    key = mix(_sum64(np.repeat(np.arange(len(size)), size), mix(node.view(U64)), len(size)) + size.astype(U64))
    _, pick = np.unique(key, return_index=True)
    pick = np.sort(pick[size[pick] > 1])
    of = np.repeat(np.arange(len(pick)), size[pick])
    nth = np.arange(len(of)) - np.repeat(np.cumsum(size[pick]) - size[pick], size[pick])
    at = g[pick][of] + nth
    band = mix(sig[g[pick]] ^ U64(table.column("to")[0].as_py()) << U64(40)).view(np.int64)
    return pa.table({"band": band[of], "node": node[at], "first": node[at - nth]})


def _may_link(apart: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return ((100 + percent) * apart <= (100 - percent) * (a + b)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def _like(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose sizes and bins allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = np.arange(batch.num_rows)
            apart = Bins.of(batch.column("bins")).apart(each, Bins.of(batch.column("its")), each)
            ok = _may_link(apart, batch.column("size").to_numpy(), batch.column("of_size").to_numpy(), percent)
            yield batch.select(["node", "other"]).filter(pa.array(ok))

    return run


def _between(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        bins, size = Bins.of(table.column("bins")), table.column("size").to_numpy()

        def group(rows: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
            held, n = bins.of_group(rows), size[rows]
            # Unrelated sets differ by more than a link allows in the first words already, each of which lies in one run of memory.
            first = np.ascontiguousarray(held[:, : -(-3 * held.shape[1] // 8)].T)
            step = max(1, (1 << 18) // held.shape[1])

            def alike(some: np.ndarray, asked: np.ndarray) -> np.ndarray:
                apart = np.zeros(asked.shape, np.uint16 if len(first) < 1000 else np.int64)
                differ, count = np.empty(asked.shape, U64), np.empty(asked.shape, np.uint8)
                for w in first:
                    np.bitwise_xor(w[some][:, None], w, out=differ)
                    apart += np.bitwise_count(differ, out=count)
                x, y = np.nonzero((apart <= (100 - percent) * (n[some] + n.max())[:, None] // (100 + percent)) & asked)
                ok = np.zeros(asked.shape, bool)
                for c in range(0, len(x), step):
                    i, j = x[c : c + step], y[c : c + step]
                    whole = np.bitwise_count(held[some[i]] ^ held[j]).sum(1, dtype=np.int64)
                    ok[i, j] = _may_link(whole, n[some[i]], n[j], percent)
                return ok

            return alike

        return joining_edges(table, "band", group)

    return run


def _verify(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        held = table.column("set")
        return cluster_links(table, "component", lambda pick: [np.frombuffer(held[int(i)].as_buffer(), U64) for i in pick], percent)

    return run


def _sets(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            for first, texts in chunks(batch, "text"):
                s = sets_of(texts, n)
                own = set_hash(s)
                ok = np.flatnonzero(own == node[first : first + len(texts)])  # equal hashes of texts may hide another text
                yield pa.record_batch([pa.array(own[ok]), pa.array([s.element[s.at[i] : s.at[i + 1]].tobytes() for i in ok], pa.binary())], names=["node", "set"])

    return run


def _unjoined(met: DataFrame, found: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Edges between alike nodes of one group that are in different components, enough to join these."""
    rooted = met.select("band", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sized = rooted.groupBy("band").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    member = settle(rooted.join(sized.select("band", "blocks"), "band"))
    tasks = 1 + (member.agg(F.sum("blocks")).first()[0] or 0) // TASK_ROWS
    placed = dealt(member.join(known.select("node", "size", "bins"), "node"), "band").withColumn("task", F.pmod(F.xxhash64("band", "i", "j"), F.lit(tasks)))
    return placed.groupBy("task").applyInArrow(_between(percent), EDGES).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, node (the set's hash) and component_id (least id that links reach) of every row."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = own.withColumn("content", F.xxhash64("text")).mapInArrow(_described(n), "doc_id long, content long, n_shingles long, node long, bins binary")
    rows = written(described)
    shards = n_blocks(doc_bytes(docs, text))
    signed = own.select("text").mapInArrow(_signed(n, percent, shards), "to long, payload binary")
    met = written(signed.groupBy("to").applyInArrow(_meet, "band long, node long, first long"))
    sought = met.select("node").distinct()
    # One row a node: its size and bins, and one document that holds it.
    known = written(rows.groupBy("node").agg(F.max("n_shingles").alias("size"), F.max("bins").alias("bins"), F.min(F.struct("doc_id", "content")).alias("holder")).join(sought, "node", "left_semi"))
    its = known.select(F.col("node").alias("other"), F.col("size").alias("of_size"), F.col("bins").alias("its"))
    def like(pairs: DataFrame) -> DataFrame:
        both = pairs.join(known.select("node", "size", "bins"), "node").join(its, "other")
        return both.select("node", "other", "size", "of_size", "bins", "its").mapInArrow(_like(percent), "node long, other long")

    first = components(like(met.filter("node <> first").select("node", F.col("first").alias("other")).distinct()), "node", "other")
    more = _unjoined(met, first, known, percent)
    clusters = components(first.select("node", F.col("component").alias("other")).unionAll(more), "node", "other")
    own_set = settle(clusters.join(known.select("node", "size", "holder"), "node"))
    of_bytes = F.sum(8 * F.col("size"))
    sized = own_set.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(of_bytes / BLOCK_BYTES)).cast("int").alias("blocks"))
    member = own_set.join(sized, "component")
    tasks = 1 + (member.agg(F.sum(8 * F.col("size") * F.col("blocks"))).first()[0] or 0) // TASK_BYTES
    placed = dealt(member.select("component", "node", "blocks"), "component").withColumn("task", F.pmod(F.xxhash64("component", "i", "j"), F.lit(tasks)))
    holder = own_set.select("node", F.col("holder.doc_id").alias("held_id"), F.col("holder.content").alias("held"))
    met_text = own.join(holder, own["doc_id"].eqNullSafe(holder["held_id"]) & (F.xxhash64(own["text"]) == holder["held"]))
    sets = met_text.select("node", "text").dropDuplicates(["node"]).mapInArrow(_sets(n), "node long, set binary")
    links = placed.join(sets, "node").select("component", "i", "j", "second", "task", "node", "set").groupBy("task").applyInArrow(_verify(percent), EDGES)
    found = components(links, "node", "other")
    rooted = rows.drop("bins", "content").join(found.withColumnRenamed("component", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least_id"))
    out = rooted.join(least, "root")
    return out.select("doc_id", "n_shingles", "node", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"))
