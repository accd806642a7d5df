"""Exact repeated windows across documents: the machinery of substring and suffix-array dedup.

A text is a sequence of symbols (bytes, or words).  Two windows of ``k`` symbols
that are equal hold the same *trigger*, the leftmost of their ``gram``-symbol
strings with the least rolling hash, at the same place.  Runs of consecutive
windows with one trigger form a *phrase*: the text from the first window's start
to the last window's end.  Triggers depend on content alone, so equal text is cut
into equal phrases, and every window lies in one phrase.

The work goes through two exchanges and never holds more than a block of
documents or a shard of triggers in a task:

1. ``parse``: a block of documents lists its distinct phrases (trigger, phrase
   hash, first document) for the shard of the trigger.
2. ``resolve``: a shard answers for every phrase of every block whether it is
   the only one of its trigger (keep), exists whole in an earlier document
   (remove), or shares its trigger with other phrases (compare).
3. ``ship``: blocks mark what is decided and send only phrases to compare.
4. ``compare``: a shard finds equal windows among these phrases, and the first
   of each.
5. ``finish``: a block joins the answers and cuts its texts.

A trigger with very many different phrases (a passage in very many documents,
each with its own surroundings) is hot: a block lists at most ``PER_TRIGGER`` of
its phrases and a mark, and from ``resolve`` on its windows are sent one by one
to shards of their own hash instead, each block its distinct windows once.  So
no shard grows with the number of documents that hold one passage.

The documents are shuffled once, by block; the plan reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harrow.llm.arrays import BASES, U64, mix, sorted_groups, spans_hash, window_minimum, windows_hash
from harrow.llm.exchange import NULL_ID, SENT, block_rows, by_shard, in_blocks, n_blocks, pack, sent, slices, unpack
from harrow.llm.textops import doc_bytes

PER_TRIGGER = 16
MARK = U64(0xFFFFFFFFFFFFFFFF)
KEEP, REMOVE, COMPARE, SINGLY = 0, 1, 2, 3
_LESS = U64(24)


@dataclass(frozen=True)
class Kind:
    """What a symbol is and how windows of ``k`` of them compare.

    ``symbols``: texts -> (values to hash, symbols to ship, first symbol of each text, symbols of each text).
    ``classes``: shipped symbols and window starts -> a class number for each window.
    ``by_place``: whether an earlier place in the same document comes first too.
    ``wanted``: triggers -> which of them may repeat; the others' windows are left alone.
    """

    k: int
    gram: int
    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    classes: Callable[[np.ndarray, np.ndarray, int], np.ndarray]
    by_place: bool
    wanted: Callable[[np.ndarray], np.ndarray] | None = None


@dataclass
class Runs:
    """Phrases of a block in document order."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    trigger: np.ndarray
    phrase: np.ndarray


def _starts(at: np.ndarray, lengths: np.ndarray, k: int, n: int) -> np.ndarray:
    """Places of all windows that lie inside one text."""
    valid = np.zeros(n + 1, np.int32)
    long = lengths >= k
    np.add.at(valid, at[long], 1)
    np.add.at(valid, at[long] + lengths[long] - k + 1, -1)
    return np.flatnonzero(np.cumsum(valid)[:n])


def runs_of(values: np.ndarray, at: np.ndarray, lengths: np.ndarray, kind: Kind) -> Runs:
    grams = windows_hash(values, kind.gram)
    least = window_minimum(grams, kind.k - kind.gram + 1)
    place = _starts(at, lengths, kind.k, len(least))
    if not len(place):
        z = np.zeros(0, np.int64)
        return Runs(z, z, z, z.view(U64), z.view(U64))
    v = least[place]
    cut = np.ones(len(place), bool)
    cut[1:] = (np.diff(place) != 1) | (v[1:] != v[:-1]) | (grams[place[:-1]] == v[:-1])
    first = np.flatnonzero(cut)
    count = np.diff(np.r_[first, len(place)])
    start = place[first]
    trigger = mix(v[first])
    if kind.wanted:
        keep = kind.wanted(trigger)
        start, count, trigger = start[keep], count[keep], trigger[keep]
    row = np.searchsorted(at, start, "right") - 1
    phrase = spans_hash(values, start, start + count + kind.k - 1, BASES[1])
    return Runs(row, start - at[row], count, trigger, phrase)


def _block_runs(ids: np.ndarray, texts: list[bytes], kind: Kind, seen: Callable[[Runs, np.ndarray, np.ndarray, np.ndarray], None] | None = None) -> Runs:
    parts = []
    for a, b in slices(texts):
        values, shipped, at, lengths = kind.symbols(texts[a:b])
        r = runs_of(values, at, lengths, kind)
        if seen:
            seen(r, values, shipped, at)
        r.row = r.row + a
        parts.append(r)
    parts = parts or [runs_of(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), kind)]
    return Runs(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("row", "start", "count", "trigger", "phrase")])


@dataclass
class Entries:
    """Distinct (trigger, phrase) of a block, sorted; ``of``: the entry of each run; ``owner``: its first run."""

    trigger: np.ndarray
    phrase: np.ndarray
    owner: np.ndarray
    of: np.ndarray


def entries_of(r: Runs) -> Entries:
    order = np.lexsort((r.phrase, r.trigger))  # stable: runs stay in document order
    t, p = r.trigger[order], r.phrase[order]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return Entries(t[new], p[new], order[new], of)


def listed(e: Entries, ids: np.ndarray, r: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a block tells of its entries: trigger, phrase, first document; and the entry's index, -1 for a mark."""
    bounds = sorted_groups(e.trigger)
    nth = np.arange(len(e.trigger)) - np.repeat(bounds[:-1], np.diff(bounds))
    told = np.flatnonzero(nth < PER_TRIGGER)
    over = bounds[:-1][np.diff(bounds) > PER_TRIGGER]
    trigger = np.r_[e.trigger[told], e.trigger[over]]
    phrase = np.r_[e.phrase[told], np.full(len(over), MARK, U64)]
    doc = np.r_[ids[r.row[e.owner[told]]], np.full(len(over), NULL_ID)]
    return trigger, phrase, doc, np.r_[told, np.full(len(over), -1, np.int64)]


def _parse(kind: Kind, shards: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        ids, texts, _ = block_rows(table)
        r = _block_runs(ids, texts, kind)
        trigger, phrase, doc, _ = listed(entries_of(r), ids, r)
        block = table.column("block")[0].as_py()
        return sent([(shard, block, pack((trigger[pick] >> _LESS).astype(U64), phrase[pick], doc[pick])) for shard, pick in by_shard(trigger, shards)])

    return run


def _resolve(table: pa.Table) -> pa.Table:
    """One code for every told phrase, in the order told."""
    parts = [unpack(p.as_py()) for p in table.column("payload")]
    size = [len(p[0]) for p in parts]
    trigger, phrase, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((doc, phrase, trigger))
    t, p, d = trigger[order], phrase[order], doc[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = t[1:] != t[:-1]
    distinct = fresh.copy()
    distinct[1:] |= p[1:] != p[:-1]
    of_phrase, of_trigger = np.cumsum(distinct) - 1, np.cumsum(fresh) - 1
    kinds = np.bincount(of_trigger, weights=distinct)
    hot = np.zeros(len(kinds), bool)
    hot[of_trigger[p == MARK]] = True
    hot |= kinds > 4096
    code = np.where(d > d[distinct][of_phrase], REMOVE, np.where(kinds[of_trigger] > 1, COMPARE, KEEP))
    code = np.where(hot[of_trigger], SINGLY, code).astype(np.uint8)
    back = np.empty_like(code)
    back[order] = code
    shard, cuts = table.column("to")[0].as_py(), np.r_[0, np.cumsum(size)]
    return sent([(s.as_py(), shard, pack(back[a:b])) for s, a, b in zip(table.column("source"), cuts[:-1], cuts[1:], strict=True)])


def _ship(kind: Kind, shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return sent([])
        ids, texts, _ = block_rows(table)
        block = table.column("block")[0].as_py()
        windows: list[np.ndarray] = []

        def keep_windows(r: Runs, values: np.ndarray, shipped: np.ndarray, at: np.ndarray) -> None:
            windows.append(windows_hash(values, kind.k))
            held.append((shipped, at))

        held: list[tuple[np.ndarray, np.ndarray]] = []
        r = _block_runs(ids, texts, kind, keep_windows)
        e = entries_of(r)
        trigger, _, _, index = listed(e, ids, r)
        told = {s: unpack(p)[0] for s, p in zip(answers.column("source").to_pylist(), answers.column("payload").to_pylist(), strict=True)}
        code = np.zeros(len(trigger), np.uint8)
        for shard, pick in by_shard(trigger, shards):
            code[pick] = told[shard]
        by_entry = np.full(len(e.trigger), KEEP, np.uint8)
        by_entry[index[index >= 0]] = code[index >= 0]
        if (code == SINGLY).any():
            by_entry[np.isin(e.trigger, np.unique(trigger[code == SINGLY]))] = SINGLY
        of_run = by_entry[e.of]
        doc = ids[r.row]
        first = e.owner[e.of]
        later = (np.arange(len(of_run)) != first) if kind.by_place else (doc > doc[first])
        gone = (of_run == REMOVE) | (later & (of_run != SINGLY))
        sure = np.flatnonzero(gone)
        cuts = list(slices(texts))
        offsets = np.array([a for a, _ in cuts] or [0])

        def symbols(row: int, start: int, n: int) -> np.ndarray:
            i = int(np.searchsorted(offsets, row, "right")) - 1
            shipped, at = held[i]
            x = at[row - offsets[i]] + start
            return shipped[x : x + n]

        def hashes(row: int, start: int, n: int) -> np.ndarray:
            i = int(np.searchsorted(offsets, row, "right")) - 1
            x = held[i][1][row - offsets[i]] + start
            return windows[i][x : x + n]

        # Phrases to compare: the owner's text once, its answer for all runs of it that are not gone.
        waiting = np.flatnonzero((of_run == COMPARE) & ~gone)
        asked = np.unique(e.of[waiting])
        number = np.full(len(e.trigger), -1, np.int64)
        number[asked] = np.arange(len(asked))
        owner = e.owner[asked]
        to = [(e.trigger[asked] % U64(shards)).astype(np.int64)]
        pieces = [symbols(r.row[o], r.start[o], r.count[o] + kind.k - 1) for o in owner]
        lens, docs, places, numbers = [r.count[owner] + kind.k - 1], [doc[owner]], [r.start[owner]], [np.arange(len(asked))]
        wait = [(number[e.of[waiting]], r.row[waiting], r.start[waiting], r.count[waiting])]
        # Hot triggers: each distinct window by itself.
        single = np.flatnonzero(of_run == SINGLY)
        if len(single):
            h = np.concatenate([hashes(r.row[i], r.start[i], r.count[i]) for i in single])
            row = np.repeat(r.row[single], r.count[single])
            nth = np.arange(len(h)) - np.repeat(np.cumsum(r.count[single]) - r.count[single], r.count[single])
            start = np.repeat(r.start[single], r.count[single]) + nth
            by = np.argsort(h, kind="stable")
            new = np.ones(len(by), bool)
            new[1:] = h[by][1:] != h[by][:-1]
            of = np.empty(len(by), np.int64)
            of[by] = np.cumsum(new) - 1
            lead = by[new]
            late = (np.arange(len(by)) != lead[of]) if kind.by_place else (ids[row] > ids[row[lead[of]]])
            dropped = np.flatnonzero(late)
            more = (row[dropped], start[dropped], np.ones(len(dropped), np.int64))
            to.append((mix(h[lead]) % U64(shards)).astype(np.int64))
            pieces += [symbols(row[i], start[i], kind.k) for i in lead]
            lens.append(np.full(len(lead), kind.k))
            docs.append(ids[row[lead]])
            places.append(start[lead])
            numbers.append(np.arange(len(lead)) + len(asked))
            left = np.flatnonzero(~late)
            wait.append((of[left] + len(asked), row[left], start[left], np.ones(len(left), np.int64)))
        else:
            z = np.zeros(0, np.int64)
            more = (z, z, z)
        sure_cols = [np.r_[x[sure], y] for x, y in zip((r.row, r.start, r.count), more, strict=True)]
        wait_cols = [np.concatenate([w[i] for w in wait]) for i in range(4)]
        out = [(-1 - block, block, pack(*[x.astype(np.int32) for x in sure_cols], *[x.astype(np.int32) for x in wait_cols]))]
        goes, lens, docs, places, numbers = (np.concatenate(x).astype(np.int64) for x in (to, lens, docs, places, numbers))
        by = np.argsort(goes, kind="stable")
        for a, b in zip((g := sorted_groups(goes[by]))[:-1], g[1:], strict=True):
            if b > a:
                pick = by[a:b]
                text = np.concatenate([pieces[i] for i in pick])
                out.append((int(goes[pick[0]]), block, pack(lens[pick].astype(np.int32), docs[pick], places[pick].astype(np.int32), numbers[pick].astype(np.int32), text)))
        return sent(out)

    return run


def _compare(kind: Kind) -> Callable[[pa.Table], pa.Table]:
    """Bits for the windows of every shipped phrase: 1 where the window comes earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        to, source, payload = table.column("to").to_pylist(), table.column("source").to_pylist(), table.column("payload").to_pylist()
        if to[0] < 0:  # what a block tells itself goes through
            return sent([(s, t, p) for t, s, p in zip(to, source, payload, strict=True)])
        parts = [unpack(p) for p in payload]
        lens, docs, places, numbers = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(4))
        text = np.concatenate([p[4] for p in parts])
        count = lens - kind.k + 1
        begin = np.cumsum(lens) - lens
        total = int(count.sum())
        of = np.repeat(np.arange(len(count)), count)
        nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        cls = kind.classes(text, begin[of] + nth, kind.k)
        key, place = docs[of], places[of] + nth if kind.by_place else np.zeros(total, np.int64)
        order = np.lexsort((place, key, cls))
        g = sorted_groups(cls[order])
        lead = np.repeat(order[g[:-1]], np.diff(g))
        late = np.zeros(total, bool)
        late[order] = (key[order] > key[lead]) | (place[order] > place[lead])
        out, a, at = [], 0, 0
        for s, p in zip(source, parts, strict=True):
            n = len(p[0])
            w = int(count[a : a + n].sum())
            out.append((s, to[0], pack(numbers[a : a + n].astype(np.int32), count[a : a + n].astype(np.int32), np.packbits(late[at : at + w]))))
            a, at = a + n, at + w
        return sent(out)

    return run


def cuts_of(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window and number of windows of everything to remove in a block."""
    sure, wait = [], None
    bits: dict[int, np.ndarray] = {}
    for t, p in zip(answers.column("source").to_pylist(), answers.column("payload").to_pylist(), strict=True):
        got = unpack(p)
        if t < 0:
            sure.append(got[:3])
            wait = got[3:]
        else:
            numbers, count, packed = got
            late = np.unpackbits(packed, count=int(count.sum())).astype(bool)
            for n, x in zip(numbers.tolist(), np.split(late, np.cumsum(count)[:-1]), strict=True):
                if x.any():
                    bits[n] = x
    rows, starts, counts = ([x] for x in sure[0]) if sure else ([], [], [])
    if wait is not None and bits:
        for n, row, start in zip(*(x.tolist() for x in wait[:3]), strict=True):
            if (x := bits.get(n)) is not None:
                edge = np.diff(np.r_[0, x.view(np.int8), 0])
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                rows.append(np.full(len(a), row))
                starts.append(start + a)
                counts.append(b - a)
    z = np.zeros(0, np.int64)
    return tuple(np.concatenate(x).astype(np.int64) if x else z for x in (rows, starts, counts))


def spans_to_cut(answers: pa.Table, k: int) -> dict[int, list[tuple[int, int]]]:
    """For each row with something to remove, its maximal covered runs of symbols."""
    row, start, count = cuts_of(answers)
    order = np.lexsort((start, row))
    found: dict[int, list[tuple[int, int]]] = {}
    for r, a, n in zip(row[order].tolist(), start[order].tolist(), count[order].tolist(), strict=True):
        b = a + n + k - 1
        have = found.setdefault(r, [])
        if have and a <= have[-1][1]:
            have[-1] = (have[-1][0], max(have[-1][1], b))
        else:
            have.append((a, b))
    return found


def cut_repeats(
    docs: DataFrame,
    kind: Kind,
    finish: Callable[[bytes, list[tuple[int, int]]], tuple],
    columns: list[tuple[str, pa.DataType, str]],
    text: str = "text",
    doc_id: str = "doc_id",
    block_bytes: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """doc_id and ``columns`` made by ``finish(text, spans to cut)`` for every document.

    A block holds ``block_bytes`` of text: by default a four-thousandth of all,
    but 2 MB at least and 64 MB at most.
    """
    blocks = n_blocks(doc_bytes(docs, text) if total is None else total, block_bytes)
    # Places of one document are compared inside its block; documents are compared by id wherever they are.
    own = in_blocks(docs, blocks, text, doc_id, together=kind.by_place)
    told = own.groupBy("block").applyInArrow(_parse(kind, blocks), SENT)
    answers = told.groupBy("to").applyInArrow(_resolve, SENT)
    shipped = own.groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(_ship(kind, blocks), SENT)
    compared = shipped.groupBy("to").applyInArrow(_compare(kind), SENT)
    schema = pa.schema([("doc_id", pa.int64()), *[(n, t) for n, t, _ in columns]])

    def last(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        ids, texts, _ = block_rows(table)
        spans = spans_to_cut(replies, kind.k)
        made = [finish(t, spans.get(i, [])) for i, t in enumerate(texts)]
        shown = [None if i == NULL_ID else i for i in ids.tolist()]
        return pa.table([pa.array(c, f.type) for c, f in zip([shown, *zip(*made)], schema, strict=True)], schema=schema)

    return own.groupBy("block").cogroup(compared.groupBy("to")).applyInArrow(last, "doc_id long, " + ", ".join(f"{n} {s}" for n, _, s in columns))
