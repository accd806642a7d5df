"""Clusters of candidates without all-pairs rows: edges that join components, and exact links inside clusters.

A key (a band, a cluster) has a group of nodes; large groups are dealt into blocks and
every two blocks meet in a task.  Tasks take many small groups.  Comparisons happen
inside a task; it emits no more edges than it has components to join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = "node long, other long"
#: Pairs of a group that are compared at once: few enough for a processor's cache.
PAIRS = 1 << 15
#: Sets that are compared pair by pair.
FEW = 4
#: An element of more than one in so many sets is one of many.
OFTEN = 16


def dealt(member: DataFrame, key: str) -> DataFrame:
    """Rows of (key, node, blocks) for every two blocks, i and j, that meet; ``second`` where the row is of block j and not i."""
    placed = member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(key, F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), (F.col("block") > F.col("o")).cast("int").alias("second"), *[c for c in member.columns if c not in (key, "blocks")])


def groups(table: pa.Table, key: str) -> tuple[np.ndarray, Iterator[tuple[int, int]]]:
    """The rows in order of group and block, and where each group, or pair of blocks, begins and ends."""
    columns = [table.column(c).to_numpy() for c in ("second", "j", "i", key)]
    order = np.lexsort(columns)
    new = np.any([k[order][1:] != k[order][:-1] for k in columns[1:]], axis=0)
    cuts = np.r_[0, np.flatnonzero(new) + 1, len(order)] if len(order) else np.zeros(1, np.int64)
    return order, zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _edges(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"node": pa.array([a for a, _ in found], pa.int64()), "other": pa.array([b for _, b in found], pa.int64())})


def joining_edges(table: pa.Table, key: str, group: Callable[[np.ndarray], Callable[[np.ndarray, np.ndarray], np.ndarray]]) -> pa.Table:
    """Edges that join the components of a group, or of two blocks of one, that alike nodes connect.

    ``group(rows)`` gives a function that tells which of the pairs asked for, a matrix of some of these rows, by their places, and all of them, are alike.
    """
    order, cuts = groups(table, key)
    node, second = (table.column(c).to_numpy()[order] for c in ("node", "second"))
    _, component = np.unique(table.column("component").to_numpy()[order], return_inverse=True)
    root = np.arange(len(order))  # of each component, over all groups of the task
    found: list[tuple[int, int]] = []
    for lo, hi in cuts:
        mine = component[lo:hi]
        label, at = np.unique(root[mine], return_inverse=True)
        if len(label) < 2:
            continue
        # Nodes of the most common component need no comparison with one another.
        few = np.flatnonzero(at != np.bincount(at).argmax())
        alike = group(order[lo:hi])
        blocks = bool(second[hi - 1])
        step = max(1, PAIRS // (hi - lo))
        for c in range(0, len(few), step):
            some = few[c : c + step]
            asked = at[some][:, None] != at
            if blocks:
                asked &= second[lo:hi][some][:, None] != second[lo:hi]
            ok = alike(some, asked)
            for i in np.flatnonzero(ok.any(1)).tolist():
                x, y = some[i], np.flatnonzero(ok[i])
                y = y[root[mine[y]] != root[mine[x]]]  # what edges of this task joined is one
                if len(y):
                    _, one = np.unique(root[mine[y]], return_index=True)
                    found += [(int(node[lo + x]), int(node[lo + o])) for o in y[one]]
                    root[np.isin(root, root[mine[y]])] = root[mine[x]]
    return _edges(found)


def _trees(linked: Callable[[int], np.ndarray], reached: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """Edges of trees over what is not reached yet; ``linked(x)`` tells what x links with."""
    out = []
    for root in range(len(nodes)):
        if reached[root]:
            continue
        reached[root], front = True, [root]
        while front:
            x = front.pop()
            for y in np.flatnonzero(linked(x) & ~reached).tolist():
                reached[y] = True
                front.append(y)
                out.append((int(nodes[x]), int(nodes[y])))
    return out


def _few(sets: list[np.ndarray], nodes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """``forest`` of a handful of sets, pair by pair."""
    m = len(sets)
    linked = np.zeros((m, m), bool)
    for a in range(m):
        for b in range(a):
            x, y = len(sets[a]), len(sets[b])
            if 100 * min(x, y) >= percent * max(x, y):
                both = np.sort(np.concatenate([sets[a], sets[b]]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                linked[a, b] = linked[b, a] = 100 * common >= percent * (x + y - common)
    return _trees(lambda x: linked[x], np.zeros(m, bool), nodes)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each begin to its end."""
    n = end - begin
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


def _common(row: np.ndarray, column: np.ndarray, at: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many elements each of the ``others`` shares with each row; the elements (columns) of a row x are those from at[x] on.

    Elements of many rows are counted by matrix products.  Those of few, nearly all where
    unrelated sets meet, are counted by the lists of their rows.
    """
    m = len(at) - 1
    count = np.bincount(column)
    often = count * OFTEN > m
    common = np.zeros((len(others), m), np.float32)
    place = np.cumsum(often) - 1
    total, width = int(often.sum()), max(1, (4 << 20) // m)
    mine = often[column]
    many_row, many = row[mine], place[column[mine]]
    order = np.argsort(many, kind="stable")
    many_row, many = many_row[order], many[order]
    for a in range(0, total, width):
        lo, hi = np.searchsorted(many, (a, a + width))
        dense = np.zeros((m, min(width, total - a)), np.float32)
        dense[many_row[lo:hi], many[lo:hi] - a] = 1
        common += dense[others] @ dense.T
    if total < len(often):
        holder = row[np.argsort(column, kind="stable")]
        begin = np.r_[0, np.cumsum(count)]
        for i, x in enumerate(others.tolist()):
            few = column[at[x] : at[x + 1]]
            few = few[~often[few]]
            common[i] += np.bincount(holder[_ranges(begin[few], begin[few + 1])], minlength=m)
    return common


def forest(sets: list[np.ndarray], nodes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what exact similarities connect among these sets (of distinct elements)."""
    m = len(sets)
    if m <= FEW:
        return _few(sets, nodes, percent)
    size = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(m), size)
    element, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(element)) > 1
    renumber = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], renumber[column[keep]]
    # What is similar to one set is joined by that and need not be compared with one another.
    held, out, missed = np.full(m, -1), [], 0
    at = np.searchsorted(row, np.arange(m + 1))
    for pivot in range(m):
        left = held < 0
        if not left[pivot]:
            continue
        mark = np.zeros(int(shared.sum()), bool)
        mark[column[at[pivot] : at[pivot + 1]]] = True
        common = np.bincount(row[mark[column]], minlength=m)
        mine = np.flatnonzero(left & (100 * common >= percent * (size + size[pivot] - common)))
        held[pivot] = pivot
        held[mine] = pivot
        out += [(int(nodes[pivot]), int(nodes[y])) for y in mine.tolist() if y != pivot]
        missed += len(mine) < max(2, m // 16)
        if missed == 8:
            break
    held = np.where(held < 0, np.arange(m), held)
    # All others against all: those outside the most common group.
    label, group = np.unique(held, return_inverse=True)
    others = np.flatnonzero(group != np.bincount(group).argmax())
    if not len(others):
        return out
    place = np.full(m, -1)
    place[others] = np.arange(len(others))
    both = _common(row, column, at, others).astype(np.int64)
    linked = 100 * both >= percent * (size[others][:, None] + size[None, :] - both)
    x, y = np.nonzero(linked & (group[others][:, None] != group[None, :]))
    pair, one = np.unique(group[others[x]] * len(label) + group[y], return_index=True)
    link = {divmod(k, len(label)): (int(nodes[others[x[i]]]), int(nodes[y[i]])) for k, i in zip(pair.tolist(), one.tolist(), strict=True)}
    between = np.zeros((len(label), len(label)), bool)
    between[pair // len(label), pair % len(label)] = True
    between |= between.T
    joined = _trees(lambda g: between[g], np.zeros(len(label), bool), np.arange(len(label)))
    return out + [link.get((a, b)) or link[(b, a)] for a, b in joined]


def cluster_links(table: pa.Table, key: str, sets: Callable[[np.ndarray], list[np.ndarray]], percent: int) -> pa.Table:
    """Links, enough to connect what is similar, of all clusters or pairs of blocks of a task; ``sets`` gives the sets of some rows."""
    order, cuts = groups(table, key)
    node = table.column("node").to_numpy()
    found = []
    for lo, hi in cuts:
        pick = order[lo:hi]
        if len(pick) > 1:
            found += forest(sets(pick), node[pick], percent)
    return _edges(found)
