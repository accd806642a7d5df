"""Corpus operators against brute force, and on edge cases."""

import itertools
import math
import random
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harrow.llm import (
    arrays,
    clusters,
    decontamination,
    graph,
    license_scan,
    license_texts,
    line_dedup,
    lm_scoring,
    ngram_join,
    packing,
    prefix_free,
    quality_model,
    quality_rules,
    registry,
    substring_dedup,
    suffix_dedup,
)

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def lower(t):
    return t.translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def rows():
    """Prose with copies, near copies, shared passages, nulls, empties, long words and repeated ids."""
    rng = random.Random(4)
    syllables = "an the er ing on re th ou ti st en at ed nd ha wh".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    prose = lambda n: re.sub(r"(\S+ ){12}", lambda m: m[0].rstrip() + ".\n", " ".join(word() for _ in range(n)))
    docs = [prose(rng.randint(1, 220)) for _ in range(70)]
    passage = prose(60)
    out = list(enumerate(docs))
    out += [(100 + i, docs[i]) for i in range(8)]
    for i in range(40):
        words = docs[9].split(" ") if len(docs[9]) > 300 else prose(150).split(" ")
        words[rng.randrange(len(words))] = f"zz{i}"
        out.append((200 + i, " ".join(words)))
    out += [(300 + i, f"{prose(rng.randint(0, 9))} {passage} {prose(rng.randint(0, 9))}") for i in range(40)]
    out += [(None, docs[2]), (None, None), (400, None), (401, ""), (402, "  \n\t"), (403, "a" * 400), (404, "x y " * 80), (405, "é" * 70), (406, "é" * 40 + "z" + "é" * 40), (407, docs[3]), (407, docs[3]), (407, docs[4]), (408, "THE the " * 40)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(i):
    return -(1 << 63) if i is None else i


def ordered(values):
    return sorted(values, key=str)


@pytest.mark.parametrize("block", [8000, None])
def test_suffix_dedup(docs, rows, block):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for x in range(len(b) - 49):
            first[b[x : x + 50]] = min(first.get(b[x : x + 50], key(i)), key(i))
    expected = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for x in range(len(b) - 49):
            if first[b[x : x + 50]] < key(i):
                gone[x : x + 50] = b"\1" * 50
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        expected.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    got = suffix_dedup.suffix_dedup(docs, block_bytes=block).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == ordered(expected)
    assert sum(e[2] for e in expected)


def test_prefix_free_parsing_gives_the_suffix_order(monkeypatch):
    rng = random.Random(13)
    for trial in range(60):
        monkeypatch.setattr(prefix_free, "MODULUS", rng.choice([2, 5, 20, 1 << 40]))
        alphabet = rng.choice([b"ab", b"abcdefgh", bytes(range(256))])
        pool = [bytes(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(5)]
        texts = [b"".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 9))]
        data, at = arrays.joined(texts)
        part, offset = prefix_free.corpus_order(data, at[:-1], np.diff(at) - 1)
        plain = sorted((t[o:], i, o) for i, t in enumerate(texts) for o in range(len(t)))
        assert [(i, o) for _, i, o in plain] == list(zip(part.tolist(), offset.tolist(), strict=True)), trial
        p = prefix_free.parsed(data, at[:-1], np.diff(at) - 1)
        words = {bytes(p.dictionary[a:b].astype(np.uint16)) for a, b in zip(p.phrase_at, np.r_[p.phrase_at[1:], len(p.dictionary)], strict=True)}
        assert len(words) == len(p.phrase_at)  # the phrases are distinct


def test_equal_hashes_of_phrases_are_told_apart(monkeypatch):
    monkeypatch.setattr(prefix_free, "spans_hash", lambda values, start, end: np.zeros(len(start), np.uint64))
    texts = [b"abcabcabdabc" * 9, b"abdabcabc" * 9, b"abcabcabdabc" * 4]
    data, at = arrays.joined(texts)
    part, offset = prefix_free.corpus_order(data, at[:-1], np.diff(at) - 1)
    plain = sorted((t[o:], i, o) for i, t in enumerate(texts) for o in range(len(t)))
    assert [(i, o) for _, i, o in plain] == list(zip(part.tolist(), offset.tolist(), strict=True))


@pytest.mark.parametrize("block", [8000, None])
def test_substring_dedup(docs, rows, block):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for x in range(len(w) - 19):
            q = tuple(w[x : x + 20])
            first[q] = min(first.get(q, (key(i), x)), (key(i), x))
    expected = []
    for i, w in words:
        gone = [0] * len(w)
        for x in range(len(w) - 19):
            if first[tuple(w[x : x + 20])] < (key(i), x):
                gone[x : x + 20] = [1] * 20
        expected.append((i, len(w), sum(gone), b" ".join(c for c, g in zip(w, gone, strict=True) if not g)))
    got = substring_dedup.substring_dedup(docs, block_bytes=block, width=1 << 21).collect()
    assert ordered((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == ordered(expected)


def test_a_full_sketch_changes_nothing(docs):
    small = substring_dedup.substring_dedup(docs, width=64).select("doc_id", "n_removed").collect()
    large = substring_dedup.substring_dedup(docs).select("doc_id", "n_removed").collect()
    assert ordered(map(tuple, small)) == ordered(map(tuple, large))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, rows, n, percent, monkeypatch):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    expected = ordered((i, len(sets[a]), least.get(find(a)) if sets[a] else i) for a, (i, _) in enumerate(rows))
    monkeypatch.setattr(ngram_join, "MEMBERS", 16)  # the larger clusters are dealt into blocks
    got = ngram_join.jaccard_components(docs, n, percent).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


def test_bins_differ_by_no_more_than_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(10 ** rng.uniform(0, 4))
        both = rng.integers(0, 1 << 63, n + int(rng.integers(0, n + 2)), np.uint64)
        sets = [np.unique(both[: n]), np.unique(both[int(rng.integers(0, n)) :])]
        joined = ngram_join.Sets(np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])])
        bins = ngram_join.Bins.of(pa.array(ngram_join.bins_of(joined), pa.binary()))
        apart = bins.apart(np.array([0, 1]), bins, np.asarray(1))
        assert apart[0] <= len(np.setxor1d(*sets)) and apart[1] == 0
    # unrelated sets of any size are told apart
    for n in (40, 1_000, 20_000, 100_000):
        element = rng.integers(0, 1 << 63, 2 * n, np.uint64)
        bins = ngram_join.Bins.of(pa.array(ngram_join.bins_of(ngram_join.Sets(element, np.array([0, n, 2 * n]))), pa.binary()))
        assert not ngram_join._may_link(bins.apart(np.array([0]), bins, np.array([1])), np.array([n]), np.array([n]), 80)[0]


@pytest.mark.parametrize("blocks", [False, True])
def test_rows_of_a_band_are_compared_at_once(blocks, monkeypatch):
    """All that bins leave open is joined, and a band of unrelated sets takes a few comparisons of many rows, not one a row."""
    rng = np.random.default_rng(9)
    base = [rng.integers(0, 1 << 63, int(rng.integers(100, 180)), np.uint64) for _ in range(300)]
    sets = [np.unique(np.r_[b[: len(b) - k], rng.integers(0, 1 << 63, k, np.uint64)]) for b in base for k in ((0,) if len(b) % 5 else (0, 2, 4))]
    bins = ngram_join.bins_of(ngram_join.Sets(np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])]))
    n = len(sets)
    second = np.arange(n) % 2 if blocks else np.zeros(n, np.int64)
    table = pa.table({"band": np.zeros(n, np.int64), "i": np.zeros(n, np.int64), "j": np.full(n, int(blocks)), "second": second, "node": np.arange(n), "component": np.arange(n), "size": [len(x) for x in sets], "bins": pa.array(bins, pa.binary())})
    asked = []
    alike = ngram_join._may_link
    monkeypatch.setattr(ngram_join, "_may_link", lambda *a: asked.append(1) or alike(*a))
    got = ngram_join._between(80)(table)
    assert len(asked) < n / 4
    root = list(range(n))

    def find(x, root):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(got.column("node").to_pylist(), got.column("other").to_pylist(), strict=True):
        assert find(a, root) != find(b, root) and second[a] != second[b] or not blocks
        root[find(a, root)] = find(b, root)
    for a, b in itertools.combinations(range(n), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and (not blocks or second[a] != second[b]):
            assert find(a, root) == find(b, root)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert not graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").collect()


def line_set(line):
    """All nine-character strings of a line, gaps as one space; a shorter line is one."""
    even = re.sub("[\x20\x09-\x0d]+", " ", line)
    return {even[k : k + 9] for k in range(max(1, len(even) - 8))}


def line_brute(rows, percent=80):
    seen = [(i, k, b) for i, t in rows for k, x in enumerate((t or "").split("\n")) if (b := x.strip(BLANKS).lower())]
    nodes = sorted({s[2] for s in seen})
    sets, parent = [line_set(x) for x in nodes], list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(nodes)), 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    group = {x: find(k) for k, x in enumerate(nodes)}
    first = {}
    for i, k, b in seen:
        first[group[b]] = min(first.get(group[b], (key(i), k)), (key(i), k))
    out = []
    for i, t in rows:
        x = (t or "").split("\n")
        kept = [y for k, y in enumerate(x) if not (b := y.strip(BLANKS).lower()) or first[group[b]] == (key(i), k)]
        out.append((i, len(x), len(x) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark, docs, rows):
    got = ordered(map(tuple, line_dedup.line_dedup(docs).collect()))
    expected = ordered(line_brute(rows))
    assert sum(g == e for g, e in zip(got, expected, strict=True)) >= 0.98 * len(rows)  # MinHash recall
    assert sum(g[2] for g in got) >= 0.98 * sum(e[2] for e in expected)
    clash = spark.createDataFrame([(1, "a b\nc", "p", 3), (2, "A B\nd", "q", 4)], "doc_id long, text string, node string, place int")
    assert ordered(map(tuple, line_dedup.dedup_lines(clash).collect())) == [(1, "a b\nc", "p", 3), (2, "d", "q", 4)]


def phrase_lines():
    """Pairs of near copies that all have most of a line in common with dissimilar lines."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7)))
    phrase, out = " ".join(word() for _ in range(24)), []
    for _ in range(300):
        tail = [word() for _ in range(10)]
        out += [f"{phrase} {' '.join(tail)}", f"{phrase} {' '.join(tail[:8])} {word()} {word()}"]
    return out


def bands_of(spark, texts):
    """Sketch and band keys of every line, by its place."""
    rows = spark.createDataFrame(list(enumerate(texts)), "place long, line string")
    bands = line_dedup.banded(line_dedup.signed(rows.select("line", F.xxhash64("line").alias("node"))))
    found = bands.groupBy("node").agg(F.first("sketch").alias("sketch"), F.collect_set("band").alias("bands")).join(rows.select("place", F.xxhash64("line").alias("node")), "node")
    return {r.place: (r.node, r.sketch, set(r.bands)) for r in found.collect()}


def alike(a, b):
    x = (a ^ b) & (1 << 60) - 1
    return ((x | x >> 1) & 0x555555555555555).bit_count() <= line_dedup.APART


def test_lines_that_share_a_band_all_meet(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MEMBERS", 64)  # the larger bands are dealt into blocks
    texts = phrase_lines()
    known = bands_of(spark, texts)
    sets = [line_set(x) for x in texts]
    parent, similar, missed = list(range(len(texts))), 0, 0

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(parent[:], 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            similar += 1
            if known[a][2] & known[b][2] and alike(known[a][1], known[b][1]):
                parent[find(a)] = find(b)
            else:
                missed += 1
    assert similar >= 300 and missed <= 0.01 * similar
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.node: r.component for r in line_dedup.similar_lines(docs)[0].collect()}
    roots = {a: got.get(known[a][0], known[a][0]) for a in known}
    same = lambda of: {frozenset(n for n in known if of(n) == c) for c in {of(n) for n in known}}
    assert same(roots.get) == same(find)


def test_comparisons_do_not_grow_with_the_square_of_a_chain(spark, monkeypatch):
    """Lines that each overlap the next one, so that bands are small and one cluster holds them all."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(700)]
    texts = [" ".join(words[k : k + 60]) for k in range(0, 640, 4)]
    compared, dealt = [], line_dedup.dealt

    def counted(member, key):
        placed = dealt(member, key)
        if "line" in member.columns:
            compared.append(placed.groupBy(key, "i", "j").count().select(F.sum(F.col("count") * F.col("count"))).first()[0])
        return placed

    monkeypatch.setattr(line_dedup, "dealt", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    whole = {r.node: r.component for r in line_dedup.similar_lines(docs)[0].collect()}
    monkeypatch.setattr(line_dedup, "MEMBERS", 8)
    assert {r.node: r.component for r in line_dedup.similar_lines(docs)[0].collect()} == whole
    assert len(set(whole.values())) == 1 and len(whole) == len(texts)
    assert compared[0] == len(texts) ** 2 and compared[1] < compared[0] / 2


def test_lines_are_compared_without_python(spark, monkeypatch):
    """Small and large groups, none of them in Python; lines that maps set apart are not similar."""
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin

    def fail(*_):
        raise AssertionError("Python on the executors")

    monkeypatch.setattr(PandasGroupedOpsMixin, "applyInArrow", fail)
    monkeypatch.setattr(line_dedup, "MEMBERS", 8)
    texts = phrase_lines()[:80]
    sets = [line_set(x) for x in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.node: r.component for r in line_dedup.similar_lines(docs)[0].collect()}
    rows = spark.createDataFrame(list(enumerate(texts)), "place long, line string").withColumn("node", F.xxhash64("line"))
    node = {r.place: r.node for r in rows.collect()}
    maps = {r.node: r for r in line_dedup.mapped(rows.select("node", "line")).collect()}
    known, linked = bands_of(spark, texts), 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        x, y = maps[node[a]], maps[node[b]]
        apart = sum((x[f"w{k}"] ^ y[f"w{k}"]).bit_count() if x[f"w{k}"] ^ y[f"w{k}"] >= 0 else ((x[f"w{k}"] ^ y[f"w{k}"]) & (1 << 64) - 1).bit_count() for k in range(line_dedup.WORDS))
        assert apart <= len(sets[a] ^ sets[b]) and x.n == len(sets[a])
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and known[a][2] & known[b][2] and alike(known[a][1], known[b][1]):
            assert got[node[a]] == got[node[b]]
            linked += 1
    assert linked >= 30


def test_forest_connects_what_is_similar():
    rng = np.random.default_rng(9)
    for m in (2, 3, 4, 5, 40, 120):
        seeds = [rng.integers(0, 1 << 40, 90) for _ in range(3)]
        sets = [np.unique(np.r_[seeds[k % 3][: int(rng.integers(60, 91))], rng.integers(0, 1 << 40, int(rng.integers(0, 25)))]).astype(np.uint64) for k in range(m)]
        nodes = rng.permutation(1000)[:m]
        linked = np.array([[a is not b and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets])
        parts = lambda edges: {frozenset(np.flatnonzero(c == k).tolist()) for c in [_labels(m, edges)] for k in set(c)}
        place = {n: i for i, n in enumerate(nodes.tolist())}
        got = [(place[a], place[b]) for a, b in clusters.forest(sets, nodes, 80)]
        assert len(got) == m - len(parts(got)) and all(linked[a, b] for a, b in got)
        assert parts(got) == parts(np.argwhere(linked).tolist())


def _labels(m, edges):
    of = np.arange(m)
    for a, b in edges:
        of[of == of[a]] = of[b]
    return of


def test_unrelated_sets_are_not_compared_element_by_element(monkeypatch):
    rng = np.random.default_rng(3)
    m, common = 600, np.arange(20)
    sets = [np.unique(np.r_[common, 20 + rng.integers(0, 6000, 60)]) for _ in range(m)]
    sets += [np.r_[s[:-3], 10_000 + i] for i, s in enumerate(sets[:9])]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    looked, ranges = [], clusters._ranges

    def counted(begin, end):
        looked.append(int((end - begin).sum()))
        return ranges(begin, end)

    monkeypatch.setattr(clusters, "_ranges", counted)
    others = np.arange(5, len(sets))
    got = clusters._common(row, column, np.searchsorted(row, np.arange(len(sets) + 1)), others)
    assert got.tolist() == [[len(np.intersect1d(sets[a], b)) for b in sets] for a in others]
    # The 20 common elements are not looked up, and the others only where two sets hold them.
    assert sum(looked) == sum(len(np.intersect1d(sets[a][20:], b)) for a in others for b in sets)
    assert len(clusters.forest(sets, np.arange(len(sets)), 80)) == 9


def test_similar_lines_share_a_band(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(2000):  # 160 of 200 shingles in common
        w = "".join(rng.choices("abcdefghijklmnop", k=188))
        pairs += [w, w[:168] + "".join(rng.choices("qrstuvwxyz", k=20))]
    sets = [line_set(x) for x in pairs]
    assert all(len(a & b) == 160 and len(a | b) == 200 for a, b in zip(sets[::2], sets[1::2], strict=True))
    known = bands_of(spark, pairs)
    missed = sum(not known[k][2] & known[k + 1][2] or not alike(known[k][1], known[k + 1][1]) for k in range(0, len(pairs), 2))
    assert missed <= 8  # two are to be expected


def test_the_query_takes_shingles_at_every_character(spark, tmp_path):
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    near = " ".join(word() for _ in range(16))
    apart = ["- 2024-01-15 12:30:00", "- 2024-01-16 12:30:00", "thintionble onwh.", "thintionble$$$ onwh.", "id 1234567890123", "id 1234567899999", "\U0001f600" * 9, "\U0001f601" * 9]
    texts = [*apart, near, near[:20] + "#" + near[21:], "a  b\tc", "a b c", "z" * 30, "z" * 90]
    spark.createDataFrame(list(enumerate(texts)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    sets = [{t[k : k + 9] for k in range(max(1, len(t) - 8))} for t in (re.sub("[\x20\x09-\x0d]+", " ", x) for x in texts)]
    gone = {b for a, b in itertools.combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert gone == {9, 11, 13}
    assert {r.doc_id for r in registry.op1_line_dedup(spark, str(tmp_path)).collect() if r.n_removed} == gone


def test_decontamination(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 40)))) for i in range(25)]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 150)))) for i in range(60)]
    for k in range(80):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, int(0.2 * len(w)))):
            p = rng.randrange(len(w))
            w[p : p + rng.choice((0, 1))] = rng.choice(([], [f"qq{k}"]))
            w = w or ["x"]
        rows.append((1000 + k, f"{rng.choice(rows)[1][:90]}\n{' '.join(w).upper()}! {rng.choice(rows)[1][:50]}"))
    rows += [(None, items[0][1]), (2000, None), (2001, "")]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*items, (99, None), (98, "too short")], "item_id long, text string")
    words, first = decontamination.folded_words([(t or "").encode() for _, t in rows])
    terms, begin = decontamination.folded_words([t.encode() for _, t in items])
    expected = {}
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(items):
            item = terms[begin[b] : begin[b + 1]]
            edits, _ = decontamination.passage(item, words[first[a] : first[a + 1]])
            if edits <= math.floor(0.2 * len(item)):
                expected[i, j] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminations(docs, bench).collect()}
    assert set(got) <= set(expected) and len(got) >= 0.98 * len(expected) > 50
    assert decontamination.decontaminate(docs, bench).count() == len(rows) - len({i for i, _ in got})
    named = spark.createDataFrame([(f"item {i}", t, "x") for i, t in items], "item_id string, text string, doc_id string")
    twice = spark.createDataFrame([(f"doc {i}", t, 1) for i, t in rows[-3:]] * 2, "doc_id string, text string, item_id int")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminations(twice, named).collect()} == {("doc None", "item 0")}
    assert {tuple(r) for r in decontamination.short_items(bench).collect()} == {(99, 0), (98, 2)}


def test_passage():
    a = arrays.mix(np.arange(1, 9, dtype=np.uint64))
    assert decontamination.passage(a[2:6], a)[0] == 0
    assert decontamination.passage(np.r_[a[2:4], a[5:6]], a) == (1, 4) or decontamination.passage(np.r_[a[2:4], a[5:6]], a)[0] == 1
    assert decontamination.passage(a[:3], a[:0])[0] == 3


def test_license_scan(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "hello"), ("a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."), ("d/x", "nothing"), ("top", None), (None, "Released under the MIT License."), (None, "x"), ("a/y", "# This work is licensed under the GNU General Public License, version 2.\ncode code " + "lorem ipsum " * 60)]
    got = {(r.path, r.own_license, r.own_kind, r.license, r.from_dir) for r in license_scan.license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {
        ("a/LICENSE", "MIT", "file", "MIT", None),
        ("a/b/c/x.py", None, None, "Apache-2.0", "a/b"),
        ("a/b/LICENSE.txt", "Apache-2.0", "file", "Apache-2.0", None),
        ("d/x", None, None, None, None),
        ("top", None, None, None, None),
        (None, "MIT", "file", "MIT", None),
        (None, None, None, None, None),
        ("a/y", "GPL-2.0", "header", "GPL-2.0", None),
    }


def test_license_scan_finds_real_files(spark):
    copyright = "Copyright (c) 2021 Some Author\n\n"  # noqa: A001
    wrap = lambda text, lead, wide=60: "\n".join(lead + x for p in text.split("\n") for x in (textwrap.wrap(p, wide) or [""]))
    texts, code = license_texts.TEXTS, "\ndef f(x):\n    return x + 1\n" * 30
    files = {
        "mit/LICENSE": ("MIT License\n\n" + copyright + wrap(texts["MIT"][0], ""), "MIT"),
        "isc/COPYING": (copyright + wrap(texts["ISC"][0], ""), "ISC"),
        "b2/LICENSE": (copyright + wrap(texts["BSD-2-Clause"][0], ""), "BSD-2-Clause"),
        "b3/LICENSE": (copyright + wrap(texts["BSD-3-Clause"][0], ""), "BSD-3-Clause"),
        "z/LICENSE.md": (copyright + wrap(texts["Zlib"][0], ""), "Zlib"),
        "gpl/COPYING": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\nPreamble\n" + code, "GPL-3.0"),
        "gpl2/COPYING": ("\t\t    GNU GENERAL PUBLIC LICENSE\n\t\t       Version 2, June 1991\n\n" + code, "GPL-2.0"),
        "src/a.c": ("/*\n" + wrap(texts["Apache-2.0"][1], " * ") + "\n */\n" + code, "Apache-2.0"),
        "src/b.c": (wrap(texts["GPL-3.0"][0], "# ") + "\n" + code, "GPL-3.0"),
        "src/c.c": (wrap(texts["AGPL-3.0"][0], "// ") + "\n" + code, "AGPL-3.0"),
        "src/d.js": (wrap(texts["MPL-2.0"][0], "// ") + "\n" + code, "MPL-2.0"),
        "src/e.py": ("# SPDX-License-Identifier: MIT\n" + code, "MIT"),
        "src/f.py": ("# SPDX-License-Identifier: EPL-2.0\n" + code, "EPL-2.0"),
        "src/g.py": ("# Licensed under the MIT License\n" + code, "MIT"),
        "src/h.py": ("# Licensed under the Fancy License\n" + code, None),
        "mit/x.py": (code, None),
        "mit/deep/er/y.py": (code, None),
        "src/MIT.txt": (code + "\n\nMIT License\n", None),  # a title amid a text is none
    }
    rows = [(p, t, 1) for p, (t, _) in files.items()] + [("mit/x.py", code, 2), (None, None, 3)]
    got = license_scan.license_scan(spark.createDataFrame(rows, "path string, text string, license int").drop("license")).collect()
    assert {r.path: r.own_license for r in got if r.path} == {p: x for p, (_, x) in files.items()}
    assert {r.path: r.license for r in got if r.path and r.own_license is None} == {"src/h.py": None, "mit/x.py": "MIT", "mit/deep/er/y.py": "MIT", "src/MIT.txt": None}
    assert len(got) == len(rows)
    assert {r.own_kind for r in got if r.path and r.path.split("/")[-1] in ("LICENSE", "COPYING", "LICENSE.md")} == {"file"}


def test_license_cosines(spark):
    """Lines, paragraphs and whole texts against plainly computed cosines."""
    rng = random.Random(21)
    known = {"A": ["alpha beta gamma delta", "one two three four five six"], "B": ["alpha beta epsilon", "seven eight nine ten"]}
    vocabulary = "alpha beta gamma delta epsilon one two three four five six seven eight nine ten other words that files hold".split()
    lines = lambda: [" ".join(rng.choices(vocabulary, k=rng.randint(0, 6))) if rng.random() < 0.7 else rng.choice([k for ks in known.values() for k in ks]) + rng.choice(["", " other"]) for _ in range(rng.randint(1, 5))]
    texts = ["\n".join(lines()) for _ in range(150)]
    terms = [[x.lower().split() for x in t.split("\n")] for t in texts]
    df = Counter(w for t in terms for w in {w for x in t for w in x})
    idf = lambda w: math.log((1 + len(texts)) / (1 + df[w])) + 1

    def cosine(a, b):
        a, b = ({w: n * idf(w) for w, n in Counter(x).items()} for x in (a, b))
        return sum(a[w] * b.get(w, 0) for w in a) / max(math.sqrt(sum(v * v for v in a.values())) * math.sqrt(sum(v * v for v in b.values())), 1e-12)

    expected = []
    for t in terms:
        paragraphs, run = [], []
        for x in [*t, []]:
            run = [*run, *x] if x else paragraphs.append(run) if run else run
            run = run if x else []
        best = lambda unit: max((cosine(unit, k.split()), n) for n, ks in known.items() for k in ks)
        whole, parts = best([w for x in t for w in x]), max([best(u) for u in [*t, *paragraphs]])
        expected.append(round(whole[0] if whole[0] >= 0.8 else parts[0] if parts[0] >= 0.8 else 0.0, 6))
    got = license_scan.own_licenses(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string"), known).collect()
    assert [round(r.own_score, 6) for r in sorted(got, key=lambda r: int(r.path))] == expected
    assert sum(x > 0 for x in expected) > 20


def test_quality_rules(docs, rows):
    got = ordered((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.score(docs).collect())
    expected = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        often, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if often[x] > 1:
                covered |= set(range(k, k + 8))
        x = [y for y in t.split("\n") if WORD.search(y)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(x) - len(set(x)), len(covered), failed))
    assert got == ordered(expected)


def test_expectation_maximisation_recovers_the_rules():
    rng = random.Random(17)
    good = [[0.02, 0.1, 0.88]] * 3 + [[0.01, 0.9, 0.09]] * 3 + [[0.05, 0.35, 0.6]] * 3
    bad = [[0.5, 0.2, 0.3]] * 3 + [[0.45, 0.5, 0.05]] * 3 + [[0.6, 0.2, 0.2]] * 3
    truth, patterns = [], []
    for _ in range(20_000):
        truth.append(rng.random() < 0.8)
        patterns.append(sum(3**k * rng.choices(range(3), (good if truth[-1] else bad)[k])[0] for k in range(9)))
    histogram = Counter(patterns)

    def likelihood(m):
        one = lambda p, of: math.prod(of[k][p // 3**k % 3] for k in range(9))
        data = sum(n * math.log(m.prior * one(p, m.good) + (1 - m.prior) * one(p, m.bad)) for p, n in histogram.items())
        weight = 1 + len(patterns) / 20  # the guess enters as pseudo-counts
        guess = sum(weight * q * math.log(of[k][v]) for of, g in ((m.good, quality_rules.GUESS[quality_rules.GOOD]), (m.bad, quality_rules.GUESS[quality_rules.BAD])) for k in range(9) for v, q in enumerate(g))
        return data + guess + weight * (0.8 * math.log(m.prior) + 0.2 * math.log(1 - m.prior))

    steps = [likelihood(quality_rules.expect_maximise(histogram, r)) for r in (1, 2, 3, 5, 9, 30)]
    assert all(a <= b + 1e-6 for a, b in itertools.pairwise(steps))
    m = quality_rules.expect_maximise(histogram)
    assert abs(m.prior - 0.8) < 0.03 and all(abs(m.good[k][v] - good[k][v]) < 0.06 for k in range(9) for v in range(3))
    best = quality_rules.RuleModel(0.8, good, bad)
    assert sum((m.log_odds(p) >= 0) == (best.log_odds(p) >= 0) for p in patterns) >= 0.98 * len(patterns)


def test_quality_rules_find_junk_and_keep_prose(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("an the er ing on re th ou".split()) for _ in range(2))
    good = [(i, ". ".join(" ".join(word() for _ in range(9)) for _ in range(9)) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(word() + rng.choice(("###", "$$$")) for _ in range(60))) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in good + junk], "doc_id long, text string, n_words string")
    kept = {r.doc_id for r in quality_rules.keep(docs).collect()}
    assert kept == {i for i, _ in good}
    assert quality_rules.keep(docs).columns == docs.columns


def test_quality_model(spark, docs, rows):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("an the er ing on re th ou".split()) for _ in range(2))
    texts = [(i, " ".join(word() + (rng.choice(("###", "!!")) if i % 3 == 0 else "") for _ in range(rng.randint(20, 60))), int(i % 3 > 0)) for i in range(600)]
    got = quality_model.quality_scores(spark.createDataFrame([x[:2] for x in texts], SCHEMA), spark.createDataFrame([(i, q) for i, _, q in texts] + [(None, 1), (5, None)], "doc_id long, quality int")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {i: q for i, _, q in texts}
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)
    bare = quality_model.quality_scores(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(bare) == len(rows) and all(abs(r.score - 0.5) < 1e-9 for r in bare)


def test_lm_scores(docs, rows):
    tokens = [[*WORD.findall(lower(t or "")), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    expected = ordered((i, h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for (i, _), t, h in zip(rows, tokens, held, strict=True))
    got = lm_scoring.lm_scores(docs, block_bytes=9000).collect()
    assert ordered((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_class_model_is_normalised():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, (lm_scoring.CONTEXTS**2, lm_scoring.CLASSES))
    counts[1000:] = 0
    table = lm_scoring.train(counts, rounds=5)
    assert np.allclose((10.0**table).sum(1), 1, atol=1e-4)


def test_probabilities_of_all_tokens_add_up_to_one(monkeypatch):
    monkeypatch.setattr(lm_scoring, "LEAST_COUNT", 3)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) + rng.choice(["", ".", ",", "!"]) for _ in range(600)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(600)], k=rng.randint(0, 60))).encode() for _ in range(200)]
    h, n, rare = lm_scoring._asked(texts, np.ones(len(texts), bool))
    ordinary = h != lm_scoring.END_HASH
    by_class, seen = (np.bincount(rare, w, lm_scoring.RARE + 1).astype(np.int64) for w in (n, n > 0))
    model = lm_scoring._gathered([lm_scoring.pack(by_class, seen, *lm_scoring._most_frequent(h[ordinary], n[ordinary].astype(np.int64), rare[ordinary]))])
    assert model.n == n.sum() and model.v == len(h) and (model.column >= 0).sum() > 50
    t = lm_scoring.tokens_of(texts)
    c, col, bare = model.placed(t)
    one, context = model.contexts(c, t.row)
    trigrams = np.bincount(context * lm_scoring.CLASSES + c, minlength=lm_scoring.CONTEXTS**2 * lm_scoring.CLASSES).reshape(-1, lm_scoring.CLASSES)
    inner = col >= 0
    width = int(model.ends[-1])
    bigrams = np.bincount(one[inner] * width + col[inner], minlength=lm_scoring.CONTEXTS * width).reshape(-1, width)
    model.table, model.words = lm_scoring.train(trigrams, rounds=20), lm_scoring.train_words(bigrams, model.ends, steps=20)
    # Every token of the vocabulary, and one unknown token for each rare class, after some contexts.
    all_tokens = lm_scoring.Tokens(np.r_[h, lm_scoring.mix(np.arange(lm_scoring.RARE, dtype=np.uint64))], np.r_[rare, np.arange(lm_scoring.RARE)].astype(np.uint8), np.zeros(len(h) + lm_scoring.RARE, np.int64))
    count = np.r_[n, np.zeros(lm_scoring.RARE)]
    c, col, bare = model.placed(all_tokens)
    for context in (0, 5 * lm_scoring.CONTEXTS + 100, 128 * lm_scoring.CONTEXTS + 96, 129 * lm_scoring.CONTEXTS - 1):
        one = context % lm_scoring.CONTEXTS
        lp = model.table[context, c] + np.where(col >= 0, model.words[one, np.maximum(col, 0)], 0) + np.where(bare, np.log10(count + 0.1) - model.rare_log10[np.where(bare, c - lm_scoring.OWN, 0)], 0)
        assert abs((10.0**lp).sum() - 1) < 1e-3


def test_token_vectors_learn_what_follows_what():
    ends, rng = np.array([4, 8]), np.random.default_rng(2)
    counts = np.zeros((lm_scoring.CONTEXTS, 8), np.int64)
    counts[0, :] = [900, 50, 30, 20, 700, 100, 100, 100]
    counts[1, :] = [50, 900, 20, 30, 100, 100, 100, 700]
    counts[2] = rng.integers(1, 300, 8)
    found = 10.0 ** lm_scoring.train_words(counts, ends)
    assert np.allclose(found[:, :4].sum(1), 1, atol=1e-4) and np.allclose(found[:, 4:].sum(1), 1, atol=1e-4)
    for c in (0, 1):
        for a, b in ((0, 4), (4, 8)):
            assert np.abs(found[c, a:b] - counts[c, a:b] / counts[c, a:b].sum()).max() < 0.12


def test_training_takes_little_memory_beside_its_tables():
    rng = np.random.default_rng(4)
    counts = np.zeros((lm_scoring.CONTEXTS, 32 * 1500), np.int64)
    counts.ravel()[rng.integers(0, counts.size, 20_000)] = 1
    ends = np.arange(1, 33) * 1500
    trigrams = rng.integers(0, 2, (lm_scoring.CONTEXTS**2, lm_scoring.CLASSES))
    tracemalloc.start()
    words = lm_scoring.train_words(counts, ends, steps=1)
    of_words = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    table = lm_scoring.train(trigrams, rounds=1)
    of_classes = tracemalloc.get_traced_memory()[1] - words.nbytes
    tracemalloc.stop()
    assert of_words < 3 * words.nbytes and of_classes < 6 * table.nbytes
    cell = np.flatnonzero(counts)
    assert (lm_scoring.train_cells(cell, counts.ravel()[cell], ends, 1) == words).all()
    assert np.allclose(np.add.reduceat(10.0 ** words, np.r_[0, ends[:-1]], axis=1), 1, atol=1e-3)


def test_lm_scores_beat_the_base_on_held_out_documents(spark):
    rng = random.Random(31)
    follow = {f"w{k}": [f"w{rng.randrange(400)}" for _ in range(4)] for k in range(400)}
    rows = []
    for i in range(400):
        w = ["w0"]
        for _ in range(80):
            w.append(rng.choice(follow[w[-1]]))
        rows.append((i, " ".join(w)))
    held = [r for r in lm_scoring.lm_scores(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert len(held) > 20 and sum(r.score for r in held) > sum(r.base_score for r in held) + 5 * len(held)


def test_packing(spark, docs, rows):
    got = packing.pack(docs, budget=300, buckets=4).collect()
    assert ordered((r.doc_id, r.n_tokens) for r in got) == ordered((i, len(WORD.findall(t or "")) + 1) for i, t in rows)
    batches = Counter((r.bucket, r.batch) for r in got)
    for r in got:
        assert 0 <= r.padding and (batches[r.bucket, r.batch] * r.bucket_tokens <= 300 or batches[r.bucket, r.batch] == 1)
    for b in {r.bucket for r in got}:
        room = max(300 // next(r.bucket_tokens for r in got if r.bucket == b), 1)
        sizes = [batches[b, k] for k in range(max(k for c, k in batches if c == b) + 1)]
        assert all(s == room for s in sizes[:-1])


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        hist = sorted((n, rng.randint(1, 9)) for n in rng.sample(range(1, 60), rng.randint(1, 9)))
        buckets, sizes = rng.randint(1, 5), [n for n, _ in hist]
        cost = lambda bounds: sum((min(b for b in bounds if b >= n) - n) * c for n, c in hist)  # noqa: B023, E731
        best = min(cost((*c, sizes[-1])) for k in range(min(buckets, len(sizes))) for c in itertools.combinations(sizes[:-1], k))
        found = packing.best_boundaries(hist, buckets)
        assert cost(found) == best and len(found) <= buckets


def test_empty_tables(spark, none):
    labels, bench = spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([], "item_id long, text string")
    files = spark.createDataFrame([], "path string, text string")
    made = [
        suffix_dedup.suffix_dedup(none),
        substring_dedup.substring_dedup(none),
        ngram_join.jaccard_components(none),
        line_dedup.line_dedup(none),
        decontamination.contaminations(none, bench),
        decontamination.decontaminate(none, bench),
        license_scan.license_scan(files),
        quality_rules.score(none),
        quality_model.quality_scores(none, labels),
        lm_scoring.lm_scores(none),
        packing.pack(none),
    ]
    assert not any(df.collect() for df in made)
