"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Scan.  A unit of a file is a line, a paragraph (neighbouring lines that have words,
so a notice wrapped over several comment lines is one), or its whole text.  Words
are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  A
word's inverse document frequency comes from the number of files, out of all files,
that have its hash bucket (``BUCKETS`` counters, whatever the corpus holds).  A
unit's sparse vector (term frequency times idf) is compared by cosine with each
template's; a licence has several templates: short statements, its text or the
notice that it asks for, and the title that its text begins with.  The best template
of at least ``at`` is the file's own licence.  A whole text or a title at the head of a file makes the file a licence
file, other lines and paragraphs a header.  A line with an SPDX identifier names its
licence by itself, whether or not a template knows it.

Inheritance.  A directory has the licence of its licence files: those found by
text, and files named like one (LICENSE, LICENCE, COPYING, UNLICENSE) with an
own licence; the best cosine, then the least path, wins.  A file without an own
licence takes that of the nearest directory above it: ancestors of every
directory join the directories that have a licence, and the deepest match is
kept.

Edge cases: null or empty texts have no own licence; files with a null path
inherit nothing.  Equal cosines go to the template that comes first by name, and
to the whole text before a paragraph before a line.  Repeated rows are scanned
each.  Very long texts are scanned whole, a row at a time.  An empty table gives an
empty result.  Extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.arrays import U64, chunks, sorted_groups
from harrow.llm.decontamination import folded_words
from harrow.llm.exchange import pack, unpack
from harrow.llm.license_texts import STATEMENTS, TEXTS, TITLES
from harrow.llm.textops import settle

BUCKETS = 1 << 16
LICENSE_NAME = r"(?i)(^|/)(un)?(licen[sc]e|copying)([.-][^/]*)?$"

SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)")
#: Templates of each licence; a title counts only at the head of a file.
TEMPLATES = {name: [*STATEMENTS.get(name, ()), *TEXTS.get(name, ())] for name in sorted({*STATEMENTS, *TEXTS, *TITLES})}


def _distinct(group: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, bucket and count of each distinct pair, by group."""
    key, n = np.unique(group.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, n


@dataclass
class Index:
    """idf by bucket; the licence of each template; and the weight of a bucket in each template's unit vector."""

    names: list[str]
    idf: np.ndarray
    weight: np.ndarray
    title: np.ndarray


def build_index(files: int, frequency: np.ndarray, templates: dict[str, list[str] | str], titles: dict[str, list[str]]) -> Index:
    listed = [(n, x, False) for n, texts in templates.items() for x in ([texts] if isinstance(texts, str) else texts)]
    listed = sorted(listed + [(n, x, True) for n, texts in titles.items() for x in texts])
    idf = np.log((1 + files) / (1 + frequency)) + 1
    words, first = folded_words([x.encode() for _, x, _ in listed])
    weight = np.zeros((BUCKETS, len(listed)))
    t, b, n = _distinct(np.repeat(np.arange(len(listed)), np.diff(first)), (words % U64(BUCKETS)).astype(np.int64))
    weight[b, t] = n * idf[b]
    return Index([n for n, _, _ in listed], idf, weight / np.maximum(np.linalg.norm(weight, axis=0), 1e-12), np.array([x for _, _, x in listed]))


def _best(group: np.ndarray, bucket: np.ndarray, index: Index, at: float, groups: int, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best template (-1: none reaches ``at``) and its cosine for each group of words; groups ascend; titles only for the groups at a ``head``."""
    best, score = np.full(groups, -1), np.zeros(groups)
    known = index.weight.any(1)[bucket]
    if not known.any():
        return best, score
    # Counted once an occurrence, squared idf adds up to at most the squared norm: an upper bound of the cosine.
    below = np.sqrt(np.bincount(group, index.idf[bucket] ** 2, groups))
    g, b = group[known], bucket[known]
    cut = sorted_groups(g)[:-1]
    dots = np.zeros((groups, len(index.names)))
    dots[g[cut]] = np.add.reduceat(index.weight[b] * index.idf[b][:, None], cut, axis=0)
    dots[np.ix_(~head, index.title)] = 0
    maybe = np.flatnonzero(dots.max(1) >= at * np.maximum(below, 1e-12))
    inside = np.zeros(groups, bool)
    inside[maybe] = True
    keep = inside[group]
    g, b, n = _distinct(group[keep], bucket[keep])
    norm = np.sqrt(np.bincount(g, (n * index.idf[b]) ** 2, groups))
    cosine = dots[maybe] / np.maximum(norm[maybe], 1e-12)[:, None]
    best[maybe], score[maybe] = cosine.argmax(1), cosine.max(1)
    best[score < at] = -1
    return best, score


def scan_texts(texts: list[bytes], index: Index, at: float) -> list[tuple[str | None, float, str | None]]:
    """Own licence, cosine and kind (file, header) of each text."""
    parts = [t.split(b"\n") for t in texts]
    count = np.array([len(p) for p in parts], np.int64)
    words, first = folded_words([x for p in parts for x in p])
    n_words = np.diff(first)
    line = np.repeat(np.arange(int(count.sum())), n_words)
    bucket = (words % U64(BUCKETS)).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), count)
    # A paragraph begins with a line that has words after one that has none, or with a text.
    solid = n_words > 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | (of[1:] != of[:-1])
    paragraph = np.cumsum(begins) - 1
    first_of = np.flatnonzero(begins)
    in_text = of[first_of]
    head = np.ones(len(first_of), bool)
    head[1:] = in_text[1:] != in_text[:-1]
    line_head = np.zeros(len(of), bool)
    line_head[first_of[head]] = True
    out: list[tuple[str | None, float, str | None]] = [(None, 0.0, None)] * len(texts)

    def offer(group: np.ndarray, text_of: np.ndarray, heads: np.ndarray, whole: bool) -> None:
        best, score = _best(group, bucket, index, at, len(text_of), heads)
        for x in np.flatnonzero(best >= 0).tolist():
            found = out[text_of[x]]
            if score[x] > found[1] + 1e-12 or (whole and found[0] is not None):
                kind = "file" if whole or index.title[best[x]] else "header"
                out[text_of[x]] = (index.names[best[x]], float(score[x]), kind)

    offer(line, of, line_head, False)
    offer(paragraph[line], in_text, head, False)
    offer(of[line], np.arange(len(texts)), np.ones(len(texts), bool), True)
    for i, t in enumerate(texts):
        if out[i][2] != "file" and b"SPDX-License-Identifier:" in t and (m := SPDX.search(t)):
            out[i] = (m[1].decode(), 1.0, "header")
    return out


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files, frequency = 0, np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, texts in chunks(batch, "text"):
            words, first = folded_words(texts)
            _, b, _ = _distinct(np.repeat(np.arange(len(texts)), np.diff(first)), (words % U64(BUCKETS)).astype(np.int64))
            frequency += np.bincount(b, minlength=BUCKETS)
            files += len(texts)
    yield pa.record_batch([pa.array([0]), pa.array([files]), pa.array([pack(frequency)], pa.binary())], names=["part", "files", "payload"])


def _add(table: pa.Table) -> pa.Table:
    total = sum(unpack(p.as_py())[0] for p in table.column("payload"))
    return pa.table({"part": table.column("part")[:1], "files": pa.array([sum(table.column("files").to_pylist())]), "payload": pa.array([pack(total)], pa.binary())})


def own_licenses(files: DataFrame, templates: dict[str, list[str] | str] | None = None, at: float = 0.8, path: str = "path", text: str = "text") -> DataFrame:
    """path, own_license, own_score and own_kind of every file."""
    own = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    parts = own.select("text").mapInArrow(_partial, "part long, files long, payload binary")
    # Partial counters are added in groups of partitions first, so that no task reads more than a few hundred.
    some = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)).cast("long")).groupBy("part").applyInArrow(_add, "part long, files long, payload binary")
    n, frequency = 0, np.zeros(BUCKETS, np.int64)
    for r in some.toLocalIterator():
        n += r["files"]
        frequency = frequency + unpack(r["payload"])[0]
    shared = files.sparkSession.sparkContext.broadcast(build_index(n, frequency, templates or TEMPLATES, {} if templates else TITLES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                got = scan_texts(texts, shared.value, at)
                columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.string())]
                yield pa.record_batch([batch.column("path").slice(first, len(texts)), *columns], names=["path", "own_license", "own_score", "own_kind"])

    return own.mapInArrow(run, "path string, own_license string, own_score double, own_kind string")


def _directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def inherit(scanned: DataFrame, is_license_file: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """``scanned`` with license (own or inherited), source (own, inherited) and from_dir."""
    rule = is_license_file(scanned) if is_license_file else (F.col("own_kind") == "file") | F.col("path").rlike(LICENSE_NAME)
    placed = scanned.withColumn("dir", _directory(F.col("path")))
    known = placed.filter(rule & F.col("own_license").isNotNull() & F.col("dir").isNotNull())
    known = known.groupBy("dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_license"))["own_license"].alias("dir_license"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("up")))
    dirs = placed.filter(F.col("own_license").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    climbed = dirs.select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.up")
    nearest = climbed.join(known.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "dir_license")).alias("n"))
    joined = placed.join(nearest, "dir", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        *[F.col(c) for c in scanned.columns],
        F.coalesce("own_license", F.col("n")["dir_license"]).alias("license"),
        F.when(own, "own").when(F.col("n").isNotNull(), "inherited").alias("license_source"),
        F.when(~own, F.col("n")["up"]).alias("from_dir"),
    )


def license_scan(files: DataFrame, templates: dict[str, list[str] | str] | None = None, at: float = 0.8, path: str = "path", text: str = "text", is_license_file: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Own and effective licence of every file."""
    # The texts are scanned once; what is found, a few words a file, is read three times.
    return inherit(settle(own_licenses(files, templates, at, path, text)), is_license_file)
