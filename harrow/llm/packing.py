"""Packing of documents into token-budget batches by optimal length buckets.

The histogram of token counts over all documents goes to the driver as two arrays.
It has one row a length that occurs, so never more than the square root of twice
all tokens (4.5 million rows, 72 MB, for 10 trillion tokens).  Dynamic programming over it picks the
bucket boundaries that need the least padding.  Documents of a bucket then form
batches of ``budget // boundary`` rows, in the order of a hash of their id, so
that every batch but the last of a bucket is full.

The rank inside a bucket is found without one task holding a bucket: documents
fall into 4,096 hash slices of a bucket, a running sum over the slice counts
gives each slice its first rank, and rows are numbered inside a slice.

Edge cases: a null or empty text has one token, its end.  A null id is ordered
as the text ``null``; the length enters the order, so that rows without id spread
over slices.  Repeated rows each get a place.  Very long texts are one length more.  A document longer than
the budget gets a batch of its own.  An empty table gives an empty result.
Extra columns do not matter.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.llm.textops import settle, words

SLICE_DIGITS = 3


def word_tokens(text: Column) -> Column:
    """Words and one end token."""
    return (F.size(words(text)) + 1).cast("long")


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least total padding.

    cost(i, j) = length_j * (rows in i+1..j) - (tokens in i+1..j) is linear in
    length_j for a fixed i, so each round keeps the lower hull of those lines
    and costs one pass over the lengths.
    """
    hist = sorted((n, c) for n, c in histogram if c)
    if not hist:
        return []
    m = len(hist)
    rows, tokens = [0], [0]
    for n, c in hist:
        rows.append(rows[-1] + c)
        tokens.append(tokens[-1] + n * c)
    best = [0] + [hist[j - 1][0] * rows[j] - tokens[j] for j in range(1, m + 1)]
    came: list[list[int]] = [[0] * (m + 1)]
    for _ in range(1, min(buckets, m)):
        fresh, back = [0] * (m + 1), [0] * (m + 1)
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, index; slopes fall
        for j in range(1, m + 1):
            a, b = -rows[j - 1], best[j - 1] + tokens[j - 1]
            while len(hull) > 1:
                (a1, b1, _), (a2, b2, _) = hull[-2], hull[-1]
                if (b - b1) * (a1 - a2) <= (b2 - b1) * (a1 - a):
                    hull.pop()
                else:
                    break
            hull.append((a, b, j - 1))
            x = hist[j - 1][0]
            while len(hull) > 1 and hull[1][0] * x + hull[1][1] <= hull[0][0] * x + hull[0][1]:
                hull.popleft()
            fresh[j] = hull[0][0] * x + hull[0][1] + x * rows[j] - tokens[j]
            back[j] = hull[0][2]
        best = fresh
        came.append(back)
    found, j = [], m
    for back in reversed(came):
        if not j:
            break
        found.append(hist[j - 1][0])
        j = back[j]
    return found[::-1]


def pack(docs: DataFrame, budget: int = 65_536, buckets: int = 16, tokens: Column | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_tokens, batch (inside the bucket) and padding of every document."""
    n = word_tokens(F.col(text)) if tokens is None else tokens
    sized = settle(docs.select(F.col(doc_id).alias("doc_id"), n.cast("long").alias("n_tokens")))
    histogram = sized.groupBy("n_tokens").agg(F.count("*").alias("c")).toArrow()
    bounds = best_boundaries(list(zip(*(histogram.column(i).to_pylist() for i in range(2)), strict=True)), buckets) or [1]
    upper = F.array(*[F.lit(b).cast("long") for b in bounds])
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "n_tokens"))
    placed = (
        sized.withColumn("bucket", F.size(F.filter(upper, lambda b: b < F.col("n_tokens"))))
        .withColumn("bucket_tokens", F.get(upper, F.col("bucket")))
        .withColumn("place", order)
        .withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    )
    counts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("rows_here"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("bucket", "slice", F.coalesce(F.sum("rows_here").over(before), F.lit(0)).alias("first_rank"))
    inside = Window.partitionBy("bucket", "slice").orderBy("place", "doc_id", "n_tokens")
    # At most buckets * 4,096 rows are broadcast.
    ranked = placed.join(F.broadcast(first), ["bucket", "slice"]).withColumn("rank", F.col("first_rank") + F.row_number().over(inside) - 1)
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_tokens")), F.lit(1))
    return ranked.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_tokens",
        F.floor(F.col("rank") / room).cast("long").alias("batch"),
        (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )
