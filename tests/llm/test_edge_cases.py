"""Extra columns with clashing names, repeated rows, null ids and very long texts in every operator."""

import random

import pytest
from pyspark.sql import functions as F

from harrow.llm import decontamination, license_scan, line_dedup, lm_scoring, ngram_join, packing, quality_model, quality_rules, substring_dedup, suffix_dedup

CLASH = "id node band block label payload bucket rank size place line first component item_id path held score kept n_tokens slice end_word pattern f sketch doc task".split()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(77)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() + ("\n" if rng.random() < 0.1 else "") for _ in range(n))
    out = [(i, prose(rng.randint(5, 120))) for i in range(40)]
    long = prose(120_000)  # some 700 kB
    out += [(100, out[3][1]), (101, out[3][1]), (101, out[3][1]), (None, out[5][1]), (None, None), (None, ""), (102, None), (103, long), (104, long[5:] + " end")]
    return out


def results(spark, docs, item):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(3, None, "y")], "doc_id long, quality int, text string")
    bench = spark.createDataFrame([(1, item, 5), (1, item, 5)], "item_id long, text string, doc_id int")
    files = docs.withColumn("path", F.concat(F.lit("d/"), F.col("doc_id").cast("string")))
    return {
        "op1": line_dedup.line_dedup(docs),
        "op2": suffix_dedup.suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "kept"),
        "op3": decontamination.contaminations(docs, bench),
        "op4": ngram_join.jaccard_components(docs, 3, 90),
        "op5": license_scan.license_scan(files).select("path", "own_license", "license"),
        "op6": quality_model.quality_scores(docs, labels).select("doc_id", "held_out"),
        "op7": substring_dedup.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept"),
        "op8": quality_rules.score(docs),
        "op9": lm_scoring.lm_scores(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens"),
        "op10": packing.pack(docs),
    }


def test_extra_columns_change_nothing(spark, rows):
    plain = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = plain.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])
    item = " ".join(rows[7][1].split()[:25])
    a, b = results(spark, plain, item), results(spark, clash, item)
    for name in a:
        one, two = (sorted(map(tuple, x[name].collect()), key=str) for x in (a, b))
        assert one == two, name
        if name not in ("op3",):
            assert len(one) == len(rows), name
    found = a["op3"].collect()
    assert {r.doc_id for r in found} == {7} and len(found) == 2  # the item is there twice
    removed = {r.doc_id: r.n_removed for r in a["op2"].collect()}
    assert removed[104] > 600_000 and removed[103] == 0
    groups = {r.doc_id: r.component_id for r in a["op4"].collect() if r.doc_id is not None}
    assert groups[100] == groups[101] == 3 and groups[104] == 103


def test_filters_keep_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])
    bench = spark.createDataFrame([], "item_id long, text string")
    for kept in (line_dedup.dedup_lines(docs), line_dedup.dedup_lines(docs, drop_emptied=True), quality_rules.keep(docs), decontamination.decontaminate(docs, bench)):
        assert kept.columns == docs.columns and kept.count() > 0
