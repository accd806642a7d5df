"""The pipeline's stages on a small fixture."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harrow.llm import line_dedup


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("an the er ing on re th ou ti st en at".split()) for _ in range(rng.randint(1, 3)))
    prose = lambda n: ".\n".join(" ".join(word() for _ in range(14)) for _ in range(n)) + "."
    clean = [(i, prose(9)) for i in range(80)]
    item = " ".join(word() for _ in range(30))
    rows = clean + [(200, clean[0][1].replace(" ", "  ", 1)), (201, "too short"), (202, f"{prose(4)}\n{item}\n{prose(4)}"), (203, " ".join(word() + "###" for _ in range(80))), (204, None)]
    documents = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_keep_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == columns
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert {201, 203, 204}.isdisjoint(kept[0]) and {*range(80), 200, 202} <= kept[0]
    assert 202 not in kept[3] and set(range(80)) <= kept[3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == kept[-1]


def test_near_duplicates_leave_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, folder).collect()}
    assert 0 in kept and 200 not in kept and set(range(80)) <= kept


def test_documents_that_lose_all_lines_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = docs.unionByName(docs.filter("doc_id < 3").withColumn("doc_id", docs["doc_id"] + 500))
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_lines(spark, whole, folder).collect()}
    assert {500, 501, 502, 200}.isdisjoint(kept) and set(range(80)) <= set(kept)
    assert 204 in kept  # it had no line to lose
    packed = corpus_pipeline.run(spark, folder).collect()
    assert min(r["n_tokens"] for r in packed) > 1


def test_crowded_near_duplicates_leave_one(spark, folder):
    """Families of variants that quote long passages of one another."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(120)]
    rows, family = [], {}
    for f in range(12):
        base = passage + [word() for _ in range(100)]
        for v in range(25):
            w = base.copy()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            family[len(rows)] = f
            rows.append((len(rows), " ".join(w), "en", "s", 1))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split(" ") for _, t, *_ in rows)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent[:]:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    expected = {find(a) for a in range(len(rows))}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert {r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, folder).collect()} == expected
    assert 12 <= len(expected) < 100


def test_empty_documents_and_null_ids(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    for name, rows in (("none", docs.limit(0)), ("null", docs.filter("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long")))):
        at = f"{tmp_path}/{name}"
        rows.write.parquet(f"{at}/documents.parquet")
        bench.write.parquet(f"{at}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    got = corpus_pipeline.run(spark, f"{tmp_path}/null").collect()
    assert {r["doc_id"] for r in got} == {None}


def test_line_stage_compares_a_chain_by_band(spark, folder, monkeypatch):
    """Lines that each overlap the next one: one cluster, whose pairs are not all compared."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(words[k : k + 60]) for k in range(0, 320, 4)]
    compared, dealt = [], line_dedup.dealt

    def counted(member, key):
        placed = dealt(member, key)
        if "line" in member.columns:
            compared.append(placed.groupBy(key, "i", "j").count().select(F.sum(F.col("count") * F.col("count"))).first()[0])
        return placed

    monkeypatch.setattr(line_dedup, "dealt", counted)
    monkeypatch.setattr(line_dedup, "MEMBERS", 8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.cut_lines(spark, docs, folder).collect()] == [0]
    assert compared[0] < len(texts) ** 2  # all pairs of the chain
