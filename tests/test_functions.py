"""Scalar functions and extraction on the literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from harrow import session
from harrow.functions import scalars
from harrow.operators import coverage, extract, flatten, planner, requests

BASE = "https://catalog.test/"

# Class names, property names and labels that the pages of the catalogue use.
ROW, LEFT, RIGHT = "cards-table__row", "cards-table__left", "cards-table__right"
YEAR, CATALOG, TOPIC, FOUND = "Год издания", "Каталог", "Тематика", ("Найдено", "результ")
READ, ITEM = "search-result__content-main-read-button", "search-list__item_link"


def card(title, heading, author, year, about, rows, file):
    """A record's page, its details as (label, inner markup)."""
    table = "\n".join(f"<div class='{ROW} wide'>\n <div class='{LEFT}'>\n{k}\n</div><div class='{RIGHT}'>{v}</div></div>" for k, v in rows)
    return f"""<!DOCTYPE html><html lang="ru"><head><title>Страница</title>
  <meta name="description" content="{about}"/><meta content="{year}" property="book:release_date"/>
  <meta property="og:title" content="{title}"/></head>
<body><main><p>See <b itemprop="author">{author}</b></p><h1>{heading}</h1>
<section class="cards-section"><h2>Детальная информация</h2><div class="cards-table">{table}</div></section>
<p id="toClipBoard">{author}. {heading}</p><a download href="{file}">Скачать</a></main></body></html>"""


CARD = card("Herbs &lt;of&gt; the Steppe", "Herbs", "N. Grasses", 1874, "Plates, uncoloured", [(TOPIC, "ботаника"), (CATALOG, "<a href='/shelf/9?x=1'>Атласы</a>"), (YEAR, " 1873 ")], "scans/herbs.pdf")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def fnv(text):
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = (h ^ b) * 0x100000001B3 % 2**64
    return f"{h:016x}"


@pytest.mark.parametrize("text", ["", "a", "foobar", "Каталог", '{"q":null}'])
def test_fnv(spark, text):
    assert one(spark, scalars.fnv1a64(F.lit(text))) == fnv(text)


@pytest.mark.parametrize(("n", "shown"), [(0, "0 B"), (1023, "1023 B"), (1536, "1.5 KiB"), (1 << 20, "1.0 MiB"), (5 << 30, "5.0 GiB"), (3 << 40, "3.0 TiB"), (2 << 50, "2.0 PiB"), (2048 << 50, "2048.0 PiB")])
def test_human_bytes(spark, n, shown):
    assert one(spark, scalars.human_bytes(F.lit(n).cast("long"))) == shown


@pytest.mark.parametrize(("html", "n"), [("Найдено 22 514 496   результатов", 22514496), ("Найдено 7 результатов", 7), ("nothing", None)])
def test_total_results(spark, html, n):
    assert one(spark, scalars.total_results(F.lit(html))) == n


@pytest.mark.parametrize(
    ("params", "label"),
    [
        ("{", "<invalid params>"),
        ("{}", "default"),
        ('{"query":"a","publishyear_prev":"1900","publishyear_next":"1900"}', 'q="a" year=1900'),
        ('{"publishyear_prev":"1","publishyear_next":"2"}', "year=1..2"),
        ('{"publishyear_prev":"1"}', "year>=1"),
        ('{"publishyear_next":"2","sort_by":"s"}', "year<=2 sort=s:?"),
        ('{"extra":[["a","b"],["c"]]}', "extra=a=b"),
    ],
)
def test_labels(spark, params, label):
    assert one(spark, scalars.shard_label(F.lit(params))) == label


def test_group_key_keeps_malformed_pairs(spark):
    params = '{"base_url":"u","query":"","catalogs":[],"access":[],"publishyear_prev":null,"publishyear_next":null,"sort_by":"x","order":"asc","extra":[["lang","ru"],[],["z","1"]]}'
    assert one(spark, scalars.group_key(F.lit(params), ["lang"])) == '{"base_url":"u","query":"","catalogs":[],"access":[],"publishyear_prev":null,"publishyear_next":null,"extra":[[],["z","1"]]}'


def test_card():
    m = extract.card_metadata(CARD, BASE + "record/5/")
    assert (m["title"], m["year"], m["authors"], m["description"]) == ("Herbs <of> the Steppe", "1874", ["N. Grasses"], "Plates, uncoloured")
    assert m["detail_map"] == {YEAR: ["1873"], CATALOG: ["Атласы"], TOPIC: ["ботаника"]}
    assert [x["links"] for x in m["detail"] if x["links"]] == [[{"text": "Атласы", "href": BASE + "shelf/9?x=1"}]]
    assert m["pdf_links"] == [BASE + "record/5/scans/herbs.pdf"]
    assert m["topics"] == ["ботаника"]
    assert m["bibliographic_description"] == "N. Grasses. Herbs"


def test_card_precedence():
    assert extract.card_metadata('<h1>seen</h1><meta property="og:title" content="">', BASE)["title"] == ""
    assert extract.card_metadata("<head><title>\n only a title </title></head>", BASE)["title"] == "only a title"
    assert extract.card_metadata("", BASE)["title"] is None


@pytest.mark.parametrize(("shown", "title"), [("Plants &amp; herbs&amp", "Plants & herbs&amp"), ("a&ltb &ampx; &#38 &#38;", "a&ltb &ampx; &#38 &"), ("A&B & C", "A&B & C"), ("&amp;lt;", "<"), ("&amp;amp", "&amp")])
def test_only_complete_references_are_decoded(shown, title):
    for page in (f"<title>{shown}</title>", f'<meta property="og:title" content="{shown}">', f"<h1>{shown}</h1>"):
        assert extract.card_metadata(page, BASE)["title"] == title
    assert extract.facet_values(f'<p data-id="lang" data-value="{shown}"/>', ["lang"]) == {"lang": [title]}


def test_ids():
    results = "".join(f"<li><a class='{kind} x' href='/catalog/{key}/{rest}'>-</a></li>" for kind, key, rest in ((ITEM, "q-17", ""), (READ, "q-18", "view?p=2"), (ITEM, "q-17", "#top")))
    assert extract.catalog_ids(f"<ul>{results}</ul><a href='/catalog/shelf'>up</a>") == ["q-17", "q-18"]
    assert extract.catalog_ids('<p data-x="/catalog/undefined"></p><a href="/catalog/z9?x">z</a>') == ["z9"]


def test_facets():
    values = [("lang", " тувинский "), ("lang", "немецкий"), ("other", "1"), ("lang", "немецкий"), ("idlibrary", "  "), ("idlibrary", "204")]
    html = "".join(f"<label data-value='{v}' data-id='{f}'></label>" for f, v in values)
    assert extract.facet_values(html, ["lang", "idlibrary"]) == {"idlibrary": ["204"], "lang": ["тувинский", "немецкий"]}


def test_marc_mixed_prefixes():
    fields = [("856", {"u": "https://files.test/one.pdf", "q": "application/pdf"}), ("245", {"a": "Plain"})]
    body = "".join(f"<m:datafield ind2=' ' ind1='4' tag='{tag}'>" + "".join(f"<subfield code='{c}'>{v}</subfield>" for c, v in sub.items()) + "</m:datafield>" for tag, sub in fields)
    xml = f"<m:record xmlns:m='urn:test'><m:leader>00099cam</m:leader><m:controlfield tag='003'>TST</m:controlfield>{body}</m:record>"
    m = extract.marc_record(xml)
    assert (m["leader"], m["control_fields"], m["pdf_links"]) == ("00099cam", [{"tag": "003", "value": "TST"}], ["https://files.test/one.pdf"])
    broken = extract.marc_or_error("<m:record>")
    assert broken["marc"]["raw_xml"] == "<m:record>" and broken["error"].startswith("MARC XML parse failed")


def test_viewer():
    assert extract.sanitized_viewer('{"pages":3,"viewer":{"k":1},"token":"t"}') == '{"pages":3}'
    assert extract.sanitized_viewer('["a"]') == '["a"]'


def test_pointers(spark):
    v = F.parse_json(F.lit('{"a":"","b":1,"c":["x"],"d":null}'))
    assert one(spark, flatten.pointer(v, "$.a")) is None
    assert one(spark, flatten.pointer(v, "$.b")) is None
    assert one(spark, flatten.compact(v, "$.c")) == '["x"]'
    assert one(spark, flatten.compact(v, "$.d")) == "null"
    assert one(spark, flatten.compact(v, "$.e")) is None


def test_plan_errors(spark):
    spec = planner.SearchSpec(BASE, publishyear_prev="1905", publishyear_next="1900")
    for config in (
        planner.PlannerConfig(overflow_years=(1,)),
        planner.PlannerConfig(shard_years=True),
        planner.PlannerConfig(shard_years=True, no_year_max_pages=0),
        planner.PlannerConfig(shard_years=True, auto_overflow=False, overflow_sorts=(("a", "asc"),)),
    ):
        with pytest.raises(planner.PlanError):
            planner.initial_jobs(spark, spec, config)
    for text in ("a", ":asc", "f:up"):
        with pytest.raises(planner.PlanError):
            planner.parse_sort(text)
    assert planner.parse_sort("f:DESC") == ("f", "desc") and planner.parse_pair("a=b=c") == ("a", "b=c")


def test_overflow_years(spark):
    spec = planner.SearchSpec(BASE, publishyear_prev="1900", publishyear_next="1902")
    config = planner.PlannerConfig(shard_years=True, overflow_years=(1901,), no_year_shard=False)
    labels = {r["label"] for r in planner.initial_jobs(spark, spec, config).collect()}
    assert len(labels) == 3 + 6 and "year 1901 sort document_titlesort:asc" in labels


def test_streaks_over_spans_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(requests, "SPAN", 3)
    rng = random.Random(9)
    statuses = [rng.choice([200, 200, 403, 404, 500, None, 503]) for _ in range(120)] + [503] * 40 + [403] * 40
    seqs = sorted(rng.sample(range(1000), len(statuses)))  # sparse numbers
    log = spark.createDataFrame(list(zip(seqs, statuses, strict=True)), "seq long, http_status int")
    transient = forbidden = success = 0
    expected = []
    for n, s in zip(seqs, statuses, strict=True):
        kind = "transient" if s is None or s >= 500 else "forbidden" if s == 403 else "missing" if s == 404 else "ok"
        transient = 0 if kind == "ok" else transient + (kind == "transient")
        forbidden = forbidden + 1 if kind == "forbidden" else 0
        success = 0 if kind == "transient" else success + (kind == "ok")
        expected.append((n, transient, forbidden, success))
    errors = {r.seq: (r.transient_streak, r.forbidden_streak) for r in requests.error_streaks(log).collect()}
    good = {r.seq: r.success_streak for r in requests.success_streaks(log).collect()}
    assert [(n, *errors[n], good[n]) for n in seqs] == expected


def test_parts_of_a_shuffle_grow_with_its_rows(spark):
    few, many = (session.spread(spark.range(n), "id") for n in (1_000, 10_000_000))
    assert few.rdd.getNumPartitions() <= session.LEAST_PARTS
    assert many.rdd.getNumPartitions() == -(-80_000_000 // session.PART_BYTES)


def test_groups_are_counted_by_a_short_key(spark):
    """The long parameters of a search are in no row of its memberships."""
    pages = spark.createDataFrame([(f"k{i}", 1, '{"query":"q%d","sort_by":"s%d"}' % (i % 2, i), "done", 1, 3) for i in range(4)], "search_key string, page int, params_json string, status string, result_count int, total_results int")
    members = spark.createDataFrame([(f"k{i}", 1, f"x{j}") for i in range(4) for j in range(i, i + 2)], "search_key string, page int, id string")
    found = coverage.group_coverage(coverage.shard_coverage(pages, members), members)
    assert sorted((r.search_keys, r.unique_items) for r in found.collect()) == [("k0,k2", 4), ("k1,k3", 4)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "AS stored" in line]
    assert counted and all("group_key" not in line for line in counted)
