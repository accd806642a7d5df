"""Scalar functions of the catalogue as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from harrow.schemas import PARAMS

_LOW = 0xFFFFFFFF


def fnv1a64(text: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, as 16 lower-case hex digits.

    The state is kept in two 32-bit halves, so no product leaves 64 bits; the
    prime is 2**40 + 435.
    """

    def step(a: Column, byte: Column) -> Column:
        v = a["lo"].bitwiseXOR(byte)
        low = v * 435
        high = a["hi"] * 435 + F.shiftright(low, 32) + F.shiftleft(v.bitwiseAND(F.lit(0xFFFFFF)), 8)
        return F.struct(high.bitwiseAND(F.lit(_LOW)).alias("hi"), low.bitwiseAND(F.lit(_LOW)).alias("lo"))

    start = F.struct(F.lit(3421674724).cast("long").alias("hi"), F.lit(2216829733).cast("long").alias("lo"))
    # Read as Latin-1, a byte is a character; the array of them is made once a text.
    letters = F.split(F.decode(F.encode(text, "utf-8"), "iso-8859-1"), "")
    bytes_ = F.transform(F.filter(letters, lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    hashed = F.transform(F.array(F.aggregate(bytes_, start, step)), lambda h: F.lower(F.concat(F.lpad(F.hex(h["hi"]), 8, "0"), F.lpad(F.hex(h["lo"]), 8, "0"))))
    return F.get(hashed, F.lit(0))


def human_bytes(n: Column) -> Column:
    """Bytes in the largest unit up to PiB with one decimal; whole bytes below one KiB."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB", "PiB"), 1):
        out = F.when(n >= 1024**power, F.concat(F.format_string("%.1f", F.bround(n / float(1024**power), 1)), F.lit(f" {unit}"))).otherwise(out)
    return out


def abbreviate(text: Column, most: int = 80) -> Column:
    return F.when(F.char_length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text)


def rfc3339(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parsed_params(params_json: Column) -> Column:
    """The search parameters as a struct; null where the text is no JSON object."""
    return F.from_json(params_json, PARAMS)


def extra_pairs(params: Column) -> Column:
    """key=value of the well-formed extra pairs."""
    good = F.filter(F.coalesce(params["extra"], F.array().cast("array<array<string>>")), lambda e: (F.size(e) >= 2) & F.get(e, F.lit(0)).isNotNull() & F.get(e, F.lit(1)).isNotNull())
    return F.transform(good, lambda e: F.concat_ws("=", F.get(e, F.lit(0)), F.get(e, F.lit(1))))


def shard_label(params_json: Column) -> Column:
    """What a shard searches for, in words."""
    p = parsed_params(params_json)
    first, last = p["publishyear_prev"], p["publishyear_next"]

    def listed(name: str, values: Column) -> Column:
        return F.when(F.size(values) > 0, F.concat(F.lit(f"{name}="), F.array_join(values, ",")))

    year = (
        F.when(first == last, F.concat(F.lit("year="), first))
        .when(first.isNotNull() & last.isNotNull(), F.concat(F.lit("year="), first, F.lit(".."), last))
        .when(first.isNotNull(), F.concat(F.lit("year>="), first))
        .when(last.isNotNull(), F.concat(F.lit("year<="), last))
    )
    quoted = F.concat(F.lit('q="'), F.replace(F.replace(p["query"], F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    sort = F.when(p["sort_by"].isNotNull(), F.concat(F.lit("sort="), p["sort_by"], F.lit(":"), F.coalesce(p["order"], F.lit("?"))))
    text = F.concat_ws(" ", F.when(p["query"] != "", quoted), listed("catalog", p["catalogs"]), listed("access", p["access"]), year, sort, listed("extra", extra_pairs(p)))
    valid = F.try_parse_json(params_json).isNotNull()
    return F.when(~valid, "<invalid params>").when(text == "", "default").otherwise(text)


def group_key(params_json: Column, facets: Sequence[str]) -> Column:
    """The parameters without sorting and without facet pairs, as JSON text; malformed pairs stay."""
    p = parsed_params(params_json)
    facet = F.array(*[F.lit(f) for f in facets]) if facets else F.array().cast("array<string>")
    kept = F.filter(p["extra"], lambda e: ~F.coalesce(F.array_contains(facet, F.get(e, F.lit(0))), F.lit(False)))
    names = ("base_url", "query", "catalogs", "access", "publishyear_prev", "publishyear_next")
    return F.to_json(F.struct(*[p[n].alias(n) for n in names], kept.alias("extra")), {"ignoreNullFields": "false"})


def with_sort(params_json: Column, field: Column, order: Column) -> Column:
    """The same search in another order."""
    p = parsed_params(params_json)
    names = ("base_url", "query", "catalogs", "access", "publishyear_prev", "publishyear_next")
    return F.to_json(F.struct(*[p[n].alias(n) for n in names], field.alias("sort_by"), order.alias("order"), p["extra"].alias("extra")), {"ignoreNullFields": "false"})


def with_facet(params_json: Column, field: Column, value: Column) -> Column:
    """The same search, unsorted and narrowed to a facet value; a pair of the field is replaced in place."""
    p = parsed_params(params_json)
    has = F.exists(p["extra"], lambda e: F.get(e, F.lit(0)) == field)
    pair = F.array(field, value)
    extra = F.when(has, F.transform(p["extra"], lambda e: F.when(F.get(e, F.lit(0)) == field, pair).otherwise(e))).otherwise(F.concat(F.coalesce(p["extra"], F.array().cast("array<array<string>>")), F.array(pair)))
    names = ("base_url", "query", "catalogs", "access", "publishyear_prev", "publishyear_next")
    none = F.lit(None).cast("string")
    return F.to_json(F.struct(*[p[n].alias(n) for n in names], none.alias("sort_by"), none.alias("order"), extra.alias("extra")), {"ignoreNullFields": "false"})


def facet_depth(params_json: Column, facets: Sequence[str]) -> Column:
    return F.size(F.filter(parsed_params(params_json)["extra"], lambda e: F.get(e, F.lit(0)).isin(*facets)))


def total_results(html: Column) -> Column:
    """The number of results that a search page names; null if none."""
    shown = F.regexp_extract(html, r"(?U)Найдено\s+([0-9\s]+)\s+результ", 1)
    return F.nullif(F.regexp_replace(shown, "[^0-9]", ""), F.lit("")).try_cast("bigint")


def fallback_ids(html: Column) -> Column:
    """Catalogue ids in raw links, in document order and once each."""
    found = F.regexp_extract_all(html, F.lit(r'/catalog/([^/"?#]+)/?'), F.lit(1))
    return F.array_distinct(F.filter(found, lambda x: (x != "") & (x != "undefined")))


def collapse_blanks(text: Column) -> Column:
    """Unicode white space collapsed and trimmed."""
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))


def log_title(title: Column) -> Column:
    return F.coalesce(F.nullif(collapse_blanks(title), F.lit("")), F.lit("<no title>"))


def search_url(params_json: Column, page: Column) -> Column:
    """The address of a results page."""
    p = parsed_params(params_json)

    def pair(key: str, value: Column) -> Column:
        return F.concat(F.url_encode(F.lit(key)), F.lit("="), F.url_encode(value))

    def many(key: str, values: Column) -> Column:
        return F.array_join(F.transform(values, lambda v: pair(key, v)), "&")

    extra = F.array_join(F.transform(F.filter(p["extra"], lambda e: F.size(e) >= 2), lambda e: F.concat(F.url_encode(F.get(e, F.lit(0))), F.lit("="), F.url_encode(F.get(e, F.lit(1))))), "&")
    parts = [
        pair("q", F.coalesce(p["query"], F.lit(""))),
        F.when(F.size(p["catalogs"]) > 0, many("c[]", p["catalogs"])),
        F.when(F.size(p["access"]) > 0, many("access[]", p["access"])),
        F.when(p["publishyear_prev"].isNotNull(), pair("publishyear_prev", p["publishyear_prev"])),
        F.when(p["publishyear_next"].isNotNull(), pair("publishyear_next", p["publishyear_next"])),
        F.when(p["sort_by"].isNotNull(), pair("by", p["sort_by"])),
        F.when(p["order"].isNotNull(), pair("order", p["order"])),
        F.when(F.size(p["extra"]) > 0, extra),
        F.when(page > 1, pair("PAGEN_1", page.cast("string"))),
    ]
    return F.concat(F.regexp_replace(p["base_url"], "/+$", ""), F.lit("/search/?"), F.concat_ws("&", *parts))
