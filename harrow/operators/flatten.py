"""Flat forms of stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the catalogue's detail table.
CATALOG, LIBRARY, LANGUAGE = "Каталог", "Библиотека", "Язык"
PLACES = ("Место издания", "Место публикации")
PUBLISHER = "Издательство"


def json_text(value: Column, path: str) -> Column:
    """A string of the JSON text; null where the path holds something else."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(value, path, "string"))


def pointer(value: Column, path: str) -> Column:
    """A non-empty string at the path, else null."""
    return F.nullif(json_text(value, path), F.lit(""))


def compact(value: Column, path: str) -> Column:
    """Any value at the path as compact JSON; null where it is absent."""
    return F.to_json(F.try_variant_get(value, path, "variant"))


def first_detail(value: Column, label: str) -> Column:
    return pointer(value, f"$.metadata.detail_map['{label}'][0]")


def records_view(records: DataFrame) -> DataFrame:
    """id, texts, lists as JSON and first details of every record; empty strings stay."""
    v = F.try_parse_json(F.col("json"))
    detail = lambda label: F.get_json_object("json", f"$.metadata.detail_map['{label}'][0]")
    at = lambda path: F.get_json_object("json", path)
    return records.select(
        "id",
        at("$.metadata.title").alias("title"),
        at("$.metadata.year").alias("year"),
        compact(v, "$.metadata.authors").alias("authors_json"),
        detail(CATALOG).alias("catalog"),
        detail(LIBRARY).alias("library"),
        detail(LANGUAGE).alias("language"),
        at("$.metadata.bibliographic_description").alias("bibliographic_description"),
        at("$.metadata.description").alias("description"),
        compact(v, "$.metadata.topics").alias("topics_json"),
        compact(v, "$.metadata.pdf_links").alias("pdf_links_json"),
        F.json_array_length(at("$.metadata.pdf_links")).cast("long").alias("pdf_count"),
        at("$.url").alias("url"),
        "fetched_at",
    )


def parquet_rows(records: DataFrame) -> DataFrame:
    """The twelve string columns of the flat export; empty strings become null."""
    parsed = records.select("id", "json", F.try_parse_json(F.col("json")).alias("v"))
    v = F.col("v")
    return parsed.select(
        "id",
        pointer(v, "$.metadata.title").alias("title"),
        compact(v, "$.metadata.authors").alias("authors_json"),
        pointer(v, "$.metadata.year").alias("year"),
        first_detail(v, CATALOG).alias("catalog"),
        first_detail(v, LANGUAGE).alias("language"),
        F.coalesce(*[first_detail(v, p) for p in PLACES]).alias("publication_place"),
        first_detail(v, PUBLISHER).alias("publisher"),
        compact(v, "$.metadata.pdf_links").alias("pdf_links_json"),
        compact(v, "$.metadata.detail").alias("detail_json"),
        pointer(v, "$.marc21.raw_xml").alias("marc_xml"),
        F.col("json").alias("record_json"),
    )
