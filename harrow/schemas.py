"""Schemas of the catalogue state and of a harvested record."""

from __future__ import annotations

META = "key string, value string"
SEARCH_PAGES = "search_key string, page bigint, params_json string, status string, attempts int, result_count bigint, total_results bigint, last_error string, updated_at bigint"
ITEMS = "id string, first_seen_search_key string, first_seen_page bigint, status string, attempts int, last_error string, last_http_status int, updated_at bigint"
SEARCH_ITEMS = "search_key string, page bigint, id string"
RECORDS = "id string, json string, fetched_at bigint"
TABLES = {"meta": META, "search_pages": SEARCH_PAGES, "items": ITEMS, "search_items": SEARCH_ITEMS, "records": RECORDS}

PARAMS = (
    "base_url string, query string, catalogs array<string>, access array<string>, publishyear_prev string, "
    "publishyear_next string, sort_by string, `order` string, extra array<array<string>>"
)
LINK = "struct<text:string,href:string>"
DETAIL = f"struct<label:string,value:string,links:array<{LINK}>>"
CARD = (
    "title string, authors array<string>, year string, bibliographic_description string, description string, "
    f"detail array<{DETAIL}>, detail_map map<string,array<string>>, topics array<string>, pdf_links array<string>, og map<string,string>"
)
MARC = (
    "raw_xml string, leader string, control_fields array<struct<tag:string,value:string>>, "
    "data_fields array<struct<tag:string,ind1:string,ind2:string,subfields:array<struct<code:string,value:string>>>>, "
    "pdf_links array<string>"
)
