"""Relations of the catalogue state derived from the star-schema tables, as portable SQL.

The same text feeds Spark and the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

D_ITEMS = """
select concat('item-', lpad(cast(o_orderkey as string), 12, '0')) as id,
       case when o_orderkey % 29 = 0 then null else concat('k', lpad(cast(o_custkey % 100 as string), 6, '0')) end as first_seen_search_key,
       case when o_orderkey % 29 = 0 then null else o_orderkey % 20 + 1 end as first_seen_page,
       case when o_orderkey % 97 = 0 then 'in_progress'
            when o_orderkey % 89 = 0 then 'stalled'
            when o_orderkey % 11 = 0 then 'failed'
            when o_orderkey % 13 = 0 then 'missing'
            when o_orderkey % 5 = 0 then 'pending'
            else 'done' end as status,
       o_orderkey % 7 as attempts,
       case when o_orderkey % 11 = 0 and o_orderkey % 3 = 0 then 'card http 403'
            when o_orderkey % 11 = 0 then concat('card HTTP ', cast(500 + o_orderkey % 4 as string))
            else null end as last_error,
       case when o_orderkey % 11 <> 0 or o_orderkey % 6 = 0 then null
            when o_orderkey % 3 = 0 then 403 else 500 + o_orderkey % 4 end as last_http_status,
       1700000000 + (o_orderkey * 7919) % 86400 as updated_at
from orders"""

# Searches of the years 1903 and 1907 are finished and found more than they show, so they overflow.
D_SEARCH_PAGES = """
select concat('k', lpad(cast(sk as string), 6, '0')) as search_key,
       pg + 1 as page,
       concat('{"base_url":"https://catalog.test","query":"q', cast(sk - sk % 100 as string),
              '","catalogs":["', case when sk % 10 = 9 then '30' else '25' end, '"],"access":["open"]',
              case when sk % 25 = 24 then ',"publishyear_prev":null,"publishyear_next":null'
                   else concat(',"publishyear_prev":"', cast(1900 + sk % 25 as string), '","publishyear_next":"', cast(1900 + sk % 25 as string), '"') end,
              case when sk % 4 = 1 then ',"sort_by":"document_titlesort","order":"asc"'
                   when sk % 4 = 2 then ',"sort_by":"document_titlesort","order":"desc"'
                   else ',"sort_by":null,"order":null' end,
              case when sk % 4 = 3 then ',"extra":[["lang","xx"],["z","1"]]}' else ',"extra":[["z","1"]]}' end) as params_json,
       case when sk % 25 in (3, 7) then 'done'
            when (sk + pg) % 19 = 0 and sk % 3 = 0 then 'failed'
            when (sk + pg) % 23 = 0 and sk % 5 = 0 then 'pending'
            else 'done' end as status,
       (sk + pg) % 6 as attempts,
       case when pg = 19 then 0 else n end as result_count,
       case when pg = 19 and sk % 2 = 0 then null else 400 + sk % 300 + pg % 3 + case when sk % 25 in (3, 7, 24) then 50000 else 0 end end as total_results,
       case when (sk + pg) % 19 = 0 and sk % 3 = 0 and sk % 25 not in (3, 7) then 'search page HTTP 403' else null end as last_error,
       1700000000 + (sk * 131 + pg * 17) % 86400 as updated_at
from (select l_suppkey as sk, l_partkey % 20 as pg, count(distinct l_partkey) as n from lineitem group by l_suppkey, l_partkey % 20) g"""

D_SEARCH_ITEMS = """
select distinct concat('k', lpad(cast(l_suppkey as string), 6, '0')) as search_key, l_partkey % 20 + 1 as page,
       concat('part-', lpad(cast(l_partkey as string), 9, '0')) as id
from lineitem where l_partkey % 20 <> 19"""

D_REQUESTS = """
select event_id as seq, user_id % 8 + 1 as worker_id, ts,
       case when event_type = 'error' and event_id % 5 = 0 then 403
            when event_type = 'error' and event_id % 7 = 0 then 404
            when event_type = 'error' and event_id % 3 = 0 then null
            when event_type = 'error' then 503 else 200 end as http_status
from events"""

D_RECORDS = """
select concat('rec-', lpad(cast(page_id as string), 9, '0')) as id, url, html,
       regexp_extract(html, '<title>([^<]*)</title>', 1) as raw_title,
       1700000000 + page_id as fetched_at
from pages"""

# A record's JSON text, with a title, authors, a year and a detail map of catalogue labels.
D_RECORD_JSON = """
select id, fetched_at,
       concat('{"id":"', id, '","url":"', url, '","fetched_at":"2023-11-14T22:13:20Z","metadata":{"title":"', case when fetched_at % 7 = 0 then '' else id end,
              '","authors":["A', cast(fetched_at % 5 as string), '","B"],"year":', case when fetched_at % 6 = 0 then 'null' else concat('"', cast(1900 + fetched_at % 90 as string), '"') end,
              ',"detail_map":{"Каталог":["Книги"],"Язык":["', case when fetched_at % 4 = 0 then '' else 'rus' end, '"]',
              case when fetched_at % 3 = 0 then ',"Место издания":["Москва"]' when fetched_at % 3 = 1 then ',"Место публикации":["Казань"]' else '' end,
              ',"Издательство":["Изд ', cast(fetched_at % 11 as string), '"]},"topics":["t1"],"pdf_links":["https://x.test/', id, '.pdf"]},"marc21":',
              case when fetched_at % 2 = 0 then '{"raw_xml":"<r/>"}' else 'null' end, '}') as json
from (select concat('rec-', lpad(cast(page_id as string), 9, '0')) as id, url, 1700000000 + page_id as fetched_at from pages) r"""

RELATIONS = {
    "d_items": (D_ITEMS, "orders"),
    "d_search_pages": (D_SEARCH_PAGES, "lineitem"),
    "d_search_items": (D_SEARCH_ITEMS, "lineitem"),
    "d_requests": (D_REQUESTS, "events"),
    "d_records": (D_RECORDS, "pages"),
    "d_record_json": (D_RECORD_JSON, "pages"),
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation over the Parquet tables of ``sf_dir``."""
    text, source = RELATIONS[name]
    table = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    braced = text.replace("{", "{{").replace("}", "}}").replace(f"from {source}", "from {source}")
    return spark.sql(braced, source=table)


def with_relations(sql: str) -> str:
    """Oracle SQL with the derived relations that it names as common table expressions."""
    used = [n for n in RELATIONS if n in sql]
    if not used:
        return sql
    heads = ", ".join(f"{n} as ({RELATIONS[n][0]})" for n in used)
    body = sql.strip()
    return f"with {heads}, {body[5:]}" if body.startswith("with ") else f"with {heads} {body}"
