"""Registered catalogue queries and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions import scalars
from harrow.operators import coverage, export, extract, flatten, planner, requests, state
from harrow.plans.relations import relation, with_relations
from harrow.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
WINDOW = 450
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLES[f.__name__] = with_relations(oracle)
        return f

    return add


_SHARDS = """shards as (
  select p.search_key, min(params_json) as params_json, count(*) as pages,
         count(*) filter (where status = 'done') as done_pages, count(*) filter (where status = 'pending') as pending_pages,
         count(*) filter (where status = 'in_progress') as in_progress_pages, count(*) filter (where status = 'failed') as failed_pages,
         count(*) filter (where status = 'done' and result_count = 0) as empty_done_pages,
         cast(coalesce(sum(result_count) filter (where status = 'done'), 0) as bigint) as discovered,
         coalesce(arg_max(total_results, page) filter (where status = 'done' and result_count > 0 and total_results is not null), max(total_results)) as total,
         max(page) filter (where status = 'done') as max_done_page, any_value(coalesce(u.n, 0)) as unique_items
  from d_search_pages p left join (select search_key, count(distinct id) as n from d_search_items group by search_key) u on p.search_key = u.search_key
  group by p.search_key)"""
_FLAGGED = (
    _SHARDS
    + f""", flagged as (
  select *, case when total is not null then greatest(total - discovered, 0) end as missing,
         pending_pages + in_progress_pages + failed_pages > 0 as unfinished, coalesce(total > discovered, false) as gap,
         coalesce(total > discovered, false) and discovered >= {WINDOW} as window_limited, empty_done_pages > 0 as ended_empty from shards)"""
)
_KEY = """regexp_replace(regexp_replace(params_json, ',"sort_by":(null|"[^"]*"),"order":(null|"[^"]*")', ''), '\\["(lang|idlibrary)","[^"]*"\\],?', '', 'g')"""
_GROUPS = (
    _FLAGGED
    + f""", keyed as (select *, {_KEY} as group_key from flagged), stored as (
  select group_key, count(distinct id) as n from d_search_items join keyed using (search_key) group by group_key), g as (
  select k.group_key, count(*) as shard_count, count(*) filter (where unfinished) as unfinished_shards, max(total) as total,
         greatest(coalesce(any_value(s.n), 0), max(discovered)) as unique_items, string_agg(search_key, ',' order by search_key) as search_keys
  from keyed k left join stored s on k.group_key = s.group_key group by k.group_key), groups as (
  select *, case when total is not null then greatest(total - unique_items, 0) end as missing, coalesce(total > unique_items, false) as gap from g)"""
)
_SHARD_COLUMNS = "search_key, params_json, pages, done_pages, pending_pages, in_progress_pages, failed_pages, empty_done_pages, discovered, total, max_done_page, unique_items, missing, unfinished, gap, window_limited, ended_empty"


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return relation(spark, sf_dir, "d_search_pages"), relation(spark, sf_dir, "d_search_items")


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.shard_coverage(*_pages(spark, sf_dir))


@_query(f"with {_FLAGGED} select {_SHARD_COLUMNS} from flagged")
def coverage_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.flagged(_shards(spark, sf_dir), WINDOW)


@_query(f"with {_FLAGGED} select {_SHARD_COLUMNS} from flagged where search_key = 'k000003'")
def coverage_one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.flagged(_shards(spark, sf_dir), WINDOW).filter(F.col("search_key") == "k000003")


@_query(f"with {_GROUPS} select group_key, shard_count, unfinished_shards, total, unique_items, search_keys, missing, gap from groups")
def coverage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, members = _pages(spark, sf_dir)
    return coverage.group_coverage(coverage.shard_coverage(pages, members), members).drop("label")


@_query(
    f"""with {_GROUPS} select s.*, g.*, unfinished_groups = 0 and gap_groups = 0 as ok from
    (select count(*) as shards, count(*) filter (where unfinished) as unfinished_shards, count(*) filter (where gap) as gap_shards,
            count(*) filter (where window_limited) as window_limited_shards, cast(coalesce(sum(missing), 0) as bigint) as per_query_missing from flagged) s,
    (select count(*) as groups, count(*) filter (where unfinished_shards > 0) as unfinished_groups, count(*) filter (where gap) as gap_groups,
            cast(coalesce(sum(missing), 0) as bigint) as grouped_missing from groups) g"""
)
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, members = _pages(spark, sf_dir)
    return coverage.coverage_summary(coverage.shard_coverage(pages, members), members, window_limit=WINDOW)


@_query(f"with {_FLAGGED} select search_key, missing, discovered from flagged where unfinished or gap order by coalesce(missing, 0) desc, discovered desc, search_key limit 50")
def coverage_top_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.suspicious_shards(_shards(spark, sf_dir), 50, window_limit=WINDOW).select("search_key", "missing", "discovered")


@_query(f"with {_GROUPS} select group_key, missing, unique_items from groups where unfinished_shards > 0 or gap order by coalesce(missing, 0) desc, unique_items desc, group_key limit 50")
def coverage_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, members = _pages(spark, sf_dir)
    return coverage.suspicious_groups(coverage.group_coverage(coverage.shard_coverage(pages, members), members)).select("group_key", "missing", "unique_items")


@_query(f"""with {_SHARDS} select search_key, discovered from shards where params_json like '%"catalogs":["30"]%' and params_json not like '%"publishyear_prev":null%'""")
def coverage_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.filter_shards(_shards(spark, sf_dir), ["30"], ["open"], True).select("search_key", "discovered")


@_query(
    f"""with {_SHARDS} select search_key, 'q="' || json_extract_string(params_json, '$.query') || '" catalog=' || json_extract_string(params_json, '$.catalogs[0]') || ' access=open'
    || coalesce(' year=' || json_extract_string(params_json, '$.publishyear_prev'), '')
    || coalesce(' sort=' || json_extract_string(params_json, '$.sort_by') || ':' || json_extract_string(params_json, '$.order'), '')
    || case when params_json like '%"lang"%' then ' extra=lang=xx,z=1' else ' extra=z=1' end as label from shards"""
)
def shard_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shards(spark, sf_dir).select("search_key", scalars.shard_label(F.col("params_json")).alias("label"))


@_query(f"with {_FLAGGED} select search_key, concat_ws(',', case when unfinished then 'unfinished' end, case when gap then 'gap' end, case when window_limited then 'window-limit' end) as flags from flagged")
def shard_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.flagged(_shards(spark, sf_dir), WINDOW).select("search_key", coverage.flags_text().alias("flags"))


_LABEL = """('q="' || json_extract_string({0}, '$.query') || '" catalog=' || json_extract_string({0}, '$.catalogs[0]') || ' access=open'
    || coalesce(' year=' || json_extract_string({0}, '$.publishyear_prev'), '')
    || coalesce(' sort=' || json_extract_string({0}, '$.sort_by') || ':' || json_extract_string({0}, '$.order'), '')
    || case when {0} like '%"lang"%' then ' extra=lang=xx,z=1' else ' extra=z=1' end)"""
_SOME = "coalesce('Some(' || {0} || ')', 'None')"


@_query(
    f"""with {_GROUPS}, labelled as (select *, {_LABEL.format('params_json')} as label from flagged),
    grouped as (select g.*, {_LABEL.format('g.group_key')} as label from groups g)
    select '  ' || search_key || ' | ' || label || ' | pages=' || pages || ' done=' || done_pages || ' pending=' || pending_pages || ' in_progress=' || in_progress_pages || ' failed=' || failed_pages
      || ' discovered=' || discovered || ' unique=' || unique_items || ' total=' || {_SOME.format('total')} || ' missing=' || coalesce(missing, 0) || ' max_done_page=' || {_SOME.format('max_done_page')}
      || coalesce(' flags=' || nullif(concat_ws(',', case when unfinished then 'unfinished' end, case when gap then 'gap' end, case when window_limited then 'window-limit' end), ''), '') as line
    from labelled
    union all select '  ' || group_key || ' | ' || label || ' | shards=' || shard_count || ' unfinished=' || unfinished_shards || ' unique=' || unique_items
      || ' total=' || {_SOME.format('total')} || ' missing=' || coalesce(missing, 0) || ' keys=' || search_keys from grouped"""
)
def coverage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, members = _pages(spark, sf_dir)
    shards = coverage.shard_coverage(pages, members)
    lines = coverage.flagged(shards, WINDOW).select(coverage.shard_line().alias("line"))
    return lines.unionAll(coverage.group_coverage(shards, members).select(coverage.group_line().alias("line")))


@_query("select status, count(*) as n from d_items group by status")
def status_counts_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.status_counts(relation(spark, sf_dir, "d_items"), "items")


@_query("select status, count(*) as n from d_search_pages group by status")
def status_counts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.status_counts(relation(spark, sf_dir, "d_search_pages"), "search_pages")


def _pivot_sql(prefix: str) -> str:
    known = ", ".join(f"count(*) filter (where status = '{s}') as {prefix}{s}" for s in state.STATUSES)
    names = ", ".join(f"'{s}'" for s in state.STATUSES)
    return f"{known}, count(*) filter (where status not in ({names})) as {prefix}other"


def _failed_sql(prefix: str, forbidden: str) -> str:
    return (
        f"count(*) filter (where status = 'failed' and attempts < 5) as {prefix}retryable, count(*) filter (where status = 'failed' and attempts >= 5) as {prefix}exhausted, "
        f"count(*) filter (where status = 'failed' and ({forbidden})) as {prefix}failed_403"
    )


_SUMMARY = (
    f"select r.*, i.*, p.* from (select count(*) as records from d_records) r, "
    f"(select {_pivot_sql('items_')}, {_failed_sql('items_', "last_http_status = 403 or last_error ilike '%HTTP 403%'")} from d_items) i, "
    f"(select {_pivot_sql('pages_')}, {_failed_sql('pages_', "last_error ilike '%HTTP 403%'")} from d_search_pages) p"
)
_UNFINISHED = "items_pending + items_in_progress + items_retryable + pages_pending + pages_in_progress + pages_retryable"


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.completion_summary(relation(spark, sf_dir, "d_items"), relation(spark, sf_dir, "d_search_pages"), relation(spark, sf_dir, "d_records"))


@_query(f"select {_pivot_sql('')} from d_items")
def status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.status_pivot(relation(spark, sf_dir, "d_items"))


@_query(_SUMMARY)
def completion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


@_query(f"select {_UNFINISHED} as unfinished from ({_SUMMARY}) s")
def unfinished_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.unfinished_work(_summary(spark, sf_dir)).select("unfinished")


@_query(f"select case when items_exhausted + pages_exhausted > 0 then 'failed' when {_UNFINISHED} = 0 then 'complete' else 'failed' end as verdict from ({_SUMMARY}) s")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.verdict(_summary(spark, sf_dir)).select("verdict")


@_query("select min(t) as first_at, max(t) as last_at from (select updated_at as t from d_search_pages union all select updated_at from d_items union all select fetched_at from d_records) x")
def time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.time_bounds(relation(spark, sf_dir, "d_search_pages"), relation(spark, sf_dir, "d_items"), relation(spark, sf_dir, "d_records"))


@_query("select last_http_status, count(*) as n from d_items where status = 'failed' group by last_http_status")
def failed_by_http_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.failed_by_http_status(relation(spark, sf_dir, "d_items"))


@_query("select * from d_items where status = 'failed' order by attempts desc, updated_at desc, id limit 50")
def failed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.failed_sample(relation(spark, sf_dir, "d_items"))


@_query("select count(*) as backlog from d_items where status in ('pending', 'in_progress') or (status = 'failed' and attempts < 5)")
def item_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.backlog(relation(spark, sf_dir, "d_items"))


@_query("select search_key, min(page) as page from d_search_pages where status in ('pending', 'failed') and attempts < 5 group by search_key")
def next_page_per_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.next_pages(relation(spark, sf_dir, "d_search_pages"))


@_query("select id from d_items where status in ('pending', 'failed') and attempts < 5 order by updated_at, id limit 100")
def claim_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.claim_batch(relation(spark, sf_dir, "d_items"), 100)


@_query("select id, row_number() over (partition by first_seen_search_key order by updated_at, id) as turn from d_items where status in ('pending', 'failed') and attempts < 5")
def ranked_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.ranked_claims(relation(spark, sf_dir, "d_items")).select("id", F.col("turn").cast("long"))


def _changed(condition: str, **changes: str) -> str:
    names = ["id", "first_seen_search_key", "first_seen_page", "status", "attempts", "last_error", "last_http_status", "updated_at"]
    return "select " + ", ".join(f"case when {condition} then {changes[n]} else {n} end as {n}" if n in changes else n for n in names) + " from d_items"


_NOW = 1800000000
_CLEARED = {"status": "'pending'", "attempts": "0", "last_error": "null", "last_http_status": "null", "updated_at": str(_NOW)}


@_query(_changed("status = 'failed'", **_CLEARED))
def retry_failed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.retry_failed(relation(spark, sf_dir, "d_items"), F.lit(_NOW))


@_query(_changed("status = 'failed' and coalesce(last_http_status = 403 or last_error ilike '%HTTP 403%', false)", **_CLEARED))
def retry_failed_403(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.retry_failed(relation(spark, sf_dir, "d_items"), F.lit(_NOW), 403)


@_query(_changed("status = 'in_progress'", status="'pending'", updated_at=str(_NOW)))
def reset_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.reset_interrupted(relation(spark, sf_dir, "d_items"), F.lit(_NOW))


def _busy() -> Column:
    return F.col("status") == "in_progress"


@_query(_changed("status = 'pending'", status="'in_progress'", attempts="attempts + 1", last_error="null", last_http_status="null", updated_at=str(_NOW)))
def start_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.start(relation(spark, sf_dir, "d_items"), F.col("status") == "pending", F.lit(_NOW))


@_query(_changed("status = 'in_progress'", status="'pending'", attempts="greatest(attempts - 1, 0)", last_error="'card HTTP 502'", last_http_status="502", updated_at=str(_NOW)))
def defer_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.defer(relation(spark, sf_dir, "d_items"), _busy(), F.lit("card HTTP 502"), F.lit(_NOW), F.lit(502))


@_query(_changed("status = 'in_progress'", status="'failed'", last_error="'card HTTP 400'", last_http_status="400", updated_at=str(_NOW)))
def fail_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.fail(relation(spark, sf_dir, "d_items"), _busy(), F.lit("card HTTP 400"), F.lit(_NOW), F.lit(400))


@_query(_changed("status = 'in_progress'", status="'missing'", last_error="'card HTTP 404'", last_http_status="404", updated_at=str(_NOW)))
def mark_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.mark_missing(relation(spark, sf_dir, "d_items"), _busy(), F.lit("card HTTP 404"), F.lit(_NOW))


@_query(
    """select id, arg_min(search_key, search_key || lpad(cast(page as string), 9, '0')) as first_seen_search_key, arg_min(page, search_key || lpad(cast(page as string), 9, '0')) as first_seen_page
    from d_search_items where 'item-' || lpad(cast(cast(substr(id, 6) as bigint) as string), 12, '0') not in (select id from d_items where status = 'done') group by id"""
)
def enqueue_new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of search pages as new items, where items that share their number and are done count as known."""
    found = relation(spark, sf_dir, "d_search_items").withColumn("seq", F.concat("search_key", F.lpad(F.col("page").cast("string"), 9, "0")))
    known = relation(spark, sf_dir, "d_items").filter("status = 'done'").select(F.concat(F.lit("part-"), F.substring("id", 9, 9)).alias("id"))
    return state.new_items(known, found)


@_query("select search_key, page, id from d_search_items union select first_seen_search_key, first_seen_page, id from d_items where first_seen_search_key is not null and first_seen_page is not null")
def membership_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.backfill_members(relation(spark, sf_dir, "d_search_items"), relation(spark, sf_dir, "d_items"))


_OUTCOME = "case when http_status is null or http_status >= 500 then 'transient' when http_status = 403 then 'forbidden' when http_status = 404 then 'missing' when http_status between 200 and 299 then 'ok' else 'failed' end"


@_query(f"select seq, {_OUTCOME} as outcome from d_requests")
def classify_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_requests").select("seq", requests.outcome(F.col("http_status")).alias("outcome"))


_MARKED = f"""o as (select seq, {_OUTCOME} as outcome from d_requests), isles as (select seq, outcome,
  count(*) filter (where outcome = 'ok') over w as a, count(*) filter (where outcome <> 'forbidden') over w as b, count(*) filter (where outcome = 'transient') over w as c from o window w as (order by seq))"""
_STREAKS = f"""{_MARKED}, streaks as (select seq, outcome, count(*) filter (where outcome = 'transient') over (partition by a order by seq) as transient_streak,
  count(*) filter (where outcome = 'forbidden') over (partition by b order by seq) as forbidden_streak, count(*) filter (where outcome = 'ok') over (partition by c order by seq) as success_streak from isles)"""


@_query(f"with {_STREAKS} select seq, outcome, transient_streak, forbidden_streak from streaks")
def error_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.error_streaks(relation(spark, sf_dir, "d_requests")).select("seq", "outcome", "transient_streak", "forbidden_streak")


@_query(f"with {_STREAKS} select seq, success_streak from streaks")
def success_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.success_streaks(relation(spark, sf_dir, "d_requests")).select("seq", "success_streak")


@_query(
    f"""with {_STREAKS} select seq, case when outcome = 'transient' and transient_streak % 3 = 0 then 'transient' else 'forbidden' end as pause from streaks
    where (outcome = 'transient' and transient_streak % 3 = 0) or (outcome = 'forbidden' and forbidden_streak % 2 = 0)"""
)
def bursts_403(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.with_pauses(requests.error_streaks(relation(spark, sf_dir, "d_requests")), 3, 2).filter("pause is not null").select("seq", "pause")


@_query(
    """with s as (select worker_id, seq, epoch(ts) as sec, coalesce(http_status, 0) % 7 as value from d_requests), n as (
      select *, coalesce(lead(sec) over (partition by worker_id order by sec, seq), 1800000000) - sec as span from s)
    select worker_id, coalesce(sum(value * span) / nullif(sum(span), 0), arg_max(value, sec)) as average, min(value) as least, max(value) as most from n group by worker_id"""
)
def worker_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    steps = relation(spark, sf_dir, "d_requests").select("worker_id", "seq", at.alias("at"), (F.coalesce("http_status", F.lit(0)) % 7).alias("value"))
    return requests.usage(steps, "worker_id", F.lit(1800000000.0)).drop("final")


@_query(
    """with f as (select search_key, page, count(distinct id) as found from d_search_items group by all), n as (
      select search_key, page, count(*) as fresh from (select search_key, id, min(page) as page from d_search_items group by all) group by all), j as (
      select f.search_key, f.page, found, coalesce(fresh, 0) as fresh from f left join n on f.search_key = n.search_key and f.page = n.page), i as (
      select *, sum(case when fresh > 0 then 1 else 0 end) over (partition by search_key order by page) as isle from j)
    select search_key, page, found, fresh, cast(sum(case when found > 0 and fresh = 0 then 1 else 0 end) over (partition by search_key, isle order by page) as bigint) as known_streak from i"""
)
def known_page_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.known_page_streaks(requests.page_freshness(relation(spark, sf_dir, "d_search_items")))


_SPEC = planner.SearchSpec("https://catalog.test", "q0", ("25",), ("open",), "1900", "1950", extra=(("z", "1"),))
_YEAR_JSON = """'{"base_url":"https://catalog.test","query":"q0","catalogs":["25"],"access":["open"],"publishyear_prev":' || a || ',"publishyear_next":' || a || ',"sort_by":' || s || ',"order":' || o || ',"extra":[["z","1"]]}'"""


@_query(
    f"""select label, {_YEAR_JSON} as params_json, max_pages, stop_after_known_pages from (
      select 'year ' || y as label, '"' || y || '"' as a, 'null' as s, 'null' as o, cast(null as bigint) as max_pages, cast(null as bigint) as stop_after_known_pages from (select cast(unnest(range(1900, 1951)) as string) as y)
      union all select 'no-year prefix sort document_publishyearsort:asc', 'null', '"document_publishyearsort"', '"asc"', 666, 5) j"""
)
def year_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.initial_jobs(spark, _SPEC, planner.PlannerConfig(shard_years=True)).drop("search_key")


_OVER = f"""{_GROUPS}, over as (select k.*, json_extract_string(params_json, '$.publishyear_prev') as year from keyed k join groups g using (group_key)
  where not k.unfinished and k.ended_empty and k.gap and g.gap and g.unfinished_shards = 0 and json_extract_string(params_json, '$.publishyear_prev') = json_extract_string(params_json, '$.publishyear_next'))"""
_SORTS = ", ".join(f"('{f}', '{o}')" for f, o in planner.DEFAULT_SORTS)
_SORT_VARIANTS = f"""{_OVER}, variants as (select search_key as source, 'year ' || year || ' auto overflow sort ' || f || ':' || o as label,
  regexp_replace(params_json, '"sort_by":(null|"[^"]*"),"order":(null|"[^"]*")', '"sort_by":"' || f || '","order":"' || o || '"') as params_json
  from over, (values {_SORTS}) v(f, o) where params_json not like '%"sort_by":"' || f || '","order":"' || o || '"%')"""


def _overflowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.overflowing(*_pages(spark, sf_dir), coverage.FACETS, WINDOW)


@_query(f"with {_SORT_VARIANTS} select * from variants")
def sort_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.sort_variants(_overflowing(spark, sf_dir), planner.DEFAULT_SORTS)


def _facet_values(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("lang", "ru"), ("lang", "en"), ("idlibrary", "7")], "field string, value string")


@_query(
    f"""with {_OVER} select search_key as source, 'year ' || year || ' auto overflow facet z=1 ' || f || '=' || v as label,
      replace(regexp_replace(params_json, '"sort_by":(null|"[^"]*"),"order":(null|"[^"]*")', '"sort_by":null,"order":null'), ']]}}', '],["' || f || '","' || v || '"]]}}') as params_json
      from over, (values ('lang', 'ru'), ('lang', 'en'), ('idlibrary', '7')) t(f, v) where params_json not like '%[["lang"%'"""
)
def facet_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _overflowing(spark, sf_dir).filter(~F.col("params_json").contains('[["lang"'))
    return planner.facet_variants(plain, _facet_values(spark), coverage.FACETS, 2)


_FNV = """lower(lpad(printf('%x', list_reduce(list_prepend(14695981039346656037::hugeint, list_transform(string_split(params_json, ''), lambda c: ord(c)::hugeint)),
      lambda h, c: (xor((h)::ubigint, c::ubigint)::hugeint * 1099511628211) % 18446744073709551616)::ubigint), 16, '0'))"""
_KNOWN_YEAR = "1903"


@_query(
    f"""with {_SORT_VARIANTS}, narrowed as (
      select search_key as source, 'year ' || year || ' auto overflow facet ' || case when params_json like '%[["lang"%' then 'lang=xx z=1 ' else 'z=1 ' end || f || '=' || v as label,
        replace(regexp_replace(params_json, '"sort_by":(null|"[^"]*"),"order":(null|"[^"]*")', '"sort_by":null,"order":null'), ']]}}', '],["' || f || '","' || v || '"]]}}') as params_json
      from over, (values ('lang', 'ru'), ('lang', 'en'), ('idlibrary', '7')) t(f, v) where year = '{_KNOWN_YEAR}' and params_json not like '%"' || f || '"%'),
    jobs as (select {_FNV} as search_key, * from (select * from variants where label not like 'year {_KNOWN_YEAR} %' union all select * from narrowed) j)
    select search_key, j.label as label, j.source as source, j.params_json as params_json from (
      select search_key, min(struct_pack(label := label, source := source, params_json := params_json)) as j from jobs group by search_key) x"""
)
def overflow_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sortings for overflowing shards; facets for those of one year, whose sortings are all planned already."""
    planned = planner.sort_variants(_overflowing(spark, sf_dir).filter(F.col("year") == _KNOWN_YEAR), planner.DEFAULT_SORTS)
    known = planned.select(scalars.fnv1a64(F.col("params_json")).alias("search_key"))
    return planner.overflow_jobs(*_pages(spark, sf_dir), _facet_values(spark), planner.PlannerConfig(shard_years=True, window_limit=WINDOW), known)


@_query(
    f"""with {_GROUPS} select group_key, shard_count, unfinished_shards, total, unique_items, missing, gap, search_keys from groups
      where group_key = (select {_KEY} from d_search_pages where search_key = 'k000003' limit 1)"""
)
def group_of_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of one search's parameters, over all shards."""
    pages, members = _pages(spark, sf_dir)
    target = pages.filter("search_key = 'k000003'").select("params_json").first()[0]
    return coverage.group_for(coverage.shard_coverage(pages, members), members, target).select("group_key", "shard_count", "unfinished_shards", "total", "unique_items", "missing", "gap", "search_keys")


@_query(
    """select id, lower(lpad(printf('%x', list_reduce(list_prepend(14695981039346656037::hugeint, list_transform(string_split(id, ''), lambda c: ord(c)::hugeint)),
      lambda h, c: (xor((h)::ubigint, c::ubigint)::hugeint * 1099511628211) % 18446744073709551616)::ubigint), 16, '0')) as search_key from d_items"""
)
def search_key_fnv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_items").select("id", scalars.fnv1a64(F.col("id")).alias("search_key"))


@_query(
    """select id, case when n >= 1024 ** 3 then printf('%.1f GiB', n / 1073741824.0) when n >= 1048576 then printf('%.1f MiB', n / 1048576.0) when n >= 1024 then printf('%.1f KiB', n / 1024.0) else n || ' B' end as size
    from (select id, (updated_at - 1700000000) * (attempts * attempts * attempts) as n from d_items) t"""
)
def human_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("updated_at") - 1700000000) * (F.col("attempts") * F.col("attempts") * F.col("attempts"))
    return relation(spark, sf_dir, "d_items").select("id", scalars.human_bytes(n).alias("size"))


@_query("select id, strftime(to_timestamp(updated_at) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as at from d_items")
def rfc3339(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_items").select("id", scalars.rfc3339(F.col("updated_at")).alias("at"))


@_query("select id, case when length(raw_title) > 20 then left(raw_title, 20) || '...' else raw_title end as title from d_records")
def abbreviate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_records").select("id", scalars.abbreviate(F.col("raw_title"), 20).alias("title"))


@_query(
    """select search_key, page, 'https://catalog.test/search/?q=' || json_extract_string(params_json, '$.query') || '&c%5B%5D=' || json_extract_string(params_json, '$.catalogs[0]') || '&access%5B%5D=open'
    || coalesce('&publishyear_prev=' || json_extract_string(params_json, '$.publishyear_prev'), '') || coalesce('&publishyear_next=' || json_extract_string(params_json, '$.publishyear_next'), '')
    || coalesce('&by=' || json_extract_string(params_json, '$.sort_by'), '') || coalesce('&order=' || json_extract_string(params_json, '$.order'), '')
    || case when params_json like '%"lang"%' then '&lang=xx' else '' end || '&z=1' || case when page > 1 then '&PAGEN_1=' || page else '' end as url from d_search_pages"""
)
def search_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_search_pages").select("search_key", "page", scalars.search_url(F.col("params_json"), F.col("page")).alias("url"))


def _dm(label: str) -> str:
    return f"""json_extract_string(json, '$.metadata.detail_map."{label}"[0]')"""


@_query(
    f"""select id, json_extract_string(json, '$.metadata.title') as title, json_extract_string(json, '$.metadata.year') as year, cast(json_extract(json, '$.metadata.authors') as string) as authors_json,
    {_dm(flatten.CATALOG)} as catalog, {_dm(flatten.LIBRARY)} as library, {_dm(flatten.LANGUAGE)} as language, cast(null as string) as bibliographic_description, cast(null as string) as description,
    cast(json_extract(json, '$.metadata.topics') as string) as topics_json, cast(json_extract(json, '$.metadata.pdf_links') as string) as pdf_links_json,
    cast(json_array_length(json_extract(json, '$.metadata.pdf_links')) as bigint) as pdf_count, json_extract_string(json, '$.url') as url, fetched_at from d_record_json"""
)
def records_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.records_view(relation(spark, sf_dir, "d_record_json"))


@_query(
    f"""select id, nullif(json_extract_string(json, '$.metadata.title'), '') as title, cast(json_extract(json, '$.metadata.authors') as string) as authors_json, nullif(json_extract_string(json, '$.metadata.year'), '') as year,
    nullif({_dm(flatten.CATALOG)}, '') as catalog, nullif({_dm(flatten.LANGUAGE)}, '') as language, coalesce(nullif({_dm(flatten.PLACES[0])}, ''), nullif({_dm(flatten.PLACES[1])}, '')) as publication_place,
    nullif({_dm(flatten.PUBLISHER)}, '') as publisher, cast(json_extract(json, '$.metadata.pdf_links') as string) as pdf_links_json, cast(null as string) as detail_json,
    json_extract_string(json, '$.marc21.raw_xml') as marc_xml, json as record_json from d_record_json"""
)
def records_parquet_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.parquet_rows(relation(spark, sf_dir, "d_record_json"))


_LINKS = """'<a href="/catalog/' || raw_title || '/"></a><a href="/catalog/undefined/"></a><a href="/catalog/' || id || '?x">Найдено ' || cast(fetched_at % 1000 as string) || ' 514 результатов</a>'"""


@_query(
    f"""select id, array_to_string(case when split_part(split_part(split_part(split_part(raw_title, '/', 1), '"', 1), '?', 1), '#', 1) = '' then [id] else [split_part(split_part(split_part(split_part(raw_title, '/', 1), '"', 1), '?', 1), '#', 1), id] end, ',') as ids
    from d_records"""
)
def ids_from_html_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.expr(_LINKS)
    return relation(spark, sf_dir, "d_records").select("id", F.array_join(scalars.fallback_ids(html), ",").alias("ids"))


@_query("select id, cast(cast(fetched_at % 1000 as string) || '514' as bigint) as total from d_records")
def total_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_records").select("id", scalars.total_results(F.expr(_LINKS)).alias("total"))


@_query()
def card_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through the card parser."""
    return extract.card_rows(relation(spark, sf_dir, "d_records"))


@_query(
    """select id, 'T ' || fetched_at as title, case when fetched_at % 3 = 0 then null else 'A' || (fetched_at % 7) end as author, cast(1900 + fetched_at % 90 as string) as year, id || ' cited' as cited,
      'about ' || id as description, 't' || (fetched_at % 5) as topic, 'https://cards.test/f/' || id || '.pdf' as pdf, 'Город' as place, 'https://cards.test/p?n=' || (fetched_at % 4) as place_link, 2 as details,
      'T ' || fetched_at as og_title from d_records"""
)
def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with every part that the parser reads, made of the pages' keys; a third name no author."""
    row = lambda label, inner: f"""'<div class="cards-table__row"><div class="cards-table__left">{label}</div><div class="cards-table__right">', {inner}, '</div></div>'"""
    place = """concat('<a href="/p?n=', fetched_at % 4, '">Город</a>')"""
    html = f"""concat('<html><head><meta property="og:title" content="T ', fetched_at, '"><meta property="book:release_date" content="', 1900 + fetched_at % 90, '"><meta name="description" content="about ', id, '"></head><body>',
      case when fetched_at % 3 = 0 then '' else concat('<i itemprop="author">A', fetched_at % 7, '</i>') end, '<p id="toClipBoard">', id, ' cited</p><div class="cards-section"><h2>Детальная информация</h2><div class="cards-table">',
      {row("Тематика", "concat('t', fetched_at % 5)")}, {row("Место издания", place)}, '</div></div><a href="/f/', id, '.pdf">PDF</a></body></html>')"""
    pages = relation(spark, sf_dir, "d_records").select("id", F.expr(html).alias("html"), F.lit("https://cards.test/record/").alias("url"))
    at = lambda column: F.get(column, F.lit(0))
    return extract.card_rows(pages).select(
        "id", "title", at("authors").alias("author"), "year", F.col("bibliographic_description").alias("cited"), "description", at("topics").alias("topic"), at("pdf_links").alias("pdf"),
        at(F.col("detail_map")["Место издания"]).alias("place"), at(F.get(F.filter("detail", lambda d: d["label"] == "Место издания"), F.lit(0))["links"])["href"].alias("place_link"), F.size("detail").alias("details"),
        F.col("og")["title"].alias("og_title"),
    )


@_query("""select id, trim(regexp_replace(replace(replace(replace(replace(raw_title, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) as title from d_records""")
def card_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages without meta tags and h1: the text of the title element."""
    bare = relation(spark, sf_dir, "d_records").withColumn("html", F.concat(F.lit("<title>"), "raw_title", F.lit("</title>")))
    return extract.card_rows(bare).select("id", F.coalesce("title", F.lit("")).alias("title"))


@_query("select id, concat('s', fetched_at % 9) as topic, case when fetched_at % 5 = 0 then null else id || '.pdf' end as pdf from d_records where fetched_at % 7 <> 0")
def marc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MARC records made of the pages: a seventh of them malformed, a fifth without a link."""
    xml = """concat('<?xml version="1.0"?><marc:record xmlns:marc="http://m"><marc:leader>1</marc:leader><marc:datafield tag="650"><subfield code="a">s', fetched_at % 9,
      '</subfield></marc:datafield>', case when fetched_at % 5 = 0 then '' else concat('<marc:datafield tag="856"><marc:subfield code="u">', id, '.pdf</marc:subfield></marc:datafield>') end,
      case when fetched_at % 7 = 0 then '<broken' else '</marc:record>' end)"""
    made = extract.marc_rows(relation(spark, sf_dir, "d_records").select("id", F.expr(xml).alias("xml")))
    return made.filter("marc_error is null").select("id", F.get("marc_topics", F.lit(0)).alias("topic"), F.get("pdf_links", F.lit(0)).alias("pdf"))


@_query("""select id, '{"access":true,"n":' || fetched_at || '}' as viewer from d_records""")
def viewer_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.expr("""concat('{"access": true, "token": "t", "n": ', fetched_at, ', "viewer": {"a": 1}}')""")
    return relation(spark, sf_dir, "d_records").select("id", extract.viewer_column(body).alias("viewer"))


@_query("select id, 'v' || (fetched_at % 13) as lang from d_records")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.expr("""concat('<div data-id="lang" data-value=" v', fetched_at % 13, ' "></div><div data-id="lang" data-value=""></div><div data-id="other" data-value="x"></div>')""")
    values = extract.facets_column(html, ["lang", "idlibrary"])
    return relation(spark, sf_dir, "d_records").select("id", F.array_join(values["lang"], ",").alias("lang"))


@_query("select id, case when fetched_at % 13 = fetched_at % 3 then 2 else 3 end as n_values from d_records")
def facet_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many distinct values all wanted facets of a page offer."""
    html = F.expr("""concat('<p data-id="lang" data-value="v', fetched_at % 13, '"/><p data-id="lang" data-value="v', fetched_at % 3, '"/><p data-id="idlibrary" data-value="7"/><p data-id="z" data-value="1"/>')""")
    return relation(spark, sf_dir, "d_records").select("id", extract.facet_value_count(extract.facets_column(html, ["lang", "idlibrary"])).cast("int").alias("n_values"))


@_query("select id, fetched_at % 7 = 0 as failed, case when fetched_at % 7 = 0 then null else 'n' || (fetched_at % 4) end as leader from d_records")
def marc_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed MARC texts give an error beside the other fields and do not stop the rest."""
    xml = """concat('<m:record xmlns:m="urn:m"><m:leader>n', fetched_at % 4, '</m:leader>', case when fetched_at % 7 = 0 then '<m:field' else '</m:record>' end)"""
    made = extract.marc_rows(relation(spark, sf_dir, "d_records").select("id", F.expr(xml).alias("xml")))
    return made.select("id", F.col("marc_error").isNotNull().alias("failed"), F.col("leader"))


@_query("select search_key, page, id from d_search_items where page % 5 <> 0 or cast(right(id, 1) as int) % 2 = 0")
def replaced_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth page is read again and shows only ids with an even number."""
    members = relation(spark, sf_dir, "d_search_items")
    again = members.filter("page % 5 = 0")
    return state.replace_members(members, again.select("search_key", "page").distinct(), again.filter("cast(right(id, 1) as int) % 2 = 0"))


@_query("select worker_id, max(seq) as seq, arg_max(coalesce(http_status, 0), seq) as http_status from d_requests group by worker_id")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each key, as an upsert leaves it."""
    log = relation(spark, sf_dir, "d_requests").select("worker_id", "seq", F.coalesce("http_status", F.lit(0)).alias("http_status"))
    return state.latest(log, "worker_id", "seq")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "d_record_json")


@_query("select json as value from d_record_json")
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_folder(spark)}/jsonl-{uuid.uuid4().hex}"
    export.jsonl_folder(_records(spark, sf_dir), at)
    return spark.read.text(at)


@_query("select id, json as record_json from d_record_json")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_folder(spark)}/flat-{uuid.uuid4().hex}"
    export.parquet(_records(spark, sf_dir), at)
    return spark.read.parquet(at).select("id", "record_json")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
