"""Catalogue: urls, slugs, sentences, dates, html, paths, responses."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.functions import urls as ux
from gleaner.functions.dates import backfill_days, feed_published, query_stamps, range_days
from gleaner.functions.payloads import (
    chat_content, first_non_empty, parse_scores, parse_tier1, parse_tier3, write_outcome,
)
from gleaner.operators import predicates, reports
from gleaner.operators.cascade import extract_text
from gleaner.plans.registry import query
from gleaner.plans.views import ARXIV_ID_SQL, Tables, arxiv_like_id, with_views
from gleaner.sources.feeds import fetch_once
from gleaner.vocabulary import MIN_HTML_CHARS


@query(with_views("pages_v", body="select page_id, norm, left(sha256(norm), 10) as url_hash, host from pages_v"))
def url_normalise(t: Tables) -> DataFrame:
    return t.pages_v.select("page_id", "norm", ux.url_hash(F.col("url")).alias("url_hash"), "host")


@query(with_views("pages_v", body="""
select regexp_replace(norm, '[?#].*$', '') as item, min(page_id) as first_page, count(*) as n from pages_v group by 1"""))
def url_dedupe(t: Tables) -> DataFrame:
    bare = t.pages_v.select("page_id", F.regexp_replace("norm", r"[?#].*$", "").alias("item"))
    return bare.groupBy("item").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))


@query(with_views("pages_v", body="""
select page_id, host, left(sha256(host), 12) as robots_key from pages_v"""))
def fetch_hosts_once(t: Tables) -> DataFrame:
    def work(hosts: DataFrame) -> DataFrame:
        return hosts.withColumn("robots_key", F.substring(F.sha2("host", 256), 1, 12))

    return fetch_once(t.pages_v.select("page_id", "host"), "host", work)


# the given pages have public hosts only: every eighth of them gets a literal address or another scheme
_POLICY_URL = """case page_id % 12 when 1 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://10.1.2.3:8080')
 when 2 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://127.0.0.1') when 3 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://169.254.7.7')
 when 4 then regexp_replace(url, '^https?', 'ftp') when 5 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://172.20.0.9')
 when 6 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://172.40.0.9') when 7 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://230.0.0.1')
 when 8 then regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://localhost') else url end"""


@query(f"""
with p as (select page_id, {_POLICY_URL} as url, length(html) as n_bytes,
  case when page_id % 9 = 0 then 404 when page_id % 13 = 0 then null else 200 end as status,
  case when page_id % 7 = 0 then 'application/pdf' else 'Text/HTML; charset=utf-8' end as content_type from pages)
select page_id, case page_id % 12 when 1 then 'private' when 2 then 'loopback' when 3 then 'link_local' when 4 then 'scheme'
  when 5 then 'private' when 7 then 'multicast' when 8 then 'loopback' end as block_reason,
  case when status is null then 'network' when status >= 400 then 'http' when n_bytes > 4000 then 'oversize'
       when content_type = 'application/pdf' then 'content_type_mismatch' end as fetch_problem from p""")
def url_policy(t: Tables) -> DataFrame:
    crawl = t.pages.select(
        "page_id", F.expr(_POLICY_URL.replace("\\1", "$1")).alias("url"), F.length("html").alias("n_bytes"),
        F.expr("case when page_id % 9 = 0 then 404 when page_id % 13 = 0 then null else 200 end").alias("status"),
        F.expr("case when page_id % 7 = 0 then 'application/pdf' else 'Text/HTML; charset=utf-8' end").alias("ct"))
    return crawl.select(
        "page_id", ux.url_block_reason(F.col("url")).alias("block_reason"),
        predicates.fetch_problem(F.col("status"), F.col("ct"), F.col("n_bytes"), "html", 4000).alias("fetch_problem"))


SLUG_SQL = r"""regexp_replace(left(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 40), '-+$', '')"""


@query(with_views("cand_v", body=f"""+
s as (select item_id, {SLUG_SQL.format('title')} as slug from cand_v)
select item_id, slug, slug <> '' as valid, regexp_matches(item_id, '^[^/]+$') as safe_id from s"""))
def slugify_titles(t: Tables) -> DataFrame:
    return t.cand_v.select("item_id", tx.slugify(F.col("title")).alias("slug")).select(
        "item_id", "slug", tx.is_valid_slug(F.col("slug")).alias("valid"),
        tx.is_safe_item_id(F.col("item_id")).alias("safe_id"))


_SENTENCE = r"""left(regexp_replace(case when regexp_extract(abstract, '(?s)^(.*?[a-z]{2})[.!?](?:\s|$)', 1) <> ''
 then regexp_extract(abstract, '(?s)^(.*?[a-z]{2})[.!?](?:\s|$)', 1) else abstract end, '^\s+|\s+$', '', 'g'), 200)"""


@query(with_views("cand_v", body=rf"""+
s as (select item_id, {_SENTENCE} as sentence, regexp_replace(title, '^\s+|\s+$', '', 'g') as name,
  regexp_replace(abstract, '^\s+|\s+$', '', 'g') as body from cand_v)
select item_id, sentence, case when name <> '' then case when body = '' then name else name || ' ' || sentence end end as lookup_query from s"""))
def first_sentence(t: Tables) -> DataFrame:
    return t.cand_v.select(
        "item_id", tx.first_sentence(F.col("abstract")).alias("sentence"),
        tx.dedup_query(F.col("title"), F.col("abstract")).alias("lookup_query"))


@query(with_views("cand_v", body=r"""
select item_id, left(regexp_replace(array_to_string(list_concat([title], list_filter(list_transform(
  list_slice(string_split(abstract, chr(10)), 2, 4), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')), ' | '), '\s+', ' ', 'g'), 500) as retrieve_query
from cand_v"""))
def retrieve_query(t: Tables) -> DataFrame:
    lines = F.split("abstract", "\n")
    contributions = F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))
    return t.cand_v.select("item_id", tx.retrieve_query(F.col("title"), contributions).alias("retrieve_query"))


@query(f"""
with a as (select doc_id, {ARXIV_ID_SQL} as id, source from documents)
select doc_id, id as bare, 'https://arxiv.org/abs/' || id as canonical,
  case when doc_id % 4 = 0 then null else id || 'v2' end as from_url,
  case when doc_id % 5 = 0 then null when doc_id % 3 = 0 then id || 'v2' else source end as prior_title,
  case when doc_id % 5 = 0 then null else id || case when doc_id % 3 = 0 then 'v2' else '' end end as ref_id,
  case when doc_id % 4 = 0 then ' [blog.example.com]' else ' [arXiv ' || id || 'v2]' end as suffix from a""")
def arxiv_refs(t: Tables) -> DataFrame:
    a = t.documents.select("doc_id", "source", arxiv_like_id().alias("id"))
    raw = F.concat(F.lit("http://arxiv.org/abs/"), F.col("id"), F.lit("v"), (F.col("doc_id") % 30).cast("string"))
    url = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("https://u@Blog.example.com:8443/p/"), F.col("id"))).otherwise(
        F.concat(F.lit("https://arxiv.org/abs/"), F.col("id"), F.lit("v2?context=cs")))
    item = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("no reference "), F.col("id")))
        .when(F.col("doc_id") % 3 == 0, F.concat(F.lit("arXiv:"), F.col("id"), F.lit("v2")))
        .otherwise(F.concat(F.col("source"), F.lit(" (arXiv:"), F.col("id"), F.lit(")"))))
    ref = ux.arxiv_ref(item)
    return a.select(
        "doc_id", ux.arxiv_id(raw).alias("bare"), ux.arxiv_canonical_url(F.col("id")).alias("canonical"),
        ux.arxiv_id_from_url(url).alias("from_url"), ref["prior_title"].alias("prior_title"),
        ref["arxiv_id"].alias("ref_id"), ux.slug_suffix(url).alias("suffix"))


def _strip_sql(col: str) -> str:
    for tag in ("script", "iframe", "object", "embed"):
        col = rf"regexp_replace(regexp_replace({col}, '(?is)<{tag}\b[^>]*>.*?</{tag}>', '', 'g'), '(?i)<{tag}\b[^>]*>', '', 'g')"
    return col


@query(f"""
with s as (select page_id, {_strip_sql('html')} as stripped from pages),
c as (select page_id, stripped, regexp_replace(stripped, '<[^>]+>', '', 'g') as cleaned from s)
select page_id, md5(stripped) as stripped_md5, md5(cleaned) as cleaned_md5, length(cleaned) as n_chars,
  case when length(cleaned) < 1000 then 'too_short' end as problem from c""")
def strip_html(t: Tables) -> DataFrame:
    stripped = tx.strip_tags(F.col("html"))
    return t.pages.select("page_id", stripped.alias("stripped")).withColumn(
        "cleaned", tx.clean_fragments(F.col("stripped"))).select(
        "page_id", F.md5("stripped").alias("stripped_md5"), F.md5("cleaned").alias("cleaned_md5"),
        F.length("cleaned").alias("n_chars"),
        predicates.length_problem(F.col("cleaned"), MIN_HTML_CHARS).alias("problem"))


def _furniture_sql(col: str) -> str:
    for tag in ("style", "nav", "header", "footer", "aside", "form", "noscript", "template", "svg"):
        col = rf"regexp_replace({col}, '(?is)<{tag}\b[^>]*>.*?</{tag}>', '', 'g')"
    return col


@query(rf"""
with s as (select page_id, {_furniture_sql(_strip_sql("regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"))} as page from pages),
b as (select page_id, coalesce(nullif(regexp_extract(page, '(?is)<article\b[^>]*>(.*)</article>', 1), ''),
  nullif(regexp_extract(page, '(?is)<main\b[^>]*>(.*)</main>', 1), ''), nullif(regexp_extract(page, '(?is)<body\b[^>]*>(.*)</body>', 1), ''), page) as body from s),
x as (select page_id, regexp_replace(regexp_replace(body, '(?i)</(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|main|blockquote|pre|title)>|<br\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g') as txt from b),
e as (select page_id, replace(replace(replace(replace(replace(replace(txt, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') as txt from x),
f as (select page_id, regexp_replace(regexp_replace(regexp_replace(txt, '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g') as txt from e)
select page_id, case when length(txt) >= 1000 then md5(txt) end as text_md5, case when length(txt) >= 1000 then length(txt) end as n_chars,
  case when length(txt) >= 1000 then 'text:html' else 'text:abstract-only' end as text_tag,
  case when length(txt) < 1000 then 'too_short' end as extract_problem from f""")
def page_text(t: Tables) -> DataFrame:
    return extract_text(t.pages).select(
        "page_id", F.md5("extracted_text").alias("text_md5"), F.length("extracted_text").alias("n_chars"), "text_tag",
        "extract_problem")


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as published from orders")
def feed_dates(t: Tables) -> DataFrame:
    when = F.col("o_orderdate").cast("timestamp")
    rfc = F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss Z")
    iso = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ssXXX")
    # feeds write either form; every third of ours is ISO
    text = F.when(F.col("o_orderkey") % 3 == 0, iso).otherwise(rfc)
    return t.orders.select(
        "o_orderkey", F.date_format(feed_published(text), "yyyy-MM-dd HH:mm:ss").alias("published"))


_NOW = datetime(2024, 1, 29, 12, tzinfo=timezone.utc)


@query("select event_id, event_type from events where ts >= timestamp '2024-01-26 12:00:00'")
def lookback(t: Tables) -> DataFrame:
    return predicates.lookback(t.events_v, 3, _NOW, "ts").select("event_id", "event_type")


@query("""
with d as (select cast(day as date) as day from generate_series(date '2024-01-10', date '2024-01-16', interval 1 day) s(day)),
e as (select cast(ts as date) as day, count(*) as n from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-17' group by 1)
select strftime(d.day, '%Y-%m-%d') as day, coalesce(e.n, 0) as n, strftime(d.day, '%Y%m%d') || '0000' as first_stamp,
  strftime(d.day, '%Y%m%d') || '2359' as last_stamp from d left join e on d.day = e.day""")
def backfill_window(t: Tables) -> DataFrame:
    start, end = date(2024, 1, 10), date(2024, 1, 17)
    found = predicates.backfill_window(t.events_v, start, end, "ts").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    stamps = query_stamps(F.col("day"), F.date_add("day", 1))
    return backfill_days(t.spark, start, end).join(found, "day", "left").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("n"),
        stamps["first"].alias("first_stamp"), stamps["last"].alias("last_stamp"))


@query("""
with p as (select o_custkey as profile, greatest(date_diff('day', cast(o_orderdate as date), date '1995-06-17'), 0) as days,
  cast(o_orderkey % 5 as int) as n_categories, case when o_orderkey % 9 = 0 then null else 200 end as max_results from orders)
select profile, cast(sum(days * coalesce(n_categories, 0) * coalesce(max_results, 0)) as bigint) as estimate,
  sum(days * coalesce(n_categories, 0) * coalesce(max_results, 0)) > 1000 as confirm_required from p group by profile""")
def backfill_estimate(t: Tables) -> DataFrame:
    plans = t.orders.select(
        F.col("o_custkey").alias("profile"),
        range_days(F.to_date("o_orderdate"), F.lit(date(1995, 6, 17))).alias("days"),
        F.expr("cast(o_orderkey % 5 as int)").alias("n_categories"),
        F.when(F.col("o_orderkey") % 9 != 0, 200).alias("max_results"))
    return reports.backfill_estimate(plans).groupBy("profile").agg(F.sum("estimate").alias("estimate")).withColumn(
        "confirm_required", F.col("estimate") > reports.BACKFILL_CONFIRM_LIMIT)


@query(rf"""
with p as (select page_id, lower(regexp_extract(regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^.*@', ''), '^([^:]*)', 1)) as host,
   timestamp '2024-01-01' + to_days(cast(page_id % 400 as int)) as published from pages),
n as (select p.*, {SLUG_SQL.format('host')} as slug, strftime(published, '%Y/%m') as ym, strftime(published, '%Y-%m-%d') as day from p)
select page_id, 'rss/' || ym || '/' || slug || '-' || day || '-' || page_id || '.html' as archive_path,
  case when page_id % 2 = 0 then 'papers/arxiv/' || ym else 'articles/blog/' || ym end as note_path,
  case when page_id % 2 = 0 then year(published) end as year, case when page_id % 2 = 0 then month(published) end as month,
  case page_id % 4 when 0 then 'http' when 1 then 'oversize' when 2 then 'timeout' else 'archive_failed' end as kind from n""")
def archive_paths(t: Tables) -> DataFrame:
    p = t.pages_v.select(
        "page_id", "host", "url",
        F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(page_id % 400 as int))").alias("published"))
    item = F.concat_ws("-", tx.slugify(F.col("host")), F.date_format("published", "yyyy-MM-dd"), F.col("page_id"))
    path = tx.note_path(F.when(F.col("page_id") % 2 == 0, "arxiv").otherwise("rss"), F.lit("blog"), F.col("published"))
    error = F.expr("case page_id % 4 when 0 then 'HTTP 503 for x' when 1 then 'oversize: 9 bytes' when 2 then 'timeout' else '' end")
    when = tx.year_month_from_path(path)
    return p.select(
        "page_id", tx.archive_path(F.lit("rss"), F.col("published"), item, F.lit(".html")).alias("archive_path"),
        path.alias("note_path"), when["year"].alias("year"), when["month"].alias("month"),
        tx.download_kind(error).alias("kind"))


@query(with_views("pages_v", body=rf"""
select page_id, {SLUG_SQL.format("'Feed ' || host")} || '-' || strftime(timestamp '2024-01-01' + to_days(cast(page_id % 400 as int)), '%Y-%m-%d') || '-' || left(sha256(norm), 10) as item_id from pages_v"""))
def rss_item_ids(t: Tables) -> DataFrame:
    day = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(page_id % 400 as int))")
    return t.pages_v.select(
        "page_id", tx.rss_item_id(F.concat(F.lit("Feed "), F.col("host")), day, F.col("url")).alias("item_id"))


@query("""
with e as (select event_id, cast(json_extract_string(props, '$.k') as int) as k, event_type from events)
select event_id, case when event_id % 7 <> 0 and event_id % 11 <> 0 then event_type end as scored_id,
  case when event_id % 7 <> 0 and event_id % 11 <> 0 then cast(k as double) end as score,
  case when event_id % 7 <> 0 and event_id % 11 <> 0 then case when not (k between 1 and 10) then 'bad_score' when event_id % 5 = 0 then 'no_reason' end end as problem,
  k between 1 and 6 and event_id % 3 <> 0 as tier1_ok, k between 1 and 10 and event_id % 4 <> 0 as tier3_ok,
  case when event_id % 4 <> 0 and k between 1 and 10 then left('claim ' || event_type, 500) end as first_claim
from e""")
def parse_responses(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    result = F.struct(
        F.col("event_type").alias("id"), F.col("k").alias("score"), F.array(F.lit("a")).alias("tags"),
        F.when(F.col("event_id") % 5 != 0, F.lit("because")).alias("reason"))
    content = F.when(F.col("event_id") % 11 == 0, F.lit("not json {")).otherwise(
        F.to_json(F.struct(F.array(result).alias("results"))))
    chat = F.when(F.col("event_id") % 7 == 0, F.lit('{"choices": []}')).otherwise(
        F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"))))
    copies = F.transform(F.sequence(F.lit(1), F.least(F.greatest("k", F.lit(1)), F.lit(12))), lambda i: F.concat(F.lit("  claim "), F.col("event_type")))
    copies = F.when(F.col("k") >= 1, copies).otherwise(F.array().cast("array<string>"))
    tier1 = F.to_json(F.struct(
        copies.alias("contributions"), F.lit("m").alias("method"), F.lit("r").alias("result"),
        F.when(F.col("event_id") % 3 != 0, F.lit("v")).alias("relevance")))
    # every fourth answer carries a number where a string belongs
    tier3 = F.when(
        F.col("event_id") % 4 == 0, F.lit('{"claims": ["x", 7]}')).otherwise(F.to_json(F.struct(copies.alias("claims"))))
    parsed = e.select(
        "event_id", F.get(parse_scores(chat_content(chat)), F.lit(0)).alias("s"),
        parse_tier1(tier1).alias("t1"), parse_tier3(tier3).alias("t3"))
    problem = F.when(~F.col("s.score").between(1, 10), "bad_score").when(F.col("s.reason").isNull(), "no_reason")
    return parsed.select(
        "event_id", F.col("s.id").alias("scored_id"), F.col("s.score").alias("score"),
        F.when(F.col("s.id").isNotNull(), problem).alias("problem"),
        F.col("t1").isNotNull().alias("tier1_ok"), F.col("t3").isNotNull().alias("tier3_ok"),
        F.get("t3.claims", F.lit(0)).alias("first_claim"))


@query("""
select event_id,
  case event_id % 8 when 0 then 'created' when 1 then 'updated' when 2 then 'duplicate' when 3 then 'invalid_input'
    when 4 then 'slug_collision' when 5 then 'version_conflict' when 6 then 'content_too_large' else 'error' end as status,
  case event_id % 8 when 3 then 'bad ' || event_type when 4 then 'existing_id=' || user_id || '; Slug taken' when 5 then 'n' || user_id
    when 7 then event_type else '' end as detail,
  case when event_id % 8 in (0, 1) then 'n' || user_id else '' end as note_id,
  case when event_id % 8 = 7 then event_type else '' end as said from events""")
def write_status(t: Tables) -> DataFrame:
    body = F.expr("""case event_id % 8
      when 0 then concat('{"status":"created","note_id":"n', user_id, '"}')
      when 1 then concat('{"status":"updated","note_id":"n', user_id, '"}')
      when 2 then '{"status":"duplicate"}'
      when 3 then concat('{"status":"invalid_input","reason":"bad ', event_type, '"}')
      when 4 then concat('{"status":"slug_collision","existing_id":"', user_id, '","message":"Slug taken"}')
      when 5 then concat('{"status":"version_conflict","note_id":"n', user_id, '"}')
      when 6 then '{"status":"content_too_large"}'
      else concat('{"status":"error","reason":"","detail":7,"error":"', event_type, '"}') end""")
    out = write_outcome(F.col("body"))
    said = F.when(F.col("event_id") % 8 == 7, first_non_empty(F.col("body"))).otherwise("")
    return t.events.select("event_id", body.alias("body")).select(
        "event_id", out["status"].alias("status"), out["detail"].alias("detail"), out["note_id"].alias("note_id"),
        said.alias("said"))


@query("""
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '  ' || case event_type when 'error' then 'ERROR' else 'INFO' end
  || '  sweep' || '  ' || 'handled ' || event_type || '  [run_id=' || user_id || case when event_id % 2 = 0 then ', detail=' || props else '' end || ']' as line,
  'title=''' || event_type || '''' || case when event_id % 3 = 0 then ' author=''u' || user_id || '''' else '' end
  || ' ingested_by=' || case when event_id % 2 = 0 then 'gleaner' else '(no ingested-by tag)' end || ' tags=[''' || event_type || ''''
  || case when event_id % 2 = 0 then ', ''ingested-by:gleaner''' else '' end || ']' as preview,
  regexp_replace(left('a ' || event_type || ' b', 12), '\\s+', ' ', 'g') as short_line,
  case when value = floor(value) then cast(cast(value as bigint) as varchar) || '.0' else rtrim(printf('%.4f', round(value, 4)), '0') end as confidence
from events""")
def report_lines(t: Tables) -> DataFrame:
    e = t.events_v
    record = {
        "timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "level": F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), "logger": F.lit("sweep"),
        "message": F.concat(F.lit("handled "), F.col("event_type")), "run_id": F.col("user_id").cast("string"),
        "detail": F.when(F.col("event_id") % 2 == 0, F.col("props")),
    }
    tags = F.array_compact(F.array("event_type", F.when(F.col("event_id") % 2 == 0, "ingested-by:gleaner")))
    author = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return e.select(
        "event_id", tx.log_line(record).alias("line"),
        tx.doc_preview(F.col("event_type"), author, F.lit(None).cast("string"), tags).alias("preview"),
        tx.one_line(F.concat(F.lit("a\r\n "), F.col("event_type"), F.lit("\tb")), 12).alias("short_line"),
        tx.format_confidence(F.col("value")).alias("confidence"))
