"""Catalogue: feeds written as snapshots and read back, and the small ledgers a run appends to."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators import ledger
from gleaner.plans.registry import query
from gleaner.plans.views import Tables, with_views
from gleaner.session import checkpoint_dir
from gleaner.sinks import writers
from gleaner.sources import feeds, files
from gleaner.streaming import windows


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _number() -> Column:
    return F.col("doc_id").cast("string")


def _snapshot(rows: DataFrame, path: str, root: str, tag: str) -> None:
    rows.write.mode("append").format("xml").option("rootTag", root).option("rowTag", tag).save(path)


def _day(pattern: str) -> Column:
    """A day of January 2026 and an hour, from the document's number."""
    day = F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(cast(doc_id % 28 as int), cast(doc_id % 24 as int))")
    return F.date_format(day, pattern)


_DAY_SQL = "timestamp '2026-01-01' + to_days((doc_id % 28)::int) + to_hours((doc_id % 24)::int)"


@query(f"""select '26' || lpad((doc_id % 12 + 1)::varchar, 2, '0') || '.' || lpad(doc_id::varchar, 5, '0') as item_id,
  'Title ' || doc_id as title, 'About ' || source as abstract, strftime({_DAY_SQL}, '%Y-%m-%d %H') as published,
  case when doc_id % 3 = 0 then 'cs.AI|' || lang else lang end as categories from documents where doc_id % 7 <> 0""")
def atom_entries(t: Tables) -> DataFrame:
    """One Atom entry per document; those whose number seven divides have no summary and are no items."""
    path = _folder(t, "atom")
    ident = F.concat(F.lit("26"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0"), F.lit("."),
                     F.lpad(_number(), 5, "0"))
    terms = F.array_compact(F.array(F.when(F.col("doc_id") % 3 == 0, "cs.AI"), F.col("lang")))
    _snapshot(t.documents.select(
        F.concat(F.lit("http://arxiv.org/abs/"), ident, F.lit("v2")).alias("id"),
        F.concat(F.lit(" Title\n  "), _number()).alias("title"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit(" About "), F.col("source"), F.lit(" "))).alias("summary"),
        _day("yyyy-MM-dd'T'HH:00:00'Z'").alias("published"),
        F.transform(terms, lambda c: F.struct(c.alias("_term"))).alias("category")), path, "feed", "entry")
    return feeds.read_atom(t.spark, path).select(
        "item_id", "title", "abstract", F.date_format("published", "yyyy-MM-dd HH").alias("published"),
        F.array_join("categories", "|").alias("categories"))


@query(f"""select 'Post ' || doc_id as title, 'https://b.org/' || doc_id as source_url, 'rss' as source, 'blog' as source_tag,
  'My Feed' as feed_name, case when doc_id % 5 = 0 then '' else 'About ' || source end as abstract,
  strftime(case when doc_id % 4 = 0 then timestamp '2026-02-01' else {_DAY_SQL} end, '%Y-%m-%d %H') as published
from documents where doc_id % 11 <> 0""")
def rss_candidates(t: Tables) -> DataFrame:
    """Items and Atom entries in turn; one in eleven has no link, and every fourth no date that can be read."""
    path = _folder(t, "rss")
    url = F.concat(F.lit("https://b.org/"), _number())
    title = F.concat(F.lit(" Post "), _number(), F.lit(" ")).alias("title")
    about = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("About "), F.col("source")))
    undated, no_link = F.col("doc_id") % 4 == 0, F.col("doc_id") % 11 == 0
    _snapshot(t.documents.where("doc_id % 2 = 0").select(
        title, F.when(~no_link, url).alias("link"),
        F.when(undated, "some day").otherwise(_day("EEE, dd MMM yyyy HH:00:00 '+0000'")).alias("pubDate"),
        about.alias("description")), path, "channel", "item")
    links = F.array(F.struct(F.lit("self").alias("_rel"), F.lit("https://b.org/self").alias("_href")),
                    F.when(~no_link, F.struct(F.lit("alternate").alias("_rel"), url.alias("_href"))))
    _snapshot(t.documents.where("doc_id % 2 = 1").select(
        title, F.array_compact(links).alias("link"),
        F.when(~undated, _day("yyyy-MM-dd'T'HH:00:00'Z'")).alias("updated"), about.alias("summary")), path, "feed", "entry")
    of_feed = t.spark.read.text(path).select(F.col("_metadata.file_name").alias("file")).distinct().select(
        "file", F.lit("https://b.org/feed").alias("feed_url"), F.lit("blog").alias("source_tag"),
        F.lit("My Feed").alias("feed_name"))
    rows = feeds.read_rss(t.spark, path, of_feed, F.lit("2026-02-01 00:00:00").cast("timestamp"))
    return feeds.to_candidates(rows, "rss").select(
        "title", "source_url", "source", "source_tag", "feed_name", "abstract",
        F.date_format("published", "yyyy-MM-dd HH").alias("published"))


@query("""
with p as (select doc_id, unnest(range(0, 3)) as poll from documents),
s as (select doc_id, poll from p where doc_id % 3 <= poll)
select doc_id::varchar as item_id, doc_id % 10 >= 7 as late from (select distinct doc_id from s)""")
def stream_snapshots(t: Tables) -> DataFrame:
    """Three polls whose snapshots overlap: every item once; those older than the lookback come as a table of their own."""
    root = _folder(t, "polls")
    now = F.lit("2026-01-10 00:00:00").cast("timestamp")
    items = t.documents.select("doc_id", _number().alias("item_id"), F.expr(
        "timestamp'2026-01-10 00:00:00' - make_dt_interval(cast(doc_id % 10 as int) div 7 * 4)").alias("published"))
    for poll in range(3):
        items.where(F.col("doc_id") % 3 <= poll).select("item_id", "published").write.mode("append").json(f"{root}/in")
        stream = feeds.stream_candidates(t.spark, f"{root}/in", "item_id STRING, published TIMESTAMP")
        once = windows.stream_dedupe(stream, ["item_id"], "30 days")
        once.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(
            availableNow=True).start().awaitTermination()
    seen = t.spark.read.parquet(f"{root}/out")
    kept = windows.drop_late(seen, 3, now)
    late = seen.join(kept, "item_id", "left_anti")
    return kept.select("item_id", F.lit(False).alias("late")).unionByName(late.select("item_id", F.lit(True).alias("late")))


@query("""select 'p' || doc_id % 4 as profile, 'Title ' || doc_id as title, lang || '|' || source as tags from documents""")
def filter_tag_store(t: Tables) -> DataFrame:
    """Two appends; a tag counts once per item."""
    path = _folder(t, "tags")
    items = t.documents.select(
        "doc_id", F.concat(F.lit("p"), (F.col("doc_id") % 4).cast("string")).alias("profile"),
        F.concat(F.lit("Title "), _number()).alias("title"), F.array("lang", "source", "lang").alias("filter_tags"))
    for part in range(2):
        writers.append_filter_tags(items.where(F.col("doc_id") % 2 == part), path)
    return t.spark.read.parquet(path).select("profile", "title", F.array_join("tags", "|").alias("tags"))


@query("""select user_id::varchar as profile, event_id::varchar as run_id, event_type as detail from events where event_id % 3 = 0""")
def collision_log(t: Tables) -> DataFrame:
    """Only unresolved collisions are logged."""
    path = _folder(t, "collisions")
    writers.append_collisions(t.events.select(
        F.col("user_id").cast("string").alias("profile"), F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_id") % 3 == 0, "slug_collision").otherwise("created").alias("status"),
        F.col("event_type").alias("detail")), path)
    return files.read_collisions(t.spark, path).select("profile", "run_id", "detail")


@query(with_views("runs_v", body="select run_id, status from runs_v order by completed_at desc, run_id desc limit 50"))
def ledger_tail(t: Tables) -> DataFrame:
    return ledger.tail(t.runs_v, 50, ["completed_at", "run_id"]).select("run_id", "status")


@query(with_views("runs_v", body="""
select run_id, status from runs_v where run_id % 4 <> 0
union all select run_id, 'active' as status from runs_v where run_id % 4 = 0"""))
def all_runs(t: Tables) -> DataFrame:
    """Finished rows and those under way, which have fewer columns."""
    under_way = t.runs_v.where(F.col("run_id") % 4 == 0).select("run_id", "profile", F.lit("active").alias("status"))
    return ledger.all_runs(t.runs_v.where(F.col("run_id") % 4 != 0), under_way).select("run_id", "status")


@query("""
select doc_id::varchar as item_id, case when doc_id % 2 = 0 then 'arxiv' else 'rss' end as source,
  case when doc_id % 2 = 0 then 'https://arxiv.org/abs/' || doc_id else 'https://b.org/' || doc_id end as source_url
from documents""")
def union_sources(t: Tables) -> DataFrame:
    """Both kinds of source in their common form."""
    day = F.lit("2026-01-01 00:00:00").cast("timestamp").alias("published")
    papers = t.documents.where("doc_id % 2 = 0").select(
        _number().alias("item_id"), F.lit("T").alias("title"), F.col("text").alias("abstract"), day,
        F.array("lang").alias("categories"))
    posts = t.documents.where("doc_id % 2 = 1").select(
        F.concat(F.lit("https://b.org/"), _number()).alias("url"), F.lit("T").alias("title"), F.col("text").alias("summary"),
        day, F.lit("blog").alias("source_tag"), F.lit("My Feed").alias("feed_name"))
    both = feeds.union_sources(feeds.to_candidates(papers, "arxiv"), feeds.to_candidates(posts, "rss"))
    return both.select(
        F.when(F.col("source") == "arxiv", F.col("item_id")).otherwise(
            F.element_at(F.split("source_url", "/"), -1)).alias("item_id"), "source", "source_url")
