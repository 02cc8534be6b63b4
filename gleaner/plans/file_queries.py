"""Catalogue: sources and sinks by a round trip through files, and small rules over whole columns.

Each round trip writes what it derives from the given tables to a folder of its own under the shared checkpoint folder
and reads it back with the library's readers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import payloads, tags as tg, text
from gleaner.operators import predicates, reports
from gleaner.plans.registry import query
from gleaner.plans.views import Tables, with_views
from gleaner.schemas import EDGES, SOURCE_ERROR
from gleaner.session import checkpoint_dir
from gleaner.sinks import writers
from gleaner.sources import files
from gleaner.vocabulary import TAGS


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---- round trips --------------------------------------------------------------------------------------------------

@query(with_views("runs_v", body="""select cast(run_id as varchar) as run_id, cast(profile as varchar) as profile, kind,
 status, sources_checked, ingested, strftime(completed_at, '%Y-%m-%d %H:%M:%S') as completed from runs_v"""))
def ledger_round_trip(t: Tables) -> DataFrame:
    path = _folder(t, "runs")
    stamp = F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    writers.append_runs(t.runs_v.select(
        F.col("run_id").cast("string").alias("run_id"), F.col("profile").cast("string").alias("profile"), "kind",
        "status", stamp.alias("completed_at"), "sources_checked", "ingested"), path)
    return files.read_runs(t.spark, path).select(
        "run_id", "profile", "kind", "status", "sources_checked", "ingested",
        F.date_format("completed_ts", "yyyy-MM-dd HH:mm:ss").alias("completed"))


@query("""select cast(event_id as varchar) as run_id, case event_type when 'error' then 'ERROR' else 'INFO' end as level,
 'm ' || event_type as message, cast(user_id as varchar) as profile, cast(value as varchar) is not null as has_extra from events""")
def log_round_trip(t: Tables) -> DataFrame:
    path = _folder(t, "logs")
    rows = t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("m "), "event_type").alias("message"), F.col("user_id").cast("string").alias("profile"),
        F.col("value").alias("unknown_key"))
    writers.append_json(rows, path)
    extra = F.try_variant_get("extra", "$.unknown_key", "double")
    return files.read_logs(t.spark, path).select("run_id", "level", "message", "profile", extra.isNotNull().alias("has_extra"))


@query("""
with m as (select page_id, case when page_id % 3 = 0 then 'arxiv' else 'blog' end as tag, 1 + page_id % 12 as month, length(html) as chars from pages)
select cast(page_id as varchar) as note_id, case when tag = 'arxiv' then 'papers' else 'articles' end as kind, tag as source,
 '2026' as year, lpad(cast(month as varchar), 2, '0') as month, case when page_id % 5 = 0 then 2 else 1 end as version, md5(html) as full_text_md5 from m join pages using (page_id)""")
def note_months(t: Tables) -> DataFrame:
    """Written once, then every fifth note again: the others of its month stay."""
    path = _folder(t, "notes")
    day = F.expr("make_timestamp(2026, cast(1 + page_id % 12 as int), 5, 0, 0, 0)")
    notes = t.pages.select(
        F.col("page_id").cast("string").alias("note_id"), F.lit(1).cast("bigint").alias("version"),
        F.col("html").alias("full_text"), F.when(F.col("page_id") % 3 == 0, "arxiv").otherwise("blog").alias("source_tag"),
        day.alias("published"))
    writers.write_notes(notes, path)
    writers.write_notes(notes.where("cast(note_id as bigint) % 5 = 0").withColumn("version", F.lit(2).cast("bigint")), path)
    stored = writers.read_notes_table(t.spark, path, "note_id STRING, version BIGINT, full_text STRING, kind STRING, "
                                                     "source STRING, year STRING, month STRING")
    return stored.select("note_id", "kind", "source", "year", "month", "version", F.md5("full_text").alias("full_text_md5"))


@query("""
with e as (select 'related_to' as type, cast(user_id as varchar) as source_note_id, event_type as target_note_id, max(event_id) as last from events group by all)
select type, source_note_id, target_note_id, cast(last as double) as score from e""")
def edge_table(t: Tables) -> DataFrame:
    """Two writes; an edge of both has the evidence of the second."""
    path = _folder(t, "edges")
    edges = t.events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))

    def as_edges(score: str) -> DataFrame:
        return edges.select(
            F.lit("related_to").alias("type"), F.col("user_id").cast("string").alias("source_note_id"),
            F.col("event_type").alias("target_note_id"),
            F.struct(F.lit("vector").alias("kind"), F.col(score).cast("double").alias("score")).alias("evidence"))

    writers.write_edges(as_edges("first"), path, 16)
    writers.write_edges(as_edges("last"), path, 16)
    return writers.read_edges(t.spark, path).select(
        "type", "source_note_id", "target_note_id", F.col("evidence.score").alias("score"))


@query("""
select regexp_extract(url, '^[a-z]+', 0) as source, '2026' as year, lpad(cast(1 + page_id % 12 as varchar), 2, '0') as month,
 'html' as ext, count(*) as files, sum(length(html)) as bytes from pages group by all""")
def archive_inventory(t: Tables) -> DataFrame:
    bodies = t.pages.select(
        F.regexp_extract("url", "^[a-z]+", 0).alias("source"), F.lit("2026").alias("year"),
        F.lpad((1 + F.col("page_id") % 12).cast("string"), 2, "0").alias("month"), F.lit("html").alias("ext"),
        F.length("html").alias("length"))
    return reports.archive_inventory(bodies)


# ---- small rules --------------------------------------------------------------------------------------------------

@query("""
select doc_id from documents where text is not null and regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '' and doc_id % 6 not in (1, 2)""")
def require_fields(t: Tables) -> DataFrame:
    """A third of the titles are blank or null."""
    title = F.when(F.col("doc_id") % 6 == 1, " \n").when(F.col("doc_id") % 6 != 2, F.col("text"))
    return predicates.require_fields(t.documents.withColumn("title", title), ["title", "text"]).select("doc_id")


@query("select event_id, value from events where value >= 50.0")
def edge_gate(t: Tables) -> DataFrame:
    return predicates.edge_gate(t.events, 50.0, "value").select("event_id", "value")


@query("""
select doc_id, case when doc_id % 4 = 0 then 'missing_ingested_by' when doc_id % 3 = 0 and doc_id % 2 = 0 then 'path_and_archive_missing' end as problem from documents""")
def archive_problem(t: Tables) -> DataFrame:
    n = F.col("doc_id")
    tags = F.array_compact(F.array(F.when(n % 4 != 0, TAGS.ingested_by), F.when(n % 2 == 0, TAGS.archive_missing)))
    return t.documents.select("doc_id", tg.archive_problem(F.when(n % 3 == 0, "a.pdf"), tags).alias("problem"))


@query("""
select doc_id, case when doc_id % 3 = 0 then lang when doc_id % 3 = 1 then source else '' end as tags,
 case when doc_id % 2 = 0 then 'https://a/' || doc_id when doc_id % 5 <> 0 then 'https://b/' || doc_id end as url from documents""")
def note_fields(t: Tables) -> DataFrame:
    """Values at the top level, else under the metadata."""
    n, key = F.col("doc_id"), F.col("doc_id").cast("string")
    top = F.when(n % 3 == 0, F.array("lang"))
    below = F.when(n % 3 != 2, F.array("source"))
    url = tg.note_url(F.when(n % 2 == 0, F.concat(F.lit("https://a/"), key)).otherwise(""),
                      F.when(n % 5 != 0, F.concat(F.lit("https://b/"), key)).otherwise(""))
    return t.documents.select("doc_id", F.array_join(tg.note_tags(top, below), "|").alias("tags"), url.alias("url"))


@query(r"""
select doc_id, case when doc_id % 2 = 0 then 'lang|title' else 'lang' end as missing,
 case when doc_id % 2 = 0 then 'src_' || doc_id else '' end as unknown from documents""")
def template_names(t: Tables) -> DataFrame:
    """Names in single braces against those a prompt needs; doubled braces are text."""
    plain = F.concat(F.lit("{{lang}} {title} and {title}"), "source")
    odd = F.concat(F.lit("{src_"), F.col("doc_id").cast("string"), F.lit("} {{title}}"))
    found = text.template_problems(F.when(F.col("doc_id") % 2 == 0, odd).otherwise(plain), ["lang", "title"])
    return t.documents.select("doc_id", F.array_join(found["missing"], "|").alias("missing"),
                              F.array_join(found["unknown"], "|").alias("unknown"))


@query(with_views("runs_v", body="""
select run_id, strftime(completed_at, '%Y-%m-%d %H:%M:%S') || ' ' || profile || ' ' || kind || ' ' || status
 || case when run_id % 3 = 0 then ' (degraded: source_acquisition)' when run_id % 3 = 1 then ' (degraded)' else '' end
 || ' run_id=' || run_id || ' checked=' || coalesce(cast(sources_checked as varchar), 'None') || ' ingested=' || coalesce(cast(ingested as varchar), 'None')
 || ' duration=None' || case when status = 'failed' then chr(10) || '    error=bad' else '' end
 || case when run_id % 3 = 0 then chr(10) || '    source_error: source=rss kind=http detail=None' else '' end as line from runs_v"""))
def run_lines(t: Tables) -> DataFrame:
    n = F.col("run_id")
    error = F.array(F.struct(F.lit("rss").alias("source"), F.lit("http").alias("kind"), F.lit(None).cast("string").alias("detail")))
    columns = {
        "status": F.col("status"), "degraded": n % 3 != 2, "degraded_reasons": F.when(n % 3 == 0, F.array(F.lit("source_acquisition"))),
        "completed_at": F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss"), "started_at": F.lit("x"),
        "profile": F.col("profile"), "kind": F.col("kind"), "run_id": n, "sources_checked": F.col("sources_checked"),
        "ingested": F.col("ingested"), "duration_seconds": F.lit(None).cast("double"),
        "error": F.when(F.col("status") == "failed", "bad"),
        "source_acquisition_errors": F.when(n % 3 == 0, error).cast(f"array<{SOURCE_ERROR}>")}
    return t.runs_v.select("run_id", text.run_line(columns).alias("line"))


@query("""
with i as (select lang, doc_id, split_part(text, chr(10), 1) as title, cast(1 + n_chars % 10 as int) as score from documents)
select doc_id, md5('gleaner ingested a document.' || chr(10) || 'Profile: ' || lang || chr(10) || 'Run date: 2026-01-05' || chr(10)
 || 'Title: ' || title || chr(10) || 'Score: ' || score || '/10' || chr(10) || 'URL: https://d/' || doc_id
 || case when doc_id % 2 = 0 then chr(10) || 'Reason: r' else '' end || chr(10) || 'Tags: ' || lang || ', x'
 || case when doc_id % 3 = 0 then chr(10) || 'Related: other' else '' end) as message_md5 from i""")
def item_messages(t: Tables) -> DataFrame:
    n = F.col("doc_id")
    item = F.struct(
        F.substring_index("text", "\n", 1).alias("title"), F.expr("cast(1 + n_chars % 10 as int)").alias("score"),
        F.concat(F.lit("https://d/"), n.cast("string")).alias("url"), F.when(n % 2 == 0, "r").otherwise("").alias("reason"),
        F.array(F.col("lang"), F.lit("x")).alias("tags"), F.array(F.when(n % 3 == 0, "other").otherwise("")).alias("related"))
    return t.documents.select("doc_id", F.md5(payloads.item_message(F.col("lang"), F.lit("2026-01-05"), item)).alias("message_md5"))
