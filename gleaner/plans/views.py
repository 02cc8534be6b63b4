"""The library's tables as views over the given test tables, once as DataFrames and once as SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.urls import with_normalised_url


class Tables:
    """Reads the given tables of one folder, and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name.endswith("_v"):
            return _VIEWS[name](self)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _events(t: Tables) -> DataFrame:
    """Events with the timestamp as an instant in UTC."""
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def runs_of(events: DataFrame) -> DataFrame:
    idle = F.expr("event_type = 'error' or (event_type = 'signup' and event_id % 7 = 0)")
    checked = F.expr("cast(floor(value) as int) % 4")
    return events.select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("profile"),
        F.expr("case when event_id % 5 = 0 then 'backfill' when event_id % 5 = 1 then 'manual' else 'scheduled' end")
        .alias("kind"),
        F.expr("case when event_type = 'error' then 'failed' when event_type = 'signup' and event_id % 7 = 0 "
               "then 'skipped' else 'completed' end").alias("status"),
        F.col("ts").alias("completed_at"),
        F.when(~idle, checked).alias("sources_checked"),
        F.when(~idle, F.least(checked, F.expr("cast(event_id % 3 as int)"))).alias("ingested"),
    )


def _cand(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("lang").alias("profile"), "source", F.col("doc_id").cast("string").alias("item_id"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"),
        "n_chars", "doc_id",
    )


def _scores(t: Tables) -> DataFrame:
    return t.documents.where("doc_id % 17 <> 0").select(
        F.col("lang").alias("profile"), F.col("doc_id").cast("string").alias("item_id"),
        F.expr("cast(1 + n_chars % 10 as int)").alias("score"))


def _rej(t: Tables) -> DataFrame:
    marked = t.labels.where("toxic = 1 or quality = 0").select("doc_id")
    return _cand(t).join(marked, "doc_id").select("profile", "item_id", "title", "doc_id")


def probes_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("probe_id"), F.col("user_id").alias("target"), "ts",
        F.when(F.col("event_type").isin("error", "click"), "degraded").otherwise("ok").alias("status"))


def attempts_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("attempt_id"), F.col("user_id").alias("note_id"),
        F.expr("case event_id % 3 when 0 then 'tier2' when 1 then 'tier3' else 'archive' end").alias("stage"), "ts",
        F.expr("case event_type when 'error' then 'parse' when 'click' then 'validate' when 'view' then 'oversize' "
               "when 'signup' then 'http' else 'ok' end").alias("failure_stage"))


def _logs(t: Tables) -> DataFrame:
    return _events(t).select(
        "event_id", "ts",
        F.expr("case event_type when 'error' then 'ERROR' when 'click' then 'WARNING' else 'INFO' end").alias("level"),
        F.col("user_id").alias("run_id"),
        F.expr("case event_id % 4 when 0 then 'slug_collision' when 1 then 'tier2_terminal_flip' "
               "when 2 then 'archive_terminal_flip' else 'other' end").alias("sweep_stage"), "props")


def _notes(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").alias("note_id"), F.substring_index("text", "\n", 1).alias("title"),
        F.expr("cast(1 + n_chars % 10 as int)").alias("max_score"), F.expr("doc_id % 3 <> 0").alias("has_archive"),
        F.expr("case doc_id % 4 when 0 then 'text:abstract-only' when 1 then 'text:html' when 2 then 'text:pdf' "
               "else '' end").alias("text_tag"),
        *[F.expr(f"doc_id % {n} = 0").alias(c) for n, c in (
            (5, "text_terminal"), (6, "full_text"), (8, "deep_extracted"), (9, "tier2_terminal"),
            (10, "tier3_terminal"), (12, "archive_terminal"))],
        "n_chars", "lang", "doc_id")


def _pages(t: Tables) -> DataFrame:
    pages = with_normalised_url(t.pages, "url", "norm", "host")
    return pages.select(
        "page_id", "url", "html", "norm", "host",
        F.regexp_extract("url", "://[^/]+/([a-z]{2})/", 1).alias("profile"),
        F.regexp_extract("host", r"[^.]+\.[a-z]+$", 0).alias("source"),
        F.when(F.col("page_id") % 17 != 0, (1 + F.col("page_id") % 10).cast("int")).alias("score"),
    )


_VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "events_v": _events, "runs_v": lambda t: runs_of(_events(t)), "cand_v": _cand, "scores_v": _scores, "rej_v": _rej, "probes_v": lambda t: probes_of(_events(t)),
    "attempts_v": lambda t: attempts_of(_events(t)), "logs_v": _logs, "notes_v": _notes, "pages_v": _pages,
}

ARXIV_ID_SQL = "'26' || lpad(cast(doc_id % 12 + 1 as varchar), 2, '0') || '.' || lpad(cast(doc_id as varchar), 5, '0')"


def arxiv_like_id(doc_id: str = "doc_id"):
    return F.expr(
        f"concat('26', lpad(cast({doc_id} % 12 + 1 as string), 2, '0'), '.', lpad(cast({doc_id} as string), 5, '0'))")


#: the same views as SQL
SQL = {
    "runs_v": """
 select event_id as run_id, user_id as profile,
 case when event_id % 5 = 0 then 'backfill' when event_id % 5 = 1 then 'manual' else 'scheduled' end as kind,
 case when event_type = 'error' then 'failed' when event_type = 'signup' and event_id % 7 = 0 then 'skipped' else 'completed' end as status,
 ts as completed_at,
 case when event_type = 'error' or (event_type = 'signup' and event_id % 7 = 0) then null else cast(floor(value) as int) % 4 end as sources_checked,
 case when event_type = 'error' or (event_type = 'signup' and event_id % 7 = 0) then null else least(cast(floor(value) as int) % 4, cast(event_id % 3 as int)) end as ingested
 from events""",
    "cand_v": """
 select lang as profile, source, cast(doc_id as varchar) as item_id, split_part(text, chr(10), 1) as title, text as abstract, n_chars, doc_id from documents""",
    "scores_v": """
 select lang as profile, cast(doc_id as varchar) as item_id, cast(1 + n_chars % 10 as int) as score from documents where doc_id % 17 <> 0""",
    "rej_v": """
 select d.lang as profile, cast(d.doc_id as varchar) as item_id, split_part(d.text, chr(10), 1) as title, d.doc_id
 from documents d join labels l on d.doc_id = l.doc_id where l.toxic = 1 or l.quality = 0""",
    "probes_v": """
 select event_id as probe_id, user_id as target, ts, case when event_type in ('error','click') then 'degraded' else 'ok' end as status from events""",
    "attempts_v": """
 select event_id as attempt_id, user_id as note_id, case event_id % 3 when 0 then 'tier2' when 1 then 'tier3' else 'archive' end as stage, ts,
 case event_type when 'error' then 'parse' when 'click' then 'validate' when 'view' then 'oversize' when 'signup' then 'http' else 'ok' end as failure_stage from events""",
    "logs_v": """
 select event_id, ts, case event_type when 'error' then 'ERROR' when 'click' then 'WARNING' else 'INFO' end as level, user_id as run_id,
 case event_id % 4 when 0 then 'slug_collision' when 1 then 'tier2_terminal_flip' when 2 then 'archive_terminal_flip' else 'other' end as sweep_stage, props from events""",
    "notes_v": """
 select doc_id as note_id, split_part(text, chr(10), 1) as title, cast(1 + n_chars % 10 as int) as max_score,
 doc_id % 3 <> 0 as has_archive,
 case doc_id % 4 when 0 then 'text:abstract-only' when 1 then 'text:html' when 2 then 'text:pdf' else '' end as text_tag,
 doc_id % 5 = 0 as text_terminal, doc_id % 6 = 0 as full_text, doc_id % 8 = 0 as deep_extracted,
 doc_id % 9 = 0 as tier2_terminal, doc_id % 10 = 0 as tier3_terminal, doc_id % 12 = 0 as archive_terminal, n_chars, lang, doc_id from documents""",
    "pages_u": r"""
 select page_id, url, html, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) as sch,
 regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '') as auth,
 regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/+$', '') as path,
 array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda s: s <> '' and not regexp_matches(s, '^(utm_[^=]*|fbclid|gclid|mc_cid|mc_eid|ref)(=|$)')), '&') as q,
 regexp_extract(url, '#(.*)$', 1) as frag from pages""",
    "pages_v": r"""
 select page_id, url, html, sch || '://' || lower(regexp_replace(auth, ':(80|443)?$', '')) || path || case when q <> '' then '?' || q else '' end
 || case when frag <> '' then '#' || frag else '' end as norm,
 lower(regexp_extract(auth, '^([^:]*)', 1)) as host,
 regexp_extract(url, '://[^/]+/([a-z]{2})/', 1) as profile,
 regexp_extract(lower(regexp_extract(auth, '^([^:]*)', 1)), '[^.]+\.[a-z]+$') as source,
 case when page_id % 17 <> 0 then cast(1 + page_id % 10 as int) end as score from pages_u""",
}
_NEEDS = {"pages_v": ("pages_u",)}


def with_views(*names: str, body: str) -> str:
    """A query with the named views in front of it."""
    ordered: list[str] = []
    for name in names:
        ordered += [n for n in (*_NEEDS.get(name, ()), name) if n not in ordered]
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in ordered) + (", " if body.lstrip().startswith("+") else "\n") + body.lstrip().removeprefix("+")
