"""Catalogue: candidates, gates, tags, the note store, repair, links, digests, rendering."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import tags as tg
from gleaner.functions.markdown import render_note as render, set_section, with_relevance, with_repair
from gleaner.functions.text import slugify
from gleaner.functions.urls import arxiv_canonical_url
from gleaner.operators import cascade, graph, repair, reports, scoring, store
from gleaner.plans.registry import ORACLES, query
from gleaner.plans.text_queries import SLUG_SQL
from gleaner.plans.views import ARXIV_ID_SQL, Tables, arxiv_like_id, with_views
from gleaner.schemas import NOTES, REPAIR, TIER1, TIER3
from gleaner.sources import feeds
from gleaner.sources.files import parse_notes
from gleaner.vocabulary import TAGS

BATCH = 4  # small enough for several batches per source at every scale of the test tables


# ---- candidates and gates -----------------------------------------------------------------------------------------

@query(with_views("cand_v", "scores_v", body=f"""+
b as (select profile, source, item_id, (row_number() over (partition by profile, source order by item_id) - 1) // {BATCH} as batch_id from cand_v),
p as (select *, bool_or(batch_id = 3) over (partition by profile, source) as poisoned from b)
select p.item_id, p.batch_id, p.poisoned, case when poisoned or s.score is null then 'not_returned_by_filter' when s.score < 7 then 'below_relevance' end as drop_reason,
  case when not poisoned and s.score >= 7 then 'pass' else 'drop' end as decision from p left join scores_v s on s.profile = p.profile and s.item_id = p.item_id"""))
def score_gate(t: Tables) -> DataFrame:
    batches = scoring.score_batches(t.cand_v.select("profile", "source", "item_id"), size=BATCH)
    flagged = scoring.poisoned(batches, F.col("batch_id") == 3)
    scored = scoring.attach_scores(flagged, t.scores_v).withColumn("score", F.when(~F.col("poisoned"), F.col("score")))
    return scoring.relevance_gate(scored).select("item_id", "batch_id", "poisoned", "drop_reason", "decision")


def score_by_length(rows: pd.DataFrame) -> pd.DataFrame:
    """A scorer that fails on batches holding a score of 11."""
    score = (1 + rows.n_chars % 11).astype(float)
    return pd.DataFrame({"item_id": rows.item_id, "score": score, "confidence": 0.5, "reason": rows.prompt,
                         "filter_tags": [["t"]] * len(rows)})


@query(with_views("cand_v", body=f"""+
b as (select *, (row_number() over (partition by profile, source order by item_id) - 1) // {BATCH} as batch_id, 1 + n_chars % 11 as score from cand_v),
p as (select *, bool_or(score > 10) over (partition by profile, source) as poisoned from b)
select profile, item_id, cast(score as int) as score, batch_id, 'for ' || profile as reason from p where not poisoned"""))
def score_candidates(t: Tables) -> DataFrame:
    items = t.cand_v.select("profile", "source", "item_id", "n_chars")
    prompts = items.select("profile").distinct().withColumn("prompt", F.concat(F.lit("for "), "profile"))
    return scoring.score_candidates(items, score_by_length, size=BATCH, retries=0, prompts=prompts).select(
        "profile", "item_id", "score", "batch_id", "reason")


@query(ORACLES["score_gate"])
def score_gate_cut(t: Tables) -> DataFrame:
    """The same with every source cut that has more than a handful of rows."""
    batches = scoring.score_batches(t.cand_v.select("profile", "source", "item_id"), size=BATCH, hot_rows=5)
    flagged = scoring.poisoned(batches, F.col("batch_id") == 3)
    scored = scoring.attach_scores(flagged, t.scores_v).withColumn("score", F.when(~F.col("poisoned"), F.col("score")))
    return scoring.relevance_gate(scored).select("item_id", "batch_id", "poisoned", "drop_reason", "decision")


@query("""
with r as (select user_id % 7 as profile, event_type as source, event_id // 25 as batch_id, event_id as pos, cast(user_id as varchar) as item_id,
   case when event_id % 997 = 0 then 11 else 1 + event_id % 10 end as score, case when event_id % 1499 = 0 then null else 'r' end as reason from events),
p as (select *, case when score > 10 then 'bad_score' when reason is null then 'no_reason' end as problem from r),
o as (select *, bool_and(problem is null) over (partition by profile, source, batch_id) as batch_ok from p)
select profile, source, item_id, score from o where batch_ok qualify row_number() over (partition by profile, source, item_id order by pos desc) = 1""")
def validate_scores(t: Tables) -> DataFrame:
    rows = t.events.select(
        (F.col("user_id") % 7).alias("profile"), F.col("event_type").alias("source"),
        F.expr("event_id div 25").alias("batch_id"), F.col("event_id").alias("pos"),
        F.col("user_id").cast("string").alias("item_id"),
        F.expr("case when event_id % 997 = 0 then 11 else 1 + event_id % 10 end").alias("score"),
        F.when(F.col("event_id") % 1499 != 0, "r").alias("reason"), F.array("event_type").alias("filter_tags"))
    good = scoring.validate_scores(rows).where("batch_ok").select("profile", "source", "item_id", "score", "pos")
    return scoring.last_wins(good, ["profile", "source", "item_id"]).select("profile", "source", "item_id", "score")


@query(with_views("pages_v", body="""+
n as (select norm, min(page_id) as note_id from pages_v where page_id % 3 = 0 group by norm),
i as (select p.*, n.note_id, coalesce(p.score >= 7, false) as pass from pages_v p left join n on n.norm = p.norm),
w as (select *, case when pass then case when page_id % 11 = 0 then 'slug_collision' when note_id is not null then 'updated' else 'created' end end as st from i)
select profile, source, count(*) as fetched, count(*) filter (where pass) as filter_pass, count(*) filter (where not pass) as filter_drop,
 count(*) filter (where pass) as inspected, count(*) filter (where pass and note_id is not null) as cache_hits,
 count(*) filter (where st = 'created') as created, count(*) filter (where st = 'updated') as updated, count(*) filter (where st = 'slug_collision') as failed
from w group by profile, source"""))
def funnel(t: Tables) -> DataFrame:
    pages = t.pages_v.withColumn("source_url", F.col("url"))
    notes = pages.where("page_id % 3 = 0").select(F.col("page_id").alias("note_id"), "source_url")
    gated = scoring.relevance_gate(store.cache_lookup(pages, notes))
    written = gated.withColumn("write_status", F.when(
        F.col("decision") == "pass",
        F.when(F.col("page_id") % 11 == 0, "slug_collision").when(F.col("cache_hit"), "updated").otherwise("created")))
    return reports.funnel(written)


@query(with_views("pages_v", body="""
select page_id, (select min(page_id) from pages_v n where n.page_id % 3 = 0 and n.norm = p.norm) as note_id,
  exists (select 1 from pages_v n where n.page_id % 3 = 0 and n.norm = p.norm) as cache_hit from pages_v p"""))
def cache_lookup(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", F.col("url").alias("source_url"))
    notes = pages.where("page_id % 3 = 0").withColumnRenamed("page_id", "note_id")
    return store.cache_lookup(pages, notes).select("page_id", "note_id", "cache_hit")


@query(with_views("pages_v", body="""
select page_id from pages_v p where not exists (select 1 from pages_v n where n.page_id % 3 = 0 and n.norm = p.norm)"""))
def skip_cache_hits(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", F.col("url").alias("source_url"))
    return store.skip_cache_hits(pages, pages.where("page_id % 3 = 0")).select("page_id")


@query(f"""
with d as (select doc_id, lang, {ARXIV_ID_SQL} as id from documents),
g as (select distinct d.id, d.lang from d join labels l on l.doc_id = d.doc_id where l.toxic = 1)
select d.doc_id, g.id is not null as archive_terminal from d left join g on g.id = d.id and g.lang = d.lang""")
def archive_terminal(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.col("lang").alias("profile"), arxiv_like_id().alias("item_id"))
    toxic = t.labels.where("toxic = 1").select("doc_id", F.lit(TAGS.archive_terminal).alias("mark"))
    notes = d.join(toxic, "doc_id", "left").select(F.array_compact(F.array(
        F.concat(F.lit("profile:"), "profile"), F.concat(F.lit("arxiv-id:"), "item_id"), "mark")).alias("tags"))
    return store.flag_archive_terminal(d, notes).select("doc_id", "archive_terminal")


@query("""
with s as (select lower(n_name) as profile, unnest(list_distinct(['src' || (n_nationkey % 20), case when n_nationkey % 5 = 0 then 'de' else 'src3' end])) as key from nation where n_nationkey % 4 <> 3)
select distinct s.profile, cast(d.doc_id as varchar) as item_id from documents d join s on s.key in (d.source, d.lang)""")
def route_profiles(t: Tables) -> DataFrame:
    items = t.documents.select(
        F.lit("arxiv").alias("kind"), F.col("doc_id").cast("string").alias("item_id"),
        F.array("source", "lang").alias("categories"), F.lit(None).cast("string").alias("feed_url"))
    keys = F.array_distinct(F.array(
        F.expr("concat('src', n_nationkey % 20)"), F.when(F.col("n_nationkey") % 5 == 0, "de").otherwise("src3")))
    sources = t.nation.select(
        F.lower("n_name").alias("profile"), F.lit("arxiv").alias("kind"), F.explode(keys).alias("source_key"),
        (F.col("n_nationkey") % 4 != 3).alias("enabled"))
    return feeds.route_to_profiles(items, sources).select("profile", "item_id")


@query("""
select doc_id, source, lang from documents qualify row_number() over (partition by source order by n_chars desc, cast(doc_id as varchar)) <= 7""")
def newest_per_category(t: Tables) -> DataFrame:
    rows = t.documents.select(
        "doc_id", "source", "lang", F.timestamp_seconds("n_chars").alias("published"),
        F.col("doc_id").cast("string").alias("item_id"))
    return feeds.max_results_per_category(rows, 7, "source").select("doc_id", "source", "lang")


@query("""
select cast(user_id as varchar) || event_type as item_id, min(strftime(ts, '%Y-%m-%d')) as day, arg_min(event_id, (cast(ts as date), event_id)) as event_id from events group by 1""")
def first_seen(t: Tables) -> DataFrame:
    rows = t.events_v.select(
        F.concat(F.col("user_id").cast("string"), "event_type").alias("item_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("pos"), "event_id")
    return feeds.first_seen(rows).select("item_id", "day", "event_id")


GATES_SQL = """
g as (select doc_id, cast(1 + n_chars % 10 as int) as score, doc_id % 3 = 0 as has_text, doc_id % 5 as t2, doc_id % 4 as t3,
   doc_id % 7 <> 0 as tier2_ok, doc_id % 11 <> 0 as tier1_ok, doc_id % 13 <> 0 as tier3_ok from documents),
h as (select *, score >= 8 and not has_text and t2 < 3 as run_tier2, score >= 8 and not has_text and t2 >= 3 as tier2_terminal, score >= 7 as run_tier1 from g),
k as (select *, (has_text or (run_tier2 and tier2_ok)) and score >= 8 as full_text_kept from h),
c as (select *, score >= 9 and t3 < 3 and full_text_kept as run_tier3, score >= 9 and t3 >= 3 and full_text_kept as tier3_terminal from k)
"""


def _gated(t: Tables) -> DataFrame:
    rows = t.documents.select(
        "doc_id", F.expr("cast(1 + n_chars % 10 as int)").alias("score"), F.expr("doc_id % 3 = 0").alias("has_text"),
        F.expr("doc_id % 7 <> 0").alias("tier2_ok"), F.expr("doc_id % 11 <> 0").alias("tier1_ok"),
        F.expr("doc_id % 13 <> 0").alias("tier3_ok"), "lang", "source", "text")
    gates = cascade.cascade_gates(F.col("score"), F.col("has_text"), F.col("doc_id") % 5, F.col("doc_id") % 4)
    return cascade.cascade_outcome(rows.withColumns(gates))


@query(f"""with {GATES_SQL} select doc_id, run_tier2, tier2_terminal, run_tier1, full_text_kept, run_tier3, tier3_terminal,
 run_tier3 and tier3_ok as has_tier3, (run_tier2 and not tier2_ok) or (run_tier1 and not tier1_ok) or (run_tier3 and not tier3_ok) as repair_flag from c""")
def cascade_gates(t: Tables) -> DataFrame:
    return _gated(t).select(
        "doc_id", "run_tier2", "tier2_terminal", "run_tier1", "full_text_kept", "run_tier3", "tier3_terminal",
        "has_tier3", "repair_flag")


@query(f"""with {GATES_SQL},
f as (select c.*, d.lang, d.source, c.doc_id % 9 = 0 as missing, c.doc_id % 18 = 0 as gone, (run_tier2 and not tier2_ok) or (run_tier1 and not tier1_ok) or (run_tier3 and not tier3_ok) as flag,
  {ARXIV_ID_SQL.replace('doc_id', 'c.doc_id')} as id, regexp_replace(d.text, '\\s+', ' ', 'g') as abstract from c join documents d on d.doc_id = c.doc_id)
select doc_id, concat_ws('|', 'profile:' || lang, 'arxiv-id:' || id, 'source:arxiv', 'ingested-by:gleaner', 'schema:1', 'cat:' || source, 'cat:' || lang,
   case when missing then 'gleaner:archive-missing' end, case when gone then 'gleaner:archive-terminal' end, case when has_text then 'text:html' else 'text:abstract-only' end,
   case when full_text_kept then 'full-text' end, case when missing then 'gleaner:repair-needed' end, case when run_tier3 and tier3_ok then 'gleaner:deep-extracted' end,
   case when flag and not missing then 'gleaner:repair-needed' end, case when tier2_terminal then 'gleaner:tier2-terminal' end, case when tier3_terminal then 'gleaner:tier3-terminal' end) as arxiv_tags,
  concat_ws('|', 'profile:' || lang, 'source:blog', 'feed-slug:' || source, 'ingested-by:gleaner', 'schema:1',
   case when missing then 'gleaner:archive-missing' end, case when full_text_kept then 'full-text' end, case when missing then 'gleaner:repair-needed' end,
   case when run_tier3 and tier3_ok then 'gleaner:deep-extracted' end, case when flag and not missing then 'gleaner:repair-needed' end,
   case when tier2_terminal then 'gleaner:tier2-terminal' end, case when tier3_terminal then 'gleaner:tier3-terminal' end) as rss_tags,
  case when run_tier1 and not tier1_ok then '' else abstract end as summary from f""")
def build_tags(t: Tables) -> DataFrame:
    df = _gated(t).withColumn("missing", F.expr("doc_id % 9 = 0")).withColumn("gone", F.expr("doc_id % 18 = 0"))
    common = dict(
        profile=F.col("lang"), archive_missing=F.col("missing"), has_full_text=F.col("full_text_kept"),
        has_tier3=F.col("has_tier3"), repair_flag=F.col("repair_flag"), tier2_terminal=F.col("tier2_terminal"),
        tier3_terminal=F.col("tier3_terminal"))
    arxiv = tg.build_tags(
        "arxiv", categories=F.array("source", "lang"), arxiv_id=arxiv_like_id(), archive_terminal=F.col("gone"),
        text_tag=F.when(F.col("has_text"), "text:html").otherwise("text:abstract-only"), **common)
    rss = tg.build_tags("rss", source_tag=F.lit("blog"), feed_slug=F.col("source"), **common)
    abstract = F.regexp_replace("text", r"\s+", " ")
    return df.select(
        "doc_id", F.array_join(arxiv, "|").alias("arxiv_tags"), F.array_join(rss, "|").alias("rss_tags"),
        tg.summary_text("arxiv", tier1_attempted=F.col("run_tier1"), tier1_ok=F.col("tier1_ok"), abstract=abstract)
        .alias("summary"))


# ---- rejections ---------------------------------------------------------------------------------------------------

FTAGS_SQL = "list_distinct([source, profile, 'len:' || cast(floor(n_chars / 1000) as int)])"


@query(with_views("cand_v", "rej_v", body=f"""+
i as (select profile, title, unnest({FTAGS_SQL}) as tag, exists (select 1 from rej_v r where r.profile = c.profile and r.title = c.title) as rejected from cand_v c)
select profile, tag, count(*) as total, count(*) filter (where rejected) as n_rejected, round(count(*) filter (where rejected) / count(*), 4) as rate from i group by profile, tag"""))
def rejection_rates(t: Tables) -> DataFrame:
    tags = F.array("source", "profile", F.concat(F.lit("len:"), F.floor(F.col("n_chars") / 1000).cast("string")), "source")
    items = t.cand_v.select("profile", "title", tags.alias("tags"))
    return reports.rejection_rates(reports.mark_rejected(items, t.rej_v))


@query(with_views("rej_v", body="""+
n as (select profile, doc_id, left(title, 200) as title from rej_v qualify row_number() over (partition by profile order by doc_id desc) <= 20)
select profile, count(*) as n, string_agg('- "' || title || '" (rejected)', chr(10) order by doc_id desc) as block from n group by profile"""))
def negative_examples(t: Tables) -> DataFrame:
    return reports.negative_examples(t.rej_v.withColumn("pos", F.col("doc_id")))


# ---- merging ------------------------------------------------------------------------------------------------------

TAG_LISTS_SQL = """
l as (select d.doc_id, list_filter(['profile:' || d.lang, 'source:' || d.source, case when d.doc_id % 2 = 0 then 'text:html' else 'mine-' || (d.doc_id % 5) end,
   case when d.doc_id % 4 = 0 then 'gleaner:repair-needed' end, case when l.toxic = 1 then 'gleaner:rejected:' || d.lang end, case when d.doc_id % 6 = 0 then 'feed-slug:old' end, 'reading-list'], lambda x: x is not null) as old,
  list_filter(['profile:ml', 'profile:' || d.lang, 'source:' || d.source, 'text:pdf', 'full-text', case when l.quality = 0 then 'gleaner:rejected:ml' end, 'feed-slug:new', 'stray'], lambda x: x is not null) as new
  from documents d left join labels l on l.doc_id = d.doc_id)"""
_OWNED_SQL = """(starts_with(x, 'source:') or starts_with(x, 'arxiv-id:') or starts_with(x, 'cat:') or starts_with(x, 'text:') or starts_with(x, 'ingested-by:') or starts_with(x, 'schema:')
 or x in ('full-text', 'gleaner:repair-needed', 'gleaner:archive-missing', 'gleaner:deep-extracted', 'gleaner:text-terminal', 'gleaner:tier2-terminal', 'gleaner:tier3-terminal', 'gleaner:archive-terminal'))"""


@query(f"""with {TAG_LISTS_SQL}
select doc_id, array_to_string(list_concat(list_filter(new, lambda x: {_OWNED_SQL}),
  list_sort(list_distinct(list_filter(list_concat(old, new), lambda x: starts_with(x, 'profile:') and not list_contains(list_concat(old, new), 'gleaner:rejected:' || substr(x, 9))))),
  list_sort(list_distinct(list_filter(list_concat(old, new), lambda x: starts_with(x, 'gleaner:rejected:')))),
  list_filter(old, lambda x: not {_OWNED_SQL} and not starts_with(x, 'profile:') and not starts_with(x, 'gleaner:rejected:'))), '|') as tags,
  array_to_string(list_filter(old, lambda x: not (starts_with(x, 'profile:') and list_contains(old, 'gleaner:rejected:' || substr(x, 9)))), '|') as guarded from l""")
def merge_tags(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id", "left")
    old = F.array_compact(F.array(
        F.concat(F.lit("profile:"), "lang"), F.concat(F.lit("source:"), "source"),
        F.when(F.col("doc_id") % 2 == 0, "text:html").otherwise(F.concat(F.lit("mine-"), (F.col("doc_id") % 5).cast("string"))),
        F.when(F.col("doc_id") % 4 == 0, TAGS.repair_needed),
        F.when(F.col("toxic") == 1, F.concat(F.lit(TAGS.rejected_prefix), "lang")),
        F.when(F.col("doc_id") % 6 == 0, "feed-slug:old"), F.lit("reading-list")))
    new = F.array_compact(F.array(
        F.lit("profile:ml"), F.concat(F.lit("profile:"), "lang"), F.concat(F.lit("source:"), "source"), F.lit("text:pdf"),
        F.lit("full-text"), F.when(F.col("quality") == 0, TAGS.rejected_prefix + "ml"), F.lit("feed-slug:new"), F.lit("stray")))
    return d.select("doc_id", old.alias("old"), new.alias("new")).select(
        "doc_id", F.array_join(tg.merge_tags(F.col("old"), F.col("new")), "|").alias("tags"),
        F.array_join(store.apply_rejection_guard(F.col("old")), "|").alias("guarded"))


@query("""
with r as (select doc_id, [lang, 'ml', 'bio'] as op, [1 + n_chars % 10, 5, 6] as os, [lang, 'chem'] as np, [1 + (n_chars + 3) % 10, 7] as ns,
   case when doc_id % 3 = 0 then ['gleaner:rejected:' || lang] when doc_id % 3 = 1 then ['gleaner:rejected:chem', 'gleaner:rejected:ml'] else [] end as t from documents)
select doc_id, concat_ws('|', case when not list_contains(t, 'gleaner:rejected:' || np[1]) then np[1] || '=' || ns[1] end, case when not list_contains(t, 'gleaner:rejected:chem') then 'chem=' || ns[2] end,
   case when list_contains(t, 'gleaner:rejected:' || op[1]) then op[1] || '=' || os[1] end, 'ml=' || os[2], 'bio=' || os[3]) as united,
 concat_ws('|', case when not list_contains(t, 'gleaner:rejected:' || np[1]) then np[1] || '=' || ns[1] end, case when not list_contains(t, 'gleaner:rejected:chem') then 'chem=' || ns[2] end,
   case when list_contains(t, 'gleaner:rejected:' || op[1]) then op[1] || '=' || os[1] end, case when list_contains(t, 'gleaner:rejected:ml') then 'ml=' || os[2] end) as rewritten,
 greatest(os[1], 6) as top from r""")
def merge_relevance(t: Tables) -> DataFrame:
    def entry(profile, score):
        return F.struct(profile.alias("profile"), score.cast("int").alias("score"), F.lit("r").alias("reason"))

    lang, n = F.col("lang"), F.col("n_chars")
    old = F.array(entry(lang, 1 + n % 10), entry(F.lit("ml"), F.lit(5)), entry(F.lit("bio"), F.lit(6)))
    new = F.array(entry(lang, 1 + (n + 3) % 10), entry(F.lit("chem"), F.lit(7)))
    mark = F.lit(TAGS.rejected_prefix)
    tags = F.when(F.col("doc_id") % 3 == 0, F.array(F.concat(mark, lang))).when(
        F.col("doc_id") % 3 == 1, F.array(F.concat(mark, F.lit("chem")), F.concat(mark, F.lit("ml")))).otherwise(tg.no_tags())

    def shown(entries):
        return F.array_join(F.transform(entries, lambda e: F.concat(e["profile"], F.lit("="), e["score"].cast("string"))), "|")

    return t.documents.select("doc_id", old.alias("o"), new.alias("n"), tags.alias("t")).select(
        "doc_id", shown(tg.merge_relevance_union(F.col("o"), F.col("n"), F.col("t"))).alias("united"),
        shown(tg.relevance_for_rewrite(F.col("o"), F.col("n"), F.col("t"))).alias("rewritten"),
        tg.max_profile_score(F.col("o")).alias("top"))


@query(with_views("pages_v", body="""+
o as (select norm, min(page_id) as page_id from pages_v where page_id % 3 = 0 group by norm), old as (select o.norm, o.page_id, p.profile from o join pages_v p on p.page_id = o.page_id),
i as (select norm, profile, min(page_id) as page_id from pages_v where page_id % 2 = 0 group by norm, profile), j as (select *, case when page_id % 17 = 0 then null else cast(1 + page_id % 10 as int) end as score from i),
g as (select norm, min_by(page_id, (cast(page_id as varchar), profile)) as page_id, max(coalesce(score, 0)) as best, string_agg(profile || '=' || coalesce(cast(score as varchar), '?'), '|' order by profile) as rel from j group by norm)
select coalesce(old.norm, g.norm) as norm, case when g.norm is null then 'unchanged' when old.norm is null then 'created' else 'updated' end as status,
  case when g.norm is null then old.page_id else g.page_id end as title_page, case when g.norm is null then 3 else case when old.norm is null then 1 else 4 end end as version,
  case when g.norm is null then 'old=4' when old.norm is null then g.rel else g.rel || '|old=4' end as relevance,
  case when g.norm is null then 0.35 else greatest(coalesce(case when old.norm is not null then 0.35 end, 0.0), greatest(g.best, case when old.norm is not null then 4 else 0 end) / 10.0) end as confidence,
  case when old.norm is not null then 'notes of ' || old.page_id end as user_notes from old full join g on g.norm = old.norm"""))
def merge_notes(t: Tables) -> DataFrame:
    p = t.pages_v
    old = store.one_note_per(p.where("page_id % 3 = 0"), "norm", ["page_id", "profile"], "page_id").select(
        F.col("norm").alias("source_url"), F.col("page_id").cast("string").alias("title"),
        F.array(F.concat(F.lit("profile:"), "profile"), F.lit("keep")).alias("tags"),
        F.from_json(F.lit('[{"profile":"old","score":4,"reason":"x"}]'), "array<struct<profile:string,score:int,reason:string>>").alias("relevance"),
        F.lit(0.35).alias("confidence"), F.concat(F.lit("notes of "), F.col("page_id").cast("string")).alias("user_notes"),
        F.lit(3).cast("bigint").alias("version"))
    first = p.where("page_id % 2 = 0").groupBy("norm", "profile").agg(F.min("page_id").alias("page_id"))
    incoming = first.select(
        F.col("norm").alias("source_url"), "profile", F.col("page_id").cast("string").alias("item_id"),
        F.col("page_id").cast("string").alias("title"), F.when(F.col("page_id") % 17 != 0, 1 + F.col("page_id") % 10).alias("score"),
        F.lit("r").alias("reason"), F.array(F.concat(F.lit("profile:"), "profile")).alias("tags"),
        F.lit(None).cast("string").alias("user_notes"))
    combined = store.combine_incoming(incoming).withColumn("confidence", F.lit(0.0)).withColumn("version", F.lit(0).cast("bigint"))
    shown = F.array_join(F.transform("relevance", lambda e: F.concat(
        e["profile"], F.lit("="), F.coalesce(e["score"].cast("string"), F.lit("?")))), "|")
    return store.merge_notes(old, combined).select(
        F.col("source_url").alias("norm"), "status", F.col("title").cast("bigint").alias("title_page"), "version",
        shown.alias("relevance"), "confidence", "user_notes")


# ---- slug collisions ----------------------------------------------------------------------------------------------

_TITLE = "split_part(text, chr(10), 1)"
_PAPER_URL = """case when n_chars % 3 = 0 then 'https://blog' || (n_chars % 4) || '.example.com/p' || n_chars else 'https://arxiv.org/abs/2601.' || lpad(cast(n_chars % 100000 as varchar), 5, '0') end"""
COLLISION_SQL = f"""
d as (select doc_id, cast(doc_id as varchar) as id, {_TITLE} as title, {SLUG_SQL.format(_TITLE)} as slug, {_PAPER_URL} as url from documents where {SLUG_SQL.format(_TITLE)} <> ''),
e as (select id, slug, doc_id % 10 = 0 as residue, case when doc_id % 10 = 0 then '' else url end as url from d where doc_id % 2 = 0 qualify row_number() over (partition by slug order by id) = 1),
i as (select id, title, slug, url, nullif(regexp_extract(url, 'arxiv\\.org/abs/([^\\s?#]+)', 1), '') as arxiv from d where doc_id % 2 = 1)"""


def _papers(t: Tables) -> DataFrame:
    url = F.expr("case when n_chars % 3 = 0 then concat('https://blog', n_chars % 4, '.example.com/p', n_chars) "
                 "else concat('https://arxiv.org/abs/2601.', lpad(cast(n_chars % 100000 as string), 5, '0')) end")
    title = F.substring_index("text", "\n", 1)
    return t.documents.select(
        "doc_id", F.col("doc_id").cast("string").alias("item_id"), title.alias("title"), slugify(title).alias("slug"),
        url.alias("source_url")).where("slug <> ''")


def _stored_papers(t: Tables) -> DataFrame:
    residue = F.col("doc_id") % 10 == 0
    arxiv = F.regexp_extract("source_url", r"abs/(.*)$", 1)
    stored = _papers(t).where("doc_id % 2 = 0").select(
        F.col("item_id").alias("note_id"), "slug",
        F.when(residue, tg.no_tags()).when(arxiv != "", F.array(F.concat(F.lit("arxiv-id:"), arxiv)))
        .otherwise(F.array(F.lit("x"))).alias("tags"),
        F.when(residue, "").otherwise(F.col("source_url")).alias("source_url"),
        F.when(residue, "").otherwise("body").alias("body"))
    return store.one_note_per(stored, "slug", ["note_id", "tags", "source_url", "body"])


@query(f"""with {COLLISION_SQL}
select i.id as item_id, e.id as holder_id, case when e.url <> '' and e.url = i.url then 'duplicate' when e.residue then 'reclaimable' else 'distinct' end as kind,
  case when e.url <> '' and e.url = i.url then case when i.arxiv is not null then 'arxiv=' || i.arxiv else 'url=' || e.url end
       when e.residue then 'blank' else 'tags=1 url=' || e.url || ' chars=4' end as reason
from i join e on e.slug = i.slug""")
def classify_collision(t: Tables) -> DataFrame:
    incoming = _papers(t).where("doc_id % 2 = 1").drop("doc_id")
    return store.classify_collision(incoming, _stored_papers(t)).select("item_id", "holder_id", "kind", "reason")


@query(f"""with {COLLISION_SQL},
k1 as (select i.*, e.id as hid, case when e.id is null then null when e.url <> '' and e.url = i.url then 'duplicate' when e.residue then 'reclaimable' else 'distinct' end as kind from i left join e on e.slug = i.slug),
f1 as (select slug, arg_min(id, id) as fid, arg_min(url, id) as furl from k1 where kind is null or kind = 'reclaimable' group by slug),
c1 as (select k1.*, fid, furl, case when (kind is null or kind = 'reclaimable') and fid = id then 'created' when (kind is null or kind = 'reclaimable') and furl = url then 'duplicate'
  when kind = 'duplicate' then 'duplicate' else 'collision' end as outcome,
  case when (kind is null or kind = 'reclaimable') and fid <> id then fid when kind in ('duplicate', 'distinct') then hid end as blocked from k1 left join f1 on f1.slug = k1.slug),
r2 as (select id, title as first_title, blocked as first_blocked, url, arxiv, title || case when arxiv is not null then ' [arXiv ' || arxiv || ']' else ' [' || regexp_extract(url, '//([^/]*)', 1) || ']' end as title from c1 where outcome = 'collision'),
s2 as (select *, {SLUG_SQL.format('title')} as slug from r2),
e2 as (select id, slug, url, residue from e where id not in (select hid from c1 where outcome = 'created' and kind = 'reclaimable') union all select id, slug, url, false from c1 where outcome = 'created'),
k2 as (select s2.*, e2.id as hid, case when e2.id is null then null when e2.url <> '' and e2.url = s2.url then 'duplicate' when e2.residue then 'reclaimable' else 'distinct' end as kind from s2 left join e2 on e2.slug = s2.slug),
f2 as (select slug, arg_min(id, id) as fid, arg_min(url, id) as furl from k2 where kind is null or kind = 'reclaimable' group by slug),
c2 as (select k2.*, case when (kind is null or kind = 'reclaimable') and fid = id then 'created' when (kind is null or kind = 'reclaimable') and furl = url then 'duplicate'
  when kind = 'duplicate' then 'duplicate' else 'slug_collision' end as status, case when (kind is null or kind = 'reclaimable') and fid <> id then fid when kind in ('duplicate', 'distinct') then hid end as blocked
  from k2 left join f2 on f2.slug = k2.slug)
select id as item_id, title, slug, outcome as status, case when outcome = 'created' and kind = 'reclaimable' then hid end as reclaimed_id, '' as detail from c1 where outcome <> 'collision'
union all select id, title, slug, status, case when status = 'created' and kind = 'reclaimable' then hid end,
  case when status = 'slug_collision' then 'first_existing_id=' || first_blocked || '; first_slug=''' || first_title || '''; retry_existing_id=' || blocked || '; retry_slug=''' || title || '''' else '' end from c2""")
def resolve_collisions(t: Tables) -> DataFrame:
    incoming = _papers(t).where("doc_id % 2 = 1").select("item_id", "title", "source_url")
    return store.resolve_collisions(incoming, _stored_papers(t)).select(
        "item_id", "title", "slug", "status", "reclaimed_id", "detail")


# ---- upserts: two profiles bring each url, a third of the urls are known, others meet residue of aborted writes -----

UPSERT_SQL = """
i as (select doc_id, doc_id // 2 as n, case when doc_id % 2 = 0 then 'a' else 'b' end as profile,
  cast(1 + n_chars % 10 as int) as score, text from documents),
g as (select n, string_agg(profile || '=' || score, '|' order by profile) as rel, max(score) as best,
  arg_max(text, doc_id) as text, min(doc_id) as first_id, n % 3 = 0 as known, n % 3 <> 0 and n % 5 = 2 as held from i
  group by n)"""


def incoming_and_stored(t: Tables) -> tuple[DataFrame, DataFrame]:
    n = F.expr("doc_id div 2").cast("string")
    rows = t.documents.select(
        F.expr("case when doc_id % 2 = 0 then 'a' else 'b' end").alias("profile"),
        F.lpad(F.col("doc_id").cast("string"), 15, "0").alias("item_id"), F.concat(F.lit("Title "), n).alias("title"),
        F.concat(F.lit("https://D.example.com/p/"), n, F.lit("/?utm_x=1")).alias("source_url"),
        F.expr("cast(1 + n_chars % 10 as int)").alias("score"), F.lit("r").alias("reason"),
        F.array(F.lit(TAGS.ingested_by)).alias("tags"), F.lit(None).cast("string").alias("user_notes"),
        F.col("text").alias("full_text"))
    known, held = F.col("n") % 3 == 0, F.col("n") % 5 == 2
    number = F.col("n").cast("string")
    blank = spark_columns(t)
    stored = t.documents.select(F.expr("doc_id div 2").alias("n"), "text").groupBy("n").agg(
        F.min("text").alias("text")).where(known | held | (F.col("n") % 5 == 1))
    values = {
        "note_id": F.concat(F.when(known, "s").otherwise("r"), number),
        "version": F.when(known, 4).otherwise(1).cast("bigint"),
        "title": F.when(known, F.concat(F.lit("Stored "), number, F.lit(" [x]"))).otherwise(
            F.concat(F.lit("Title "), number)),
        "slug": F.concat(F.when(known, "kept-").otherwise("title-"), number),
        "source_url": F.when(known, F.concat(F.lit("https://d.example.com/p/"), number)).otherwise(""),
        "tags": F.when(known, F.array(F.lit("mine"))).otherwise(tg.no_tags()), "confidence": F.lit(0.1),
        "full_text": F.when(known | held, F.concat(F.lit("old"), F.coalesce("text", F.lit("")))),
        "relevance": F.from_json(F.when(known, '[{"profile":"old","score":4,"reason":"x"}]'), tg.RELEVANCE)}
    store_rows = stored.select(*[values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in blank])
    return store_rows, rows


def spark_columns(t: Tables) -> list[tuple[str, str]]:
    return t.spark.createDataFrame([], NOTES).dtypes


@query(f"""with {UPSERT_SQL}
select case when known then 's' || n else left(sha256('https://d.example.com/p/' || n), 32) end as note_id,
  case when known then 'Stored ' || n || ' [x]' when held then 'Title ' || n || ' [d.example.com]' else 'Title ' || n end
    as title,
  case when known then 'kept-' || n when held then 'title-' || n || '-d-example-com' else 'title-' || n end as slug,
  case when known then 5 else 1 end as version, case when known then rel || '|old=4' else rel end as relevance,
  greatest(best, case when known then 4 else 0 end) / 10.0 as confidence, md5(text) as full_text_md5 from g
union all select 'r' || n, 'Title ' || n, 'title-' || n, 1, '', 0.1, md5('old' || (select min(text) from i where i.n = g.n))
  from g where held""")
def upsert_notes(t: Tables) -> DataFrame:
    shown = F.array_join(F.transform("relevance", lambda e: F.concat(e["profile"], F.lit("="), e["score"].cast("string"))), "|")
    return store.upsert_notes(*incoming_and_stored(t))[0].select(
        "note_id", "title", "slug", "version", F.coalesce(shown, F.lit("")).alias("relevance"), "confidence",
        F.md5("full_text").alias("full_text_md5"))


@query(f"""with {UPSERT_SQL}
select i.profile, lpad(cast(i.doc_id as varchar), 15, '0') as item_id,
  case when g.known or i.doc_id <> g.first_id then 'updated' else 'created' end as status from i join g on g.n = i.n""")
def upsert_writes(t: Tables) -> DataFrame:
    return store.upsert_notes(*incoming_and_stored(t))[1].select("profile", "item_id", "status")


@query("""
with l as (select doc_id, lang, text, length(split_part(text, chr(10), 1)) + 1 as base, length(text) as ft, doc_id % 400 + 15 as t3
  from documents),
f as (select *, case when base + ft + t3 <= 700 then 'whole' when base + t3 <= 700 then 'no_full_text'
  when base <= 700 then 'tier1_only' else 'skipped' end as fit from l)
select doc_id as note_id, fit <> 'skipped' as swept, case when fit = 'skipped' then 7 else 8 end as version,
  md5(case when fit in ('whole', 'skipped') then text end) as full_text_md5,
  case when fit <> 'tier1_only' then doc_id % 400 end as claim_chars,
  case when fit = 'tier1_only' then 'gleaner:repair-needed|ingested-by:gleaner|' else 'ingested-by:gleaner|' end
    || 'profile:' || lang as tags from f""")
def sweep_oversize(t: Tables) -> DataFrame:
    claim = F.expr("repeat('c', cast(doc_id % 400 as int))")
    notes = t.documents.select(
        F.col("doc_id").alias("note_id"), F.substring_index("text", "\n", 1).alias("title"), F.lit("s").alias("summary"),
        F.array(F.concat(F.lit("profile:"), "lang"), F.lit(TAGS.ingested_by)).alias("tags"),
        F.lit(None).cast("string").alias("archive_path"), F.lit(7).cast("bigint").alias("version"),
        F.from_json(F.lit("[]"), tg.RELEVANCE).alias("relevance"), F.col("text").alias("full_text"),
        F.from_json(F.to_json(F.struct(F.array(claim).alias("claims"))), TIER3).alias("tier3"),
        F.lit(None).cast(REPAIR).alias("repair"), F.lit("").alias("user_notes"),
        F.lit(None).cast("timestamp").alias("updated_at"))
    return repair.repair_sweep(notes, content_limit=700).select(
        "note_id", "swept", "version", F.md5("full_text").alias("full_text_md5"),
        F.length(F.get("tier3.claims", F.lit(0))).alias("claim_chars"), F.array_join(F.array_sort("tags"), "|").alias("tags"))


@query("""
with l as (select doc_id, 200 + length(source) as base, n_chars as ft, (doc_id % 50) * 40 as t3, doc_id % 3 = 0 as ex from documents),
f as (select *, case when base + ft + t3 <= 2000 then 'whole' when base + t3 <= 2000 then 'no_full_text' when ex and base <= 2000 then 'tier1_only' else 'skipped' end as fit from l)
select doc_id, fit, fit = 'whole' as keep_full_text, fit in ('whole', 'no_full_text') as keep_tier3, fit = 'tier1_only' as add_repair_flag,
  case when fit = 'skipped' then 'content_too_large_skipped' when ex then 'updated' else 'created' end as status from f""")
def fit_content(t: Tables) -> DataFrame:
    cols = store.fit_content(
        200 + F.length("source"), F.col("n_chars"), (F.col("doc_id") % 50) * 40, F.col("doc_id") % 3 == 0, 2000)
    return t.documents.select("doc_id", *[c.alias(n) for n, c in cols.items()])


@query("""
with s as (select distinct cast(doc_id as varchar) as doc_id from documents where doc_id % 5 = 0),
n as (select cast(doc_id as varchar) as doc_id, doc_id % 3 = 0 as ours from documents where doc_id % 4 <> 0)
select c.doc_id, case when s.doc_id is null then 'unknown' when coalesce(n.ours, false) then 'delete' else 'not_ours' end as action
from (select distinct cast(doc_id as varchar) as doc_id from labels) c left join s on s.doc_id = c.doc_id left join n on n.doc_id = c.doc_id""")
def confirmed_deletes(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("doc_id"))
    notes = d.where("n % 4 <> 0").select(
        F.col("doc_id").alias("note_id"), F.when(F.col("n") % 3 == 0, F.array(F.lit(TAGS.ingested_by))).otherwise(tg.no_tags()).alias("tags"))
    confirmed = t.labels.select(F.col("doc_id").cast("string").alias("doc_id"))
    return store.confirmed_deletes(d.where("n % 5 = 0"), confirmed, notes)


# ---- repair -------------------------------------------------------------------------------------------------------

def _note_tags() -> Column:
    return F.array_compact(F.array(
        F.concat(F.lit("profile:"), "lang"), F.lit("source:arxiv"), F.lit(TAGS.ingested_by),
        F.nullif("text_tag", F.lit("")),
        *[F.when(F.col(c), tag) for c, tag in (
            ("text_terminal", TAGS.text_terminal), ("full_text", "full-text"), ("deep_extracted", TAGS.deep_extracted),
            ("tier2_terminal", TAGS.stage_terminal("tier2")), ("tier3_terminal", TAGS.stage_terminal("tier3")),
            ("archive_terminal", TAGS.archive_terminal))],
        F.when(~F.col("has_archive"), TAGS.archive_missing), F.lit(TAGS.repair_needed)))


def _flagged_notes(t: Tables) -> DataFrame:
    return t.notes_v.withColumn("tags", _note_tags()).withColumn(
        "archive_path", F.when(F.col("has_archive"), F.lit("arxiv/2026/01/x.pdf")))


@query(with_views("notes_v", body="""
select note_id, not has_archive and not archive_terminal as archive_retry, text_tag = '' as text_extraction,
  text_tag = 'text:abstract-only' and not text_terminal and has_archive as abstract_reextract,
  not full_text and max_score >= 8 and not text_terminal and not tier2_terminal as tier2_retry,
  not deep_extracted and max_score >= 9 and not text_terminal and not tier3_terminal as tier3_retry from notes_v"""))
def select_stages(t: Tables) -> DataFrame:
    stages = repair.select_stages(F.col("tags"), F.col("archive_path"), F.lit(False), F.col("max_score"))
    return _flagged_notes(t).select("note_id", *[c.alias(n) for n, c in stages.items()])


@query(with_views("notes_v", body="""
select note_id, has_archive as clear_archive_missing, has_archive and (text_tag in ('text:html', 'text:pdf') or (text_tag = 'text:abstract-only' and text_terminal))
  and (text_terminal or max_score < 8 or full_text) and (text_terminal or max_score < 9 or deep_extracted) as clear_repair_needed from notes_v"""))
def clearing(t: Tables) -> DataFrame:
    clear = repair.compute_clearing(F.col("tags"), F.col("archive_path"), F.col("max_score"))
    return _flagged_notes(t).select("note_id", *[c.alias(n) for n, c in clear.items()])


@query(with_views("notes_v", body="""+
q as (select n.note_id, n.lang as profile, e.ts from notes_v n join events e on e.event_id = n.note_id where n.note_id % 4 <> 0)
select note_id, profile, row_number() over (partition by profile order by ts, note_id) as queue_pos from q qualify row_number() over (partition by profile order by ts, note_id) <= 100"""))
def repair_queue(t: Tables) -> DataFrame:
    dated = t.notes_v.where("note_id % 4 <> 0").join(
        t.events_v.select(F.col("event_id").alias("note_id"), F.col("ts").alias("updated_at")), "note_id")
    return repair.repair_queues(dated.withColumn("profile", F.col("lang"))).select("note_id", "profile", "queue_pos")


SWEEP_SQL = """
a as (select *, note_id % 5 as arch_n, note_id % 4 as t2_n, note_id % 3 + 1 as t3_n, not has_archive and not archive_terminal as s_arch,
  not full_text and max_score >= 8 and not text_terminal and not tier2_terminal as s_t2,
  not deep_extracted and max_score >= 9 and not text_terminal and not tier3_terminal as s_t3 from notes_v),
b as (select *, has_archive or (s_arch and note_id % 2 = 0) as ha, archive_terminal or (s_arch and note_id % 2 = 1 and note_id % 4 = 1 and arch_n + 1 >= 3) as at2,
  case when text_tag = '' and note_id % 5 <> 0 then 'text:html' else text_tag end as tt1 from a),
c as (select *, text_tag = 'text:abstract-only' and not text_terminal and ha as s_re from b),
d as (select *, case when s_re and note_id % 3 = 0 then 'text:html' else tt1 end as tt, text_terminal or (s_re and note_id % 3 = 1) as fin,
  full_text or (s_t2 and note_id % 7 <> 0) as ft, tier2_terminal or (s_t2 and note_id % 14 = 0 and t2_n + 1 >= 3) as t2t,
  deep_extracted or (s_t3 and note_id % 11 <> 0) as dx, tier3_terminal or (s_t3 and note_id % 11 = 0 and t3_n + 1 >= 3) as t3t from c),
e as (select *, ha and (tt in ('text:html', 'text:pdf') or (tt = 'text:abstract-only' and fin)) and (fin or max_score < 8 or ft) and (fin or max_score < 9 or dx) as clear from d)
"""


@query(with_views("notes_v", body="+" + SWEEP_SQL + """
select note_id, cast(8 as bigint) as version, array_to_string(list_sort(list_filter(['profile:' || lang, 'source:arxiv', 'ingested-by:gleaner', nullif(tt, ''), case when fin then 'gleaner:text-terminal' end,
  case when ft then 'full-text' end, case when dx then 'gleaner:deep-extracted' end, case when t2t then 'gleaner:tier2-terminal' end, case when t3t then 'gleaner:tier3-terminal' end,
  case when at2 then 'gleaner:archive-terminal' end, case when not ha then 'gleaner:archive-missing' end, case when not clear then 'gleaner:repair-needed' end], lambda x: x is not null)), '|') as tags,
  cast(arch_n + case when s_arch and note_id % 2 = 1 and note_id % 4 = 1 then 1 else 0 end as int) as archive_attempts,
  cast(t2_n + case when s_t2 and note_id % 14 = 0 then 1 else 0 end as int) as tier2_attempts,
  cast(t3_n + case when s_t3 and note_id % 11 = 0 then 1 else 0 end as int) as tier3_attempts from e"""))
def repair_sweep(t: Tables) -> DataFrame:
    n = F.col("note_id")
    notes = _flagged_notes(t).select(
        "note_id", "title", "tags", "archive_path", F.lit(7).cast("bigint").alias("version"),
        F.array(F.struct(F.col("lang").alias("profile"), F.col("max_score").alias("score"), F.lit("r").alias("reason"))).alias("relevance"),
        F.lit("s").alias("summary"), F.lit(None).cast("string").alias("full_text"), F.lit(None).cast(TIER3).alias("tier3"),
        F.struct((n % 4).cast("int").alias("tier2_attempts"), (n % 3 + 1).cast("int").alias("tier3_attempts"),
                 (n % 5).cast("int").alias("archive_attempts")).alias("r"),
        F.lit("").alias("user_notes"), F.lit(None).cast("timestamp").alias("updated_at"))
    notes = notes.withColumn("repair", F.from_json(F.to_json("r"), REPAIR)).drop("r")

    archive = {
        "path": F.when(n % 2 == 0, "arxiv/new.pdf"),
        "failure_stage": F.when(n % 2 == 0, None).when(n % 4 == 1, "oversize").otherwise("http"),
        "error": F.lit("too\nbig")}
    text = {"text_tag": F.when(n % 5 != 0, "text:html")}
    again = {"outcome": F.when(n % 3 == 0, "upgrade").when(n % 3 == 1, "terminal").otherwise("transient"),
             "text_tag": F.lit("text:html")}
    tier2 = {"full_text": F.when(n % 7 != 0, "text"),
             "failure_stage": F.when(n % 7 != 0, None).when(n % 14 == 0, "parse").otherwise("timeout"),
             "error": F.lit("e")}

    def tier3(df):
        deep = F.from_json(F.lit('{"claims":["c"]}'), TIER3)
        return df.select("note_id", F.when(n % 11 != 0, deep).alias("tier3"),
                         F.when(n % 11 == 0, "validate").alias("failure_stage"), F.lit("e").alias("error"))

    swept = repair.repair_sweep(
        notes, archive_download=archive, text_extraction=text, re_extract=again, tier2_enrich=tier2, tier3_extract=tier3)
    return swept.select(
        "note_id", "version", F.array_join(F.array_sort("tags"), "|").alias("tags"), "repair.archive_attempts",
        "repair.tier2_attempts", "repair.tier3_attempts")


# ---- links --------------------------------------------------------------------------------------------------------

@query(f"""
with a as (select doc_id, {ARXIV_ID_SQL} as id, {ARXIV_ID_SQL.replace('doc_id', '(doc_id - 7)')} as prior from documents)
select 'builds_on' as type, cast(a.doc_id as varchar) as source_note_id, cast(b.doc_id as varchar) as target_note_id from a join a b on b.id = a.prior where a.doc_id >= 7 and a.doc_id % 5 <> 0""")
def builds_on(t: Tables) -> DataFrame:
    ref = F.concat(F.lit("Earlier work (arXiv:"), arxiv_like_id("(doc_id - 7)"), F.when(F.col("doc_id") % 5 == 0, "v2").otherwise(""), F.lit(")"))
    notes = t.documents.select(
        F.col("doc_id").cast("string").alias("note_id"), arxiv_canonical_url(arxiv_like_id()).alias("source_url"),
        F.array_compact(F.array(F.lit("no reference"), F.when(F.col("doc_id") >= 7, ref))).alias("builds_on"))
    return graph.resolve_builds_on(notes).select("type", "source_note_id", "target_note_id")


@query("""
with e as (select label as profile, vec_id as id, cast(embedding as double[]) as v from embeddings),
p as (select a.profile, a.id as source_id, b.id as target_id, round(list_cosine_similarity(a.v, b.v), 6) as score from e a join e b on a.profile = b.profile and a.id <> b.id)
select *, row_number() over (partition by profile, source_id order by score desc, target_id) as rank from p where score >= 0.3
qualify row_number() over (partition by profile, source_id order by score desc, target_id) <= 5""")
def related_top5(t: Tables) -> DataFrame:
    vectors = t.embeddings.select(F.col("label").alias("profile"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return graph.related_to(vectors, vectors, threshold=0.30)


@query("""
with e as (select label as profile, vec_id as id, cast(embedding as double[]) as v from embeddings),
p as (
  select a.profile, a.id as source_id, b.id as target_id, round(list_cosine_similarity(a.v, b.v), 6) as score
  from e a join e b on a.profile = b.profile and a.id <> b.id)
select *, row_number() over (partition by profile, source_id order by score desc, target_id) as rank from p where score >= 0.3
qualify row_number() over (partition by profile, source_id order by score desc, target_id) <= 5""")
def related_index(t: Tables) -> DataFrame:
    vectors = t.embeddings.select(F.col("label").alias("profile"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return graph.related_index(vectors, vectors, threshold=0.30)


# ---- digests and rendering ----------------------------------------------------------------------------------------

DIGEST_SQL = """
i as (select lang || '/' || source || '/' || (doc_id % 3) as run_id, lang as profile, cast(doc_id as varchar) as item_id, split_part(text, chr(10), 1) as title,
  cast(1 + n_chars % 10 as int) as score, 'https://d/' || doc_id as url from documents where 1 + n_chars % 10 >= 7),
r as (select lang || '/' || source || '/' || (doc_id % 3) as run_id, lang as profile, cast(count(*) as int) as sources_checked, '2024-01-31' as run_date from documents group by all),
a as (select run_id, count(*) as ingested, count(*) filter (where score >= 8) as high_relevance, max(score) as best_score from i group by run_id)"""


def _digest(t: Tables) -> tuple[DataFrame, DataFrame]:
    run = F.concat("lang", F.lit("/"), "source", F.lit("/"), (F.col("doc_id") % 3).cast("string")).alias("run_id")
    items = t.documents.select(
        run, F.col("lang").alias("profile"), F.col("doc_id").cast("string").alias("item_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.expr("cast(1 + n_chars % 10 as int)").alias("score"),
        F.concat(F.lit("https://d/"), F.col("doc_id").cast("string")).alias("url"), "source",
    ).where("score >= 7").drop("source")
    runs = t.documents.groupBy(run, F.col("lang").alias("profile")).agg(
        F.count(F.lit(1)).cast("int").alias("sources_checked")).withColumn("run_date", F.lit("2024-01-31"))
    return runs, items


@query(f"""with {DIGEST_SQL} select r.run_id, r.sources_checked, coalesce(ingested, 0) as ingested, coalesce(high_relevance, 0) as high_relevance,
  coalesce(best_score, 0) as best_score, case when ingested is null then 'No new relevant content found today.' end as message from r left join a on a.run_id = r.run_id""")
def digest(t: Tables) -> DataFrame:
    runs, items = _digest(t)
    return reports.digest_headers(runs, items, F.lit(8)).drop("profile", "run_date")


@query(f"""with {DIGEST_SQL},
n as (select *, row_number() over (partition by run_id order by score desc, item_id) as pos from i), p as (select *, (pos - 1) // 3 as page from n),
g as (select run_id, page, count(*) as n_items, to_json(list({{'item_id': item_id, 'title': title, 'score': score, 'url': url}} order by pos)) as all_items,
  coalesce(to_json(list({{'item_id': item_id, 'title': title, 'score': score, 'url': url}} order by pos) filter (where score >= 8)), '[]') as high from p group by run_id, page)
select r.run_id, coalesce(g.page, 0) as page, coalesce(g.n_items, 0) as n_items, md5(case when g.run_id is null then '{{"type":"digest","run_date":"2024-01-31","profile":"' || r.profile || '","stats":{{"sources_checked":' || sources_checked || ',"ingested":0}},"message":"No new relevant content found today."}}'
  else '{{"type":"digest","run_date":"2024-01-31","profile":"' || r.profile || '","stats":{{"sources_checked":' || sources_checked || ',"ingested":' || a.ingested || ',"high_relevance":' || a.high_relevance || '}},"page":' || g.page || ',"highlights":' || g.high || ',"all_ingested":' || g.all_items || '}}' end) as payload_md5
from r left join a on a.run_id = r.run_id left join g on g.run_id = r.run_id""")
def digest_pages(t: Tables) -> DataFrame:
    runs, items = _digest(t)
    headers = reports.digest_headers(runs, items, F.lit(8))
    return reports.digest_pages(headers, items, F.lit(8), page_size=3).select(
        "run_id", "page", "n_items", F.md5("payload").alias("payload_md5"))


def _structured(t: Tables) -> DataFrame:
    title = F.trim(F.substring_index("text", "\n", 1))
    claim = F.substring_index("text", "\n", 1)
    even = F.col("doc_id") % 2 == 0
    return t.documents.select(
        "doc_id", title.alias("title"), F.concat(F.lit("HTTPS://Example.COM/d/"), F.col("doc_id").cast("string"), F.lit("/?utm_x=1")).alias("source_url"),
        F.when(F.col("doc_id") % 4 == 0, tg.no_tags()).otherwise(F.array(F.concat(F.lit("profile:"), "lang"), F.lit(TAGS.ingested_by))).alias("tags"),
        ((F.col("n_chars") % 11) / 10).alias("confidence"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("arxiv/2026/01/"), F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("archive_path"),
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(claim).alias("summary"),
        F.when(even, F.struct(F.array(claim, F.lit("two")).alias("contributions"), F.lit("m1").alias("method"), F.lit("r1").alias("result"), F.lit("v1").alias("relevance"))).cast(TIER1).alias("tier1"),
        F.col("text").alias("full_text"),
        F.when(F.col("doc_id") % 6 == 0, F.struct(F.array(claim).alias("claims"), F.array(F.lit("d1"), F.lit("d2")).alias("datasets"), tg.no_tags().alias("builds_on"), F.array(F.lit("q")).alias("open_questions"), tg.no_tags().alias("potential_connections"))).cast(TIER3).alias("tier3"),
        F.when(F.col("doc_id") % 9 == 0, F.array().cast(tg.RELEVANCE)).otherwise(F.array(
            F.struct(F.col("lang").alias("profile"), F.expr("cast(1 + n_chars % 10 as int)").alias("score"), F.lit("because").alias("reason")),
            F.struct(F.lit("zz").alias("profile"), F.lit(2).alias("score"), F.lit("also").alias("reason")))).alias("relevance"),
        F.lit(None).cast(REPAIR).alias("repair"),
        F.when(F.col("doc_id") % 8 == 0, F.concat(F.lit("## User Notes\r\nkept "), F.col("doc_id").cast("string"), F.lit("\n## not a section\n"))).alias("user_notes"))


_CLAIM = "split_part(text, chr(10), 1)"
NOTE_FIELDS_SQL = f"""
s as (select doc_id, lang, n_chars, text, trim(split_part(text, chr(10), 1), ' ') as title, {_CLAIM} as claim from documents)"""
NOTE_TEXT_SQL = """'---' || chr(10) || 'note_type: summary' || chr(10) || 'namespace: gleaner' || chr(10) || 'source_url: https://example.com/d/' || doc_id || chr(10)
 || case when doc_id % 4 = 0 then 'tags: []' else 'tags:' || chr(10) || '  - profile:' || lang || chr(10) || '  - ingested-by:gleaner' end || chr(10)
 || 'confidence: ' || case n_chars % 11 when 0 then '0.0' when 10 then '1.0' else '0.' || (n_chars % 11) end || chr(10) || '---' || chr(10) || '# ' || title || chr(10) || chr(10)
 || '## Archive' || chr(10) || case when doc_id % 3 = 0 then 'path: arxiv/2026/01/' || doc_id || '.pdf' || chr(10) else '' end || chr(10)
 || case when doc_id % 2 = 0 then '## Summary' || chr(10) || '### Contributions' || chr(10) || '- ' || claim || chr(10) || '- two' || chr(10) || chr(10) || '### Method' || chr(10) || 'm1' || chr(10) || chr(10) || '### Result' || chr(10) || 'r1' || chr(10) || chr(10) || '### Relevance' || chr(10) || 'v1' || chr(10)
      when doc_id % 7 = 0 or claim = '' then '' else '## Summary' || chr(10) || claim || chr(10) end
 || case when text <> '' then chr(10) || '## Full Text' || chr(10) || text || chr(10) else '' end
 || case when doc_id % 6 = 0 then chr(10) || '## Claims' || chr(10) || '- ' || claim || chr(10) || chr(10) || '## Datasets & Benchmarks' || chr(10) || '- d1' || chr(10) || '- d2' || chr(10) || chr(10) || '## Builds On' || chr(10) || chr(10) || '## Open Questions' || chr(10) || '- q' || chr(10) else '' end
 || chr(10) || '## Profile Relevance' || chr(10) || case when doc_id % 9 = 0 then '' else '### ' || lang || chr(10) || 'Score: ' || (1 + n_chars % 10) || '/10' || chr(10) || 'because' || chr(10) || chr(10) || '### zz' || chr(10) || 'Score: 2/10' || chr(10) || 'also' || chr(10) end
 || chr(10) || case when doc_id % 8 = 0 then '## User Notes' || chr(13) || chr(10) || 'kept ' || doc_id || chr(10) || '## not a section' || chr(10) else '## User Notes' || chr(10) end"""

_NAMES = ("title", "source_url", "tags", "confidence", "archive_path", "summary", "tier1", "full_text", "tier3",
          "relevance", "repair", "user_notes")


@query(f"with {NOTE_FIELDS_SQL}, n as (select doc_id, {NOTE_TEXT_SQL} as note from s) select doc_id, length(note) as n_chars, md5(note) as note_md5 from n")
def render_note(t: Tables) -> DataFrame:
    return _structured(t).select("doc_id", render(**{n: F.col(n) for n in _NAMES}).alias("note")).select(
        "doc_id", F.length("note").alias("n_chars"), F.md5("note").alias("note_md5"))


@query(f"""with {NOTE_FIELDS_SQL} select cast(doc_id as varchar) as file, title, 'https://example.com/d/' || doc_id as source_url,
  case when doc_id % 4 = 0 then '' else 'profile:' || lang || '|ingested-by:gleaner' end as tags, case when doc_id % 3 = 0 then 'arxiv/2026/01/' || doc_id || '.pdf' end as archive_path,
  (n_chars % 11) / 10.0 as confidence, case when doc_id % 2 = 0 then claim || '|two' end as contributions, case when doc_id % 6 = 0 then 'd1|d2' end as datasets,
  case when text <> '' then md5(regexp_replace(text, '[\\r\\n]+$', '')) end as full_text_md5,
  case when doc_id % 9 = 0 then '' else lang || '=' || (1 + n_chars % 10) || ':because|zz=2:also' end as relevance,
  case when doc_id % 8 = 0 then '## User Notes' || chr(13) || chr(10) || 'kept ' || doc_id || chr(10) || '## not a section' || chr(10) else '## User Notes' || chr(10) end as user_notes
from s where title <> ''""")
def parse_note(t: Tables) -> DataFrame:
    texts = _structured(t).where("title <> ''").select(
        F.col("doc_id").cast("string").alias("file"), render(**{n: F.col(n) for n in _NAMES}).alias("text"))
    notes, _ = parse_notes(texts)
    shown = F.array_join(F.transform("relevance", lambda e: F.concat(
        e["profile"], F.lit("="), e["score"].cast("string"), F.lit(":"), e["reason"])), "|")
    return notes.select(
        "file", "title", "source_url", F.array_join("tags", "|").alias("tags"), "archive_path", "confidence",
        F.array_join("tier1.contributions", "|").alias("contributions"), F.array_join("tier3.datasets", "|").alias("datasets"),
        F.md5("full_text").alias("full_text_md5"), shown.alias("relevance"), "user_notes")


EDIT_SQL = """
r as (select '## Repair' || chr(10) || '- tier2_attempts: 2' || chr(10) || '- tier2_last_stage: "parse"' || chr(10)
  || '- tier2_last_error: "e f"' || chr(10) || '- tier3_attempts: 0' || chr(10) || '- tier3_last_stage: ""' || chr(10)
  || '- tier3_last_error: ""' || chr(10) || '- archive_attempts: 0' || chr(10) || '- archive_last_kind: ""' || chr(10)
  || '- archive_last_error: ""' || chr(10) as section, chr(10) || '## Profile Relevance' || chr(10) as mark),
u as (select *, case when doc_id % 8 = 0 then '## User Notes' || chr(13) || chr(10) || 'kept ' || doc_id || chr(10)
  || '## not a section' || chr(10) else '## User Notes' || chr(10) end as own from n),
e as (select doc_id, note, case doc_id % 5 when 0 then replace(note, mark, chr(10) || section || mark)
  when 1 then left(note, instr(note, mark) - 1) || mark || '### zz' || chr(10) || 'Score: 9/10' || chr(10) || 'new' || chr(10)
    || chr(10) || own
  when 2 then replace(left(note, length(note) - length(own) - 1), mark, chr(10) || section || mark)
  when 3 then left(note, instr(note, mark) - 1) || chr(10) || section || chr(10) || own
  else note end as edited from u, r)"""


@query(f"""with {NOTE_FIELDS_SQL}, n as (select doc_id, {NOTE_TEXT_SQL} as note from s), {EDIT_SQL}
select doc_id, length(edited) as n_chars, md5(edited) as note_md5 from e""")
def edit_note(t: Tables) -> DataFrame:
    """Counters added and set again, scores taken out and put back, notes without user notes or scores, untouched notes."""
    texts = _structured(t).select("doc_id", render(**{n: F.col(n) for n in _NAMES}).alias("note"))

    def counters(attempts: int) -> Column:
        return F.from_json(F.lit(f'{{"tier2_attempts":{attempts},"tier2_last_stage":"parse","tier2_last_error":"e\\nf"}}'), REPAIR)

    fresh = F.from_json(F.lit('[{"profile":"zz","score":9,"reason":"new"}]'), tg.RELEVANCE)
    note, gone = F.col("note"), F.lit(None).cast("string")
    kind = F.col("doc_id") % 5
    edited = F.when(kind == 0, with_repair(with_repair(note, counters(1)), counters(2))).when(
        kind == 1, with_relevance(set_section(note, "Profile Relevance", gone), fresh)).when(
        kind == 2, with_repair(set_section(note, "User Notes", gone), counters(2))).when(
        kind == 3, with_repair(set_section(note, "Profile Relevance", gone), counters(2))).otherwise(
        with_repair(note, F.lit(None).cast(REPAIR)))
    return texts.select("doc_id", edited.alias("edited")).select(
        "doc_id", F.length("edited").alias("n_chars"), F.md5("edited").alias("note_md5"))
