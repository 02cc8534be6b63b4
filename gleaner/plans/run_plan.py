"""A whole run: repair, feedback, acquire, ingest, finalise - each a DataFrame step, each written once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import tags as tg
from gleaner.functions.text import note_path, slugify, template_vars
from gleaner.operators import cascade, graph, ledger, predicates, reports, scoring, store
from gleaner.operators.cascade import Model
from gleaner.operators.scoring import Scorer
from gleaner.schemas import SOURCE_ERROR, TIER1, TIER3
from gleaner.session import checkpoint_dir
from gleaner.vocabulary import LEDGER_WINDOW

KINDS = ("scheduled", "manual", "backfill")


@dataclass(frozen=True)
class RunPlan:
    """What kind of run this is and what follows from it."""

    kind: str = "scheduled"
    profiles: Sequence[str] | None = None
    window: tuple[date, date] | None = None
    lookback_days: int = 3
    now: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of run: {self.kind}")
        if (self.kind == "backfill") != (self.window is not None):
            raise ValueError("a backfill needs a window, other runs take none")

    @property
    def skip_repair(self) -> bool:
        return self.kind == "backfill"

    @property
    def skip_cache_hits(self) -> bool:
        return self.kind == "backfill"

    @property
    def notify(self) -> bool:
        return self.kind != "backfill"


#: gives the candidates of a run; the source protocol as one function
ItemProvider = Callable[[SparkSession, RunPlan], DataFrame]


@dataclass(frozen=True)
class Past:
    """What a run knows of earlier ones; every table is optional.

    `ledger` are run rows, `rejected` is (profile, title, pos) for the scoring prompt made from `template`,
    `source_errors` is (profile, source, kind, detail) of this run's acquisition, `sinks` the notification sinks, and
    `vectors` is (profile, id, vector) by note id.
    """

    ledger: DataFrame | None = None
    rejected: DataFrame | None = None
    template: str | None = None
    source_errors: DataFrame | None = None
    sinks: DataFrame | None = None
    vectors: DataFrame | None = None


@dataclass(frozen=True)
class Plugs:
    """The pluggable parts of a run."""

    provider: ItemProvider
    scorer: Scorer | None
    tier1: Model | None = None
    #: text of a paper's document, for papers whose page gave none and whose score reaches the full-text threshold
    tier2: Model | None = None
    tier3: Model | None = None


def feedback_prompts(profiles: DataFrame, rejected: DataFrame, template: str) -> DataFrame:
    """Scoring prompt per profile.

    `rejected` is (profile, title, pos).  A placeholder that is not known leaves the template as it is.
    """
    blocks = reports.negative_examples(rejected).select("profile", "block")
    filled = F.lit(template)
    for name, value in (
        ("profile_description", F.coalesce("description", F.lit(""))),
        ("negative_examples", F.coalesce("block", F.lit(""))),
        ("min_score_in_results", F.col("relevance").cast("string")),
    ):
        filled = F.replace(filled, F.lit("{" + name + "}"), value)
    known = F.array(F.lit("profile_description"), F.lit("negative_examples"), F.lit("min_score_in_results"))
    bad = F.size(F.array_except(template_vars(F.lit(template)), known)) > 0
    return profiles.join(blocks, "profile", "left").select(
        "profile", F.when(bad, F.lit(template)).otherwise(filled).alias("prompt"))


def acquire(spark: SparkSession, plan: RunPlan, profiles: DataFrame, notes: DataFrame, plugs: Plugs,
            prompts: DataFrame | None = None) -> DataFrame:
    """Candidates of all profiles: in the window, not in the store for a backfill, scored and past the gate."""
    items = plugs.provider(spark, plan)
    if plan.profiles is not None:
        items = items.where(F.col("profile").isin(list(plan.profiles)))
    if plan.window is not None:
        items = predicates.backfill_window(items, *plan.window)
    else:
        items = predicates.lookback(items, plan.lookback_days, plan.now)
    if plan.skip_cache_hits:
        items = store.skip_cache_hits(items, notes)
    scores = scoring.score_candidates(items, plugs.scorer, prompts=prompts)
    limits = profiles.select("profile", F.col("relevance").alias("_limit"), "full_text", "deep_extract")
    scored = scoring.attach_scores(items, scores).join(limits, "profile")
    gated = store.flag_archive_terminal(scoring.relevance_gate(scored, "_limit").drop("_limit"), notes)
    # the scorer is foreign code and need not give the same answer twice: keep what it said
    checkpoint_dir(spark)
    return gated.checkpoint()


def with_document_text(papers: DataFrame, wanted: Column, plugs: Plugs) -> DataFrame:
    """Papers with `document_text`: the plugged extractor's text for rows that are wanted and have no page."""
    if plugs.tier2 is None:
        return papers.withColumn("document_text", F.lit(None).cast("string"))
    todo = F.coalesce(wanted & F.col("html").isNull(), F.lit(False))
    read = scoring.map_batches(papers.where(todo), plugs.tier2, "document_text")
    return read.unionByName(papers.where(~todo).withColumn("document_text", F.lit(None).cast("string"))).checkpoint()


def enrich(passed: DataFrame, plugs: Plugs) -> DataFrame:
    """Tiers by score, then the tag list.  `html` is the fetched page, null where nothing was fetched."""
    if "html" not in passed.columns:
        passed = passed.withColumn("html", F.lit(None).cast("string"))
    # papers are read by tier 2, for high scores only; feed items bring their page's text along
    paper = F.col("source") == "arxiv"
    wanted = ~paper | (F.col("score") >= cascade.threshold("full_text", F.col("full_text")))
    papers = cascade.extract_text(with_document_text(
        passed.where(paper).withColumn("html", F.when(wanted, F.col("html"))), wanted, plugs), pdf_text="document_text")
    articles = cascade.article_text(passed.where(~paper).withColumn("document_text", F.lit(None).cast("string")))
    texts = papers.unionByName(articles)
    found = F.col("extracted_text").isNotNull()
    df = texts.withColumn("has_text", found & ~paper).withColumn("tier2_ok", found)
    gates = cascade.cascade_gates(
        F.col("score"), F.col("has_text"), F.lit(0), F.lit(0), full_text=F.col("full_text"),
        deep_extract=F.col("deep_extract"))
    gates["run_tier2"] = gates["run_tier2"] & paper
    gates["tier2_terminal"] = gates["tier2_terminal"] & paper
    df = df.withColumns(gates)
    for name, gate, model, run in (
        ("tier1", "run_tier1", plugs.tier1, cascade.tier1_enrich),
        ("tier3", "_deep", plugs.tier3, cascade.tier3_extract),
    ):
        if name == "tier3":
            df = df.withColumn("_deep", F.col("tier3_if_text") & found & F.col("keep_text"))
        if model is not None:
            df = run(df, model, gate).checkpoint()
        else:
            ddl = TIER1 if name == "tier1" else TIER3
            df = df.withColumn(name, F.lit(None).cast(ddl))
        df = df.withColumn(f"{name}_ok", F.col(name).isNotNull())
    done = cascade.cascade_outcome(df)
    common = dict(
        profile=F.col("profile"), archive_missing=F.col("archive_missing"), has_full_text=F.col("full_text_kept"),
        has_tier3=F.col("has_tier3"), repair_flag=F.col("repair_flag"), tier2_terminal=F.col("tier2_terminal"),
        tier3_terminal=F.col("tier3_terminal"))
    arxiv = tg.build_tags("arxiv", categories=F.col("categories"), arxiv_id=F.col("item_id"),
                          text_tag=F.col("text_tag"), **common)
    rss = tg.build_tags("rss", source_tag=F.col("source_tag"), feed_slug=slugify(F.coalesce("feed_name", F.lit(""))),
                        **common)
    summary = F.when(paper, tg.summary_text(
        "arxiv", tier1_attempted=F.col("run_tier1"), tier1_ok=F.col("tier1_ok"), abstract=F.col("abstract"),
    )).otherwise(tg.summary_text(
        "rss", tier1_attempted=F.col("run_tier1"), tier1_ok=F.col("tier1_ok"), abstract=F.col("abstract"),
        extracted=F.col("extracted_text")))
    return (
        done.withColumn("tags", F.when(paper, arxiv).otherwise(rss)).withColumn("summary", summary)
        .withColumn("full_text", F.when(F.col("full_text_kept"), F.col("extracted_text")))
        .withColumn("path", note_path(F.col("source"), F.col("source_tag"), F.col("published")))
    )


@dataclass(frozen=True)
class RunResult:
    notes: DataFrame
    writes: DataFrame
    runs: DataFrame
    funnel: DataFrame
    decisions: DataFrame
    #: (run_id, profile, kind, sink, type, item_id) to deliver; none for a backfill or without sinks
    notices: DataFrame | None
    edges: DataFrame


def ledger_rows(plan: RunPlan, profiles: DataFrame, decisions: DataFrame, ingested: DataFrame, past: Past,
                finished: datetime) -> DataFrame:
    """One row per profile of the run, also for those whose sources gave nothing, with stalls and outcome."""
    started, stamp = plan.now.isoformat(), finished.isoformat()
    checked = decisions.groupBy("profile").agg(F.count(F.lit(1)).cast("int").alias("sources_checked"))
    written = ingested.groupBy("profile").agg(F.count(F.lit(1)).cast("int").alias("ingested"))
    rows = profiles.select("profile")
    if plan.profiles is not None:
        rows = rows.where(F.col("profile").isin(list(plan.profiles)))
    rows = rows.join(checked, "profile", "left").join(written, "profile", "left")
    none = F.array().cast(f"array<{SOURCE_ERROR}>")
    if past.source_errors is None:
        rows = rows.withColumn("source_acquisition_errors", none)
    else:
        # a few per source of the profile
        errors = past.source_errors.groupBy("profile").agg(
            F.sort_array(F.collect_list(F.struct("source", "kind", "detail"))).alias("source_acquisition_errors"))
        rows = rows.join(errors, "profile", "left").withColumn(
            "source_acquisition_errors", F.coalesce("source_acquisition_errors", none))
    window = F.lit(None).cast("map<string,string>") if plan.window is None else F.create_map(
        F.lit("from"), F.lit(plan.window[0].isoformat()), F.lit("to"), F.lit(plan.window[1].isoformat()))
    rows = rows.select(
        F.concat(F.col("profile"), F.lit(f"/{started}")).alias("run_id"), "profile", F.lit(plan.kind).alias("kind"),
        F.lit("completed").alias("status"), window.alias("run_range"), F.lit(started).alias("started_at"),
        F.lit(stamp).alias("completed_at"), F.lit((finished - plan.now).total_seconds()).alias("duration_seconds"),
        F.coalesce("sources_checked", F.lit(0)).alias("sources_checked"),
        F.coalesce("ingested", F.lit(0)).alias("ingested"), F.lit(None).cast("string").alias("error"),
        "source_acquisition_errors")
    both = rows.withColumn("_new", F.lit(True))
    if past.ledger is not None:
        newest = ledger.recent_per_profile(past.ledger, LEDGER_WINDOW).select(
            *[F.col(c).cast(t) if c in past.ledger.columns else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes])
        both = newest.withColumn("_new", F.lit(False)).unionByName(both)
    flagged = ledger.stall_flags(both).where("_new")
    reasons = ledger.degraded_reasons(
        F.size("source_acquisition_errors") > 0, F.col("ingestion_stall"), F.col("fetch_stall"))
    return flagged.withColumn("degraded_reasons", reasons).withColumn(
        "degraded", F.size("degraded_reasons") > 0).withColumn(
        "outcome", ledger.run_outcome(F.col("status"), F.col("degraded_reasons"))).drop("_new")


def run(spark: SparkSession, plan: RunPlan, profiles: DataFrame, notes: DataFrame, plugs: Plugs,
        repair: Callable[[DataFrame], DataFrame] | None = None, past: Past = Past(),
        finished: datetime | None = None, content_limit: int | None = None) -> RunResult:
    """One run over all profiles: repair, prompts, acquire, enrich, write, ledger, notices, edges.

    Returns the new note table and everything else a run leaves behind; the caller decides where each is written.
    """
    if repair is not None and not plan.skip_repair:
        notes = repair(notes)
    prompts = None
    if past.template is not None:
        none = spark.createDataFrame([], "profile STRING, title STRING, pos INT")
        prompts = feedback_prompts(profiles, none if past.rejected is None else past.rejected, past.template)
    decisions = acquire(spark, plan, profiles, notes, plugs, prompts)
    enriched = enrich(decisions.where(F.col("decision") == "pass"), plugs)
    content = [c for c in ("summary", "full_text", "tier1", "tier3", "path") if c in notes.columns]
    items = enriched.select(
        "profile", "item_id", "title", "source_url", F.col("score").cast("int").alias("score"),
        F.coalesce("reason", F.lit("")).alias("reason"), "tags", F.lit(None).cast("string").alias("user_notes"),
        *content)
    new_notes, writes = store.upsert_notes(notes, items, content_limit=content_limit)
    writes = writes.checkpoint()
    hits = store.cache_lookup(decisions, notes)
    # a profile that dropped an item has no write of its own, whoever else wrote it
    outcome = writes.groupBy("profile", "item_id").agg(F.min("status").alias("write_status"))
    funnel = reports.funnel(hits.join(outcome, ["profile", "item_id"], "left"))
    ingested = items.join(writes.where(F.col("status").isin("created", "updated")), ["profile", "item_id"], "left_semi")
    done = finished or max(datetime.now(timezone.utc), plan.now)
    runs = ledger_rows(plan, profiles, decisions, ingested, past, done)
    notices = None
    if plan.notify and past.sinks is not None:
        of_run = ingested.join(runs.select("profile", "run_id"), "profile").select("run_id", "item_id", "score")
        notices = predicates.notify_sinks(past.sinks, runs.select("run_id", "profile", "kind"), of_run)
    builds_on = F.col("tier3.builds_on") if "tier3" in new_notes.columns else F.lit(None).cast("array<string>")
    edges = link(new_notes.select("note_id", "source_url", builds_on.alias("builds_on")), past.vectors)
    return RunResult(new_notes, writes, runs, funnel, decisions, notices, edges)


def link(notes_with_refs: DataFrame, vectors: DataFrame | None = None, threshold: float = 0.75) -> DataFrame:
    """Edges of the ingested notes: references, and similar notes where vectors are given."""
    edges = graph.resolve_builds_on(notes_with_refs)
    if vectors is None:
        return edges
    return edges.unionByName(graph.related_edges(graph.related_to(vectors, vectors, threshold=threshold)))
