"""Repair of incomplete notes: which stages run, what they change, when a flag clears."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions.markdown import repair_keys
from gleaner.functions.tags import first_tag, has_prefix, has_tag, max_profile_score, merge_tags
from gleaner.functions.text import one_line, year_month_from_path
from gleaner.operators.cascade import threshold
from gleaner.operators.ordered import running
from gleaner.operators.store import apply_rejection_guard, trimmed
from gleaner.schemas import REPAIR
from gleaner.session import checkpoint_dir
from gleaner.vocabulary import (
    ATTEMPT_CAP, COUNTED_FAILURE_STAGES, FULL_TEXT, REPAIR_LIMIT, TAGS, TEXT_ABSTRACT, TEXT_HTML, TEXT_PDF,
    TagVocabulary,
)

#: what a stage does: a function of the selected rows giving one outcome row per note_id, or outcome columns
Hook = Callable[[DataFrame], DataFrame] | dict[str, Column]


def classify_failure(failure_stage: Column) -> Column:
    """counted: running again would fail the same way; transient: everything else; null without a failure."""
    return F.when(failure_stage.isin(*COUNTED_FAILURE_STAGES), "counted").when(failure_stage.isNotNull(), "transient")


def repair_queue(notes: DataFrame, profile: str, limit: int = REPAIR_LIMIT, vocab: TagVocabulary = TAGS) -> DataFrame:
    """The profile's notes that need repair, oldest first."""
    wanted = notes.where(has_tag(F.col("tags"), vocab.repair_needed) & has_tag(F.col("tags"), f"profile:{profile}"))
    return wanted.orderBy("updated_at", "note_id").limit(limit)


def repair_queues(notes: DataFrame, limit: int = REPAIR_LIMIT, profile: str = "profile") -> DataFrame:
    """`repair_queue` of every profile at once, with the place in the queue."""
    oldest = Window.partitionBy(profile).orderBy("updated_at", "note_id")
    return notes.withColumn("queue_pos", F.row_number().over(oldest)).where(F.col("queue_pos") <= limit)


def select_stages(
    tags: Column, archive_path: Column, archived_now: Column, score: Column, *,
    full_text: Column | None = None, deep_extract: Column | None = None, vocab: TagVocabulary = TAGS,
) -> dict[str, Column]:
    """Five independent decisions."""
    has = lambda t: has_tag(tags, t)
    final = has(vocab.text_terminal)
    return {
        "archive_retry": has(vocab.archive_missing) & ~has(vocab.archive_terminal),
        "text_extraction": ~has_prefix(tags, "text:"),
        "abstract_reextract": has(TEXT_ABSTRACT) & ~final & (archive_path.isNotNull() | archived_now),
        "tier2_retry": ~has(FULL_TEXT) & (score >= threshold("full_text", full_text)) & ~final
        & ~has(vocab.stage_terminal("tier2")),
        "tier3_retry": ~has(vocab.deep_extracted) & (score >= threshold("deep_extract", deep_extract)) & ~final
        & ~has(vocab.stage_terminal("tier3")),
    }


def apply_reextraction(tags: Column, outcome: Column, new_tag: Column, vocab: TagVocabulary = TAGS) -> Column:
    """upgrade: the new text tag takes the abstract tag's place; terminal: text is final; transient: unchanged."""
    return (
        F.when(outcome == "upgrade", F.transform(tags, lambda t: F.when(t == TEXT_ABSTRACT, new_tag).otherwise(t)))
        .when(outcome == "terminal", F.array_union(tags, F.array(F.lit(vocab.text_terminal))))
        .otherwise(tags)
    )


def compute_clearing(
    tags: Column, archive_path: Column, score: Column, *, full_text: Column | None = None,
    deep_extract: Column | None = None, vocab: TagVocabulary = TAGS,
) -> dict[str, Column]:
    """Whether the missing-archive and the repair flag come off."""
    has = lambda t: has_tag(tags, t)
    final = has(vocab.text_terminal)
    text_ok = has(TEXT_HTML) | has(TEXT_PDF) | (has(TEXT_ABSTRACT) & final)
    tier2_ok = final | (score < threshold("full_text", full_text)) | has(FULL_TEXT)
    tier3_ok = final | (score < threshold("deep_extract", deep_extract)) | has(vocab.deep_extracted)
    archived = archive_path.isNotNull()
    return {"clear_archive_missing": archived, "clear_repair_needed": archived & text_ok & tier2_ok & tier3_ok}


def record_counted_failure(
    repair: Column, tags: Column, stage: str, failed: Column, failure_stage: Column, error: Column,
    cap: int = ATTEMPT_CAP, vocab: TagVocabulary = TAGS,
) -> tuple[Column, Column]:
    """(counters, tags) after a counted failure of one stage; the terminal tag is added on reaching the cap."""
    attempts, last, message = repair_keys(stage)
    base = F.coalesce(repair, F.from_json(F.lit("{}"), REPAIR))
    bumped = F.coalesce(base[attempts], F.lit(0)) + 1
    new = (
        base.withField(attempts, bumped).withField(last, F.coalesce(failure_stage, F.lit("")))
        .withField(message, one_line(F.coalesce(error, F.lit(""))))
    )
    flagged = F.array_union(tags, F.array(F.lit(vocab.stage_terminal(stage))))
    return F.when(failed, new).otherwise(repair), F.when(failed & (bumped >= cap), flagged).otherwise(tags)


def attempts_and_cap(attempts: DataFrame, cap: int = ATTEMPT_CAP, hot_rows: int | None = None) -> DataFrame:
    """Running count of counted failures per note and stage, the terminal flag, and the row that flips it."""
    counted = (classify_failure(F.col("failure_stage")) == "counted").cast("bigint")
    rows = running(
        attempts.withColumn("_counted", F.coalesce(counted, F.lit(0))), ["note_id", "stage"],
        [F.col("ts"), F.col("attempt_id")], {"n_counted": ("sum", F.col("_counted"))},
        [F.col("ts"), F.col("attempt_id")], hot_rows=hot_rows)
    return (
        rows.withColumn("terminal", F.col("n_counted") >= cap)
        .withColumn("flips", (F.col("_counted") == 1) & (F.col("n_counted") == cap))
        .drop("_counted")
    )


def archive_retry_args(notes: DataFrame) -> DataFrame:
    """(note_id, arxiv_id, year, month, problem): what a repeated archive download needs."""
    source = first_tag(F.col("tags"), "source:")
    arxiv = first_tag(F.col("tags"), "arxiv-id:")
    when = year_month_from_path(F.col("path"))
    return notes.select(
        "note_id", arxiv.alias("arxiv_id"), when["year"].alias("year"), when["month"].alias("month"),
        F.when(F.coalesce(source, F.lit("")) != "arxiv", "unsupported_source")
        .when(arxiv.isNull() | when["year"].isNull(), "resolve").alias("problem"),
    )


def _with_outcomes(df: DataFrame, selected: Column, hook: Hook, fields: str) -> DataFrame:
    """Add the stage's outcome columns, null where the stage did not run.

    Column outcomes are computed in place.  The rows of a function are checkpointed: it may call a model, so it runs
    once, and the following stages build on what it gave.  They are few, since a sweep visits a capped queue.
    """
    names = fields.split()
    if isinstance(hook, dict):
        return df.withColumns({f"_{f}": F.when(selected, hook[f]) for f in names})
    checkpoint_dir(df.sparkSession)
    rows = hook(df.where(selected)).selectExpr("note_id", *[f"{f} AS _{f}" for f in names]).checkpoint()
    return df.join(rows, "note_id", "left")


def repair_sweep(
    notes: DataFrame, *, archive_download: Hook | None = None, text_extraction: Hook | None = None,
    re_extract: Hook | None = None, tier2_enrich: Hook | None = None, tier3_extract: Hook | None = None,
    now: Column | None = None, content_limit: int | None = None, vocab: TagVocabulary = TAGS,
) -> DataFrame:
    """One pass over queued notes, stages in order; a failed stage leaves the row as it was.

    A hook, as a function, gets the rows its stage selected and returns one outcome row per note_id; as columns it
    gives the same outcomes by name:
    archive_download (path, failure_stage, error), text_extraction (text_tag), re_extract (outcome, text_tag),
    tier2_enrich (full_text, failure_stage, error), tier3_extract (tier3, failure_stage, error).
    With a `content_limit` the size ladder is applied to what the stages gave.  Every visited note gets a new version,
    unless it is still too large without its deep sections.
    """
    original = F.col("_original")
    score = F.col("_score")
    df = notes.withColumn("_before", F.struct(*notes.columns)).withColumn("_original", F.col("tags")).withColumn("_score", max_profile_score(F.col("relevance")))
    first = select_stages(original, F.col("archive_path"), F.lit(False), score, vocab=vocab)
    for name, cond in first.items():
        df = df.withColumn(f"_{name}", cond)
    df = df.withColumn("_archived", F.lit(False))

    def join(todo: Column, hook: Hook | None, fields: str) -> DataFrame | None:
        return None if hook is None else _with_outcomes(df, todo, hook, fields)

    def count_failure(frame: DataFrame, stage: str) -> DataFrame:
        failed = F.coalesce(classify_failure(F.col("_failure_stage")) == "counted", F.lit(False))
        counters, tags = record_counted_failure(
            F.col("repair"), F.col("tags"), stage, failed, F.col("_failure_stage"), F.col("_error"), vocab=vocab)
        return frame.withColumn("_tags2", tags).withColumn("repair", counters).withColumn(
            "tags", F.col("_tags2")).drop("_tags2", "_failure_stage", "_error")

    if (step := join(F.col("_archive_retry"), archive_download, "path failure_stage error")) is not None:
        df = count_failure(
            step.withColumn("_archived", F.col("_path").isNotNull())
            .withColumn("archive_path", F.coalesce("_path", "archive_path")).drop("_path"), "archive")
    if (step := join(F.col("_text_extraction"), text_extraction, "text_tag")) is not None:
        fits = F.col("_text_tag").isNotNull() & ~has_prefix(F.col("tags"), "text:")
        df = step.withColumn(
            "tags", F.when(fits, F.array_append("tags", F.col("_text_tag"))).otherwise(F.col("tags"))
        ).drop("_text_tag")
    # a fresh archive makes the abstract-only text worth another try, judged by the tags the note came with
    again = F.col("_abstract_reextract") | (
        F.col("_archived") & has_tag(original, TEXT_ABSTRACT) & ~has_tag(original, vocab.text_terminal))
    if (step := join(again & F.col("archive_path").isNotNull(), re_extract, "outcome text_tag")) is not None:
        df = step.withColumn(
            "tags", apply_reextraction(F.col("tags"), F.col("_outcome"), F.col("_text_tag"), vocab)
        ).drop("_outcome", "_text_tag")
    if (step := join(F.col("_tier2_retry"), tier2_enrich, "full_text failure_stage error")) is not None:
        ok = F.col("_full_text").isNotNull()
        df = count_failure(
            step.withColumn("tags", F.when(ok, F.array_union("tags", F.array(F.lit(FULL_TEXT)))).otherwise(F.col("tags")))
            .withColumn("full_text", F.coalesce("_full_text", "full_text")).drop("_full_text"), "tier2")
    if (step := join(F.col("_tier3_retry"), tier3_extract, "tier3 failure_stage error")) is not None:
        ok = F.col("_tier3").isNotNull()
        df = count_failure(
            step.withColumn("tags", F.when(ok, F.array_union("tags", F.array(F.lit(vocab.deep_extracted))))
                            .otherwise(F.col("tags")))
            .withColumn("tier3", F.coalesce("_tier3", "tier3")).drop("_tier3"), "tier3")

    clear = compute_clearing(F.col("tags"), F.col("archive_path"), score, vocab=vocab)
    dropped = F.array_compact(F.array(
        F.when(clear["clear_archive_missing"], vocab.archive_missing),
        F.when(clear["clear_repair_needed"], vocab.repair_needed)))
    kept = F.filter("tags", lambda t: ~F.array_contains(F.col("_dropped"), t))
    df = df.withColumn("_dropped", dropped).withColumn("_new", kept)
    df = df.withColumn("tags", apply_rejection_guard(merge_tags(original, F.col("_new"), vocab), vocab))
    df = df.withColumn("swept", F.lit(True))
    if content_limit is not None:
        df = trimmed(df, content_limit, F.lit(True), vocab).withColumn("swept", F.col("fit") != "skipped").drop("fit")
    when = F.current_timestamp() if now is None else now
    touched = df.withColumn("version", F.col("version") + 1).withColumn("updated_at", when)
    # a note that does not fit even without its deep sections stays as it was, in every column
    return touched.select(
        *[F.when(F.col("swept"), F.col(c)).otherwise(F.col("_before")[c]).alias(c) for c in notes.columns], "swept")
