"""Aggregates and reports: rejection rates, funnels, metrics, digests, log mining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions.payloads import QUIET_MESSAGE, WRITE_OK
from gleaner.functions.text import existing_ids, slugs_in_use
from gleaner.operators.ordered import paged, running
from gleaner.vocabulary import BACKFILL_CONFIRM_LIMIT, NEGATIVE_EXAMPLES


def mark_rejected(items: DataFrame, rejected: DataFrame, keys: Sequence[str] = ("profile", "title")) -> DataFrame:
    """Add `rejected`, by exact match of the keys."""
    marks = rejected.select(*keys).distinct().withColumn("_r", F.lit(True))
    return items.join(marks, list(keys), "left").withColumn("rejected", F.coalesce("_r", F.lit(False))).drop("_r")


def rejection_rates(items: DataFrame, keys: Sequence[str] = ("profile",)) -> DataFrame:
    """Per tag: items carrying it, rejected ones among them, and the rate; a tag counts once per item.

    Popular tags are counted before the shuffle by partial aggregation.
    """
    return (
        items.select(*keys, "rejected", F.explode(F.array_distinct("tags")).alias("tag"))
        .groupBy(*keys, "tag")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("rejected").alias("n_rejected"))
        .withColumn("rate", F.round(F.col("n_rejected") / F.col("total"), 4))
    )


def run_stats(runs: DataFrame) -> DataFrame:
    return runs.withColumn("filtered", F.col("sources_checked") - F.col("ingested"))


def funnel(items: DataFrame, keys: Sequence[str] = ("profile", "source"), totals: bool = False) -> DataFrame:
    """Counts along the way of a candidate; `items` has decision, cache_hit and write_status columns."""
    passed = F.col("decision") == "pass"
    aggs = [
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(passed).alias("filter_pass"),
        F.count_if(~passed).alias("filter_drop"),
        F.count_if(passed).alias("inspected"),
        F.count_if(passed & F.col("cache_hit")).alias("cache_hits"),
        F.count_if(F.col("write_status") == "created").alias("created"),
        F.count_if(F.col("write_status") == "updated").alias("updated"),
        F.count_if(F.col("write_status").isNotNull() & ~F.col("write_status").isin(*WRITE_OK)).alias("failed"),
    ]
    return (items.rollup(*keys) if totals else items.groupBy(*keys)).agg(*aggs)


#: fixed values: the instruments and the labels each one may carry
INSTRUMENTS = {
    "run_starts": ("profile", "kind"),
    "run_completions": ("profile", "kind", "outcome"),
    "run_duration": ("profile", "kind", "outcome"),
    "active_runs": ("profile", "kind"),
    "candidates_fetched": ("profile", "source"),
    "articles_filtered": ("profile", "source", "decision"),
    "articles_inspected": ("profile", "source"),
    "cache_hits": ("profile", "source"),
    "store_writes": ("profile", "source", "status"),
    "repair_candidates": ("profile", "kind"),
    "model_validation_failures": ("tier",),
    "archive_missing": ("profile", "source"),
    "ingestion_stalls": ("profile", "reason"),
    "runs_skipped": ("profile", "reason"),
    "slug_collision_dedup_recovery": (),
    "slug_collision_reclaimed": (),
    "slug_collision_unresolved": (),
    "source_acquisition_errors": ("source", "kind"),
}


def reading(name: str, when: Column | None = None, value: Column | None = None, **labels: Column) -> Column:
    """One instrument's contribution of a row: (name, labels, value), null where `when` does not hold."""
    wanted = INSTRUMENTS[name]
    if set(labels) != set(wanted):
        raise ValueError(f"{name} takes the labels {wanted}")
    pairs = [F.struct(F.lit(k).alias("key"), labels[k].cast("string").alias("value")) for k in wanted]
    shown = F.array(*pairs) if pairs else F.array().cast("array<struct<key:string,value:string>>")
    amount = F.lit(1.0) if value is None else value.cast("double")
    row = F.struct(F.lit(name).alias("name"), shown.alias("labels"), amount.alias("value"))
    return row if when is None else F.when(when, row)


def metrics_long(df: DataFrame, readings: Sequence[Column]) -> DataFrame:
    """Long metric rows (name, labels, value) of any number of instruments from one pass over their rows."""
    return (
        df.select(F.inline(F.array_compact(F.array(*readings))))
        .groupBy("name", "labels").agg(F.sum("value").alias("value"))
        .select("name", F.map_from_entries("labels").alias("labels"), "value")
    )


def active_run_level(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Number of runs under way after each start and end, per profile."""
    steps = starts.select("profile", "run_id", F.col("started_at").alias("ts"), F.lit(1).alias("step")).unionByName(
        ends.select("profile", "run_id", F.col("completed_at").alias("ts"), F.lit(-1).alias("step")))
    return running(steps, ["profile"], [F.col("ts"), F.col("step"), F.col("run_id")],
                   {"active": ("sum", F.col("step"))}, [F.col("ts"), F.col("step")])


#: fixed values: upper bounds, in seconds, of the duration histogram
DURATION_BOUNDS = (1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0)


def histogram_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, bounds: Sequence[float] = DURATION_BOUNDS,
) -> DataFrame:
    """Quantile from bucket counts with linear interpolation inside the bucket.

    Only (key, bucket) counts are shuffled.  A rank beyond the last bound gives that bound.
    """
    v = F.col(value)
    bucket = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        bucket = F.when(v <= bounds[i], F.lit(i)).otherwise(bucket)
    counts = df.where(v.isNotNull()).groupBy(*keys, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(*keys)
    cum = (
        counts.withColumn("_cum", F.sum("_n").over(up_to)).withColumn("_all", F.sum("_n").over(everything))
        .withColumn("_rank", F.lit(q) * F.col("_all"))
        .where(F.col("_cum") >= F.col("_rank"))
        .groupBy(*keys).agg(F.min(F.struct("_b", "_cum", "_n", "_rank", "_all")).alias("_h"))
    )
    edges = F.array(F.lit(0.0), *[F.lit(b) for b in bounds])
    low, high = F.get(edges, F.col("_h._b")), F.get(edges, F.col("_h._b") + 1)
    inside = (F.col("_h._rank") - (F.col("_h._cum") - F.col("_h._n"))) / F.col("_h._n")
    return cum.select(
        *keys, F.col("_h._all").alias("n"),
        F.when(F.col("_h._b") == len(bounds), F.lit(bounds[-1])).otherwise(low + (high - low) * inside).alias("quantile"),
    )


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """Exact interpolated quantile per key without gathering a key's values in one task.

    Equal values are counted before the shuffle, and the two ranks around the quantile are found with chunked
    running counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(counts, keys, [F.col(value)], {"_cum": ("sum", F.col("_n"))}, F.col(value))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("n"))
    pos = F.lit(q) * (F.col("n") - 1)
    low, high = F.floor(pos), F.ceil(pos)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col(value)))

    return (
        ranked.join(totals, list(keys))
        .where(F.col("_cum") > low)
        .groupBy(*keys, "n")
        .agg(at(low).alias("_low"), at(high).alias("_high"))
        .select(*keys, "n", (F.col("_low") + (F.col("_high") - F.col("_low")) * (pos - low)).alias("quantile"))
    )


def squatter_mentions(logs: DataFrame) -> DataFrame:
    """One row per squatting id and log line; the n-th id of a line pairs with its n-th slug."""
    message = F.coalesce(F.col("message"), F.lit(""))
    detail = F.coalesce(F.nullif(F.col("detail"), F.lit("")), message)
    hits = logs.where(
        (F.col("level") == "WARNING")
        & ((F.col("status") == "slug_collision") | message.contains("slug_collision"))
    ).withColumn("_ids", existing_ids(detail)).withColumn("_slugs", slugs_in_use(detail))
    return hits.select(
        "timestamp", "source_url", "title", F.posexplode("_ids").alias("pos", "doc_id"), "_slugs",
    ).select("timestamp", "source_url", "title", "doc_id",
             F.nullif(F.get("_slugs", F.col("pos")), F.lit("")).alias("slug"))


def squatters(mentions: DataFrame) -> DataFrame:
    """Per squatting id: how often, when, and how many distinct slugs, urls and titles.

    Counted from one row per id and value, which map tasks aggregate first.
    """
    values = _mentioned(mentions, every=True)
    return values.groupBy("doc_id").agg(
        F.sum(F.when(F.col("field") == "mention", F.col("n")).otherwise(0)).alias("n"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        *[F.count_if(F.col("field") == field).alias(name) for field, name in (
            ("slug", "n_slugs"), ("source_url", "n_urls"), ("title", "n_titles"))])


def _mentioned(mentions: DataFrame, every: bool = False) -> DataFrame:
    """One row per id, field and value; with `every` also one per id for all its mentions."""
    named = [(c, F.nullif(F.col(c), F.lit(""))) for c in ("slug", "source_url", "title")]
    pairs = F.filter(
        F.array(*[F.struct(F.lit(kind).alias("field"), value.alias("value"))
                  for kind, value in [*named, *([("mention", F.lit("-"))] if every else [])]]),
        lambda p: p["value"].isNotNull(),
    )
    return mentions.select("doc_id", "timestamp", F.inline(pairs)).groupBy("doc_id", "field", "value").agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.count(F.lit(1)).alias("n"))


def squatter_values(mentions: DataFrame) -> DataFrame:
    """The distinct slugs, urls and titles behind `squatters`, one row each: a busy id needs no unbounded list."""
    return _mentioned(mentions).select("doc_id", "field", "value", "first_seen", "n")


#: fixed values
FLIP_STAGES = ("tier2_terminal_flip", "tier3_terminal_flip", "archive_terminal_flip")


def terminal_flips(logs: DataFrame) -> DataFrame:
    """WARNING rows per flip stage, zero included."""
    stages = logs.sparkSession.createDataFrame([(s,) for s in FLIP_STAGES], "sweep_stage STRING")
    counts = logs.where((F.col("level") == "WARNING") & F.col("sweep_stage").isin(*FLIP_STAGES)).groupBy(
        "sweep_stage").agg(F.count(F.lit(1)).alias("n"))
    return stages.join(counts, "sweep_stage", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def warning_counts(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("level").isin("WARNING", "ERROR", "CRITICAL")).groupBy("level").agg(
        F.count(F.lit(1)).alias("n"))


def digest_headers(runs: DataFrame, items: DataFrame, notify_immediate: Column) -> DataFrame:
    """One row per run: counts, and the quiet form where nothing was ingested."""
    per_run = items.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("ingested"), F.count_if(F.col("score") >= notify_immediate).alias("high_relevance"),
        F.max("score").alias("best_score"))
    return runs.join(per_run, "run_id", "left").select(
        *runs.columns,
        F.coalesce("ingested", F.lit(0)).alias("ingested"),
        F.coalesce("high_relevance", F.lit(0)).alias("high_relevance"),
        F.coalesce("best_score", F.lit(0)).alias("best_score"),
        F.when(F.col("ingested").isNull(), F.lit(QUIET_MESSAGE)).alias("message"),
    )


def digest_pages(headers: DataFrame, items: DataFrame, notify_immediate: Column, page_size: int = 200) -> DataFrame:
    """Digest payloads as JSON.

    The item lists of a run come in pages of a fixed size, so a run of any length is written whole without one task
    holding it; a run that fits one page gives one payload.
    """
    numbered = paged(items, ["run_id"], [F.col("score").desc(), F.col("item_id")],
                     [-F.col("score"), F.col("item_id")], page_size)
    entry = F.struct("pos", F.struct("item_id", "title", "score", "url").alias("item"))
    pages = numbered.groupBy("run_id", "page").agg(F.sort_array(F.collect_list(entry)).alias("_items"))
    all_items = F.transform("_items", lambda e: e["item"])
    stats = F.struct("sources_checked", "ingested", "high_relevance")
    full = F.to_json(F.struct(
        F.lit("digest").alias("type"), "run_date", "profile", stats.alias("stats"), "page",
        F.filter("_all", lambda i: i["score"] >= notify_immediate).alias("highlights"), F.col("_all").alias("all_ingested"),
    ))
    quiet = F.to_json(F.struct(
        F.lit("digest").alias("type"), "run_date", "profile",
        F.struct("sources_checked", F.lit(0).alias("ingested")).alias("stats"), "message"))
    return headers.join(pages.withColumn("_all", all_items), "run_id", "left").select(
        "run_id", "profile", F.coalesce("page", F.lit(0)).alias("page"), F.coalesce(F.size("_all"), F.lit(0)).alias("n_items"),
        F.when(F.col("ingested") == 0, quiet).otherwise(full).alias("payload"))


def backfill_estimate(plans: DataFrame) -> DataFrame:
    """days x categories x cap per profile; a profile without configuration counts 0."""
    rows = F.greatest("days", F.lit(0)) * F.coalesce("n_categories", F.lit(0)) * F.coalesce("max_results", F.lit(0))
    return plans.withColumn("estimate", rows.cast("bigint"))


def backfill_total(plans: DataFrame, limit: int = BACKFILL_CONFIRM_LIMIT) -> DataFrame:
    return backfill_estimate(plans).agg(F.coalesce(F.sum("estimate"), F.lit(0)).alias("total")).withColumn(
        "confirm_required", F.col("total") > limit)


def failure_classes(status: Column, degraded: Column) -> Column:
    """The classes of the failure report a run belongs to; they overlap."""
    return F.array_compact(F.array(
        F.when(status.isin("failed", "abandoned"), "failed"), F.when(status == "skipped", "skipped"),
        F.when(degraded, "degraded")))


def failure_report(runs: DataFrame, keys: Sequence[str] = (), last: int = 20, time: str = "completed_at") -> DataFrame:
    """The newest `last` runs of every class with the class's full count."""
    classed = runs.withColumn("class", F.explode(failure_classes(F.col("status"), F.col("degraded"))))
    counts = classed.groupBy(*keys, "class").agg(F.count(F.lit(1)).alias("class_total"))
    newest = Window.partitionBy(*keys, "class").orderBy(F.col(time).desc(), F.col("run_id").desc())
    top = classed.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= last)
    return top.join(counts, [*keys, "class"])


def source_errors(runs: DataFrame, keys: Sequence[str] = ("profile",), detail_chars: int = 300) -> DataFrame:
    """Acquisition errors by source and kind, with the lowest detail text as a sample."""
    return (
        runs.select(*keys, F.explode("source_acquisition_errors").alias("e"))
        .groupBy(*keys, F.col("e.source").alias("source"), F.col("e.kind").alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.substring("e.detail", 1, detail_chars)).alias("detail"))
    )


def failing_write_rate(writes: DataFrame, window: str = "15 minutes", time: str = "ts") -> DataFrame:
    """Writes that did not succeed, by status and time window."""
    return (
        writes.where(~F.col("status").isin(*WRITE_OK))
        .groupBy(F.window(time, window).alias("w"), "status").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "status", "n")
    )


def completion_rate(runs: DataFrame, window: str = "1 hour", time: str = "completed_at") -> DataFrame:
    return (
        runs.groupBy(F.window(time, window).alias("w"), "profile", "outcome").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "profile", "outcome", "n")
    )


def negative_examples(rejected: DataFrame, limit: int = NEGATIVE_EXAMPLES, chars: int = 200) -> DataFrame:
    """Per profile a text block of at most `limit` rejected titles, newest id first."""
    newest = Window.partitionBy("profile").orderBy(F.col("pos").desc())
    line = F.concat(F.lit('- "'), F.substring("title", 1, chars), F.lit('" (rejected)'))
    return (
        rejected.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= limit)
        .groupBy("profile")
        .agg(F.count(F.lit(1)).alias("n"),
             F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", line.alias("line")))),
                                      lambda r: r["line"]), "\n").alias("block"))
    )


def archive_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes by source, month and suffix."""
    return files.groupBy("source", "year", "month", "ext").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
