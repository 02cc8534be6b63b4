"""Row filters and checks over candidates, runs, logs, urls and configuration."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.dates import day_bounds
from gleaner.functions.text import slugify, strip
from gleaner.vocabulary import MAX_DOWNLOAD_BYTES


def lookback(df: DataFrame, days: int, now: datetime, column: str = "published") -> DataFrame:
    """Rows published within the last `days`, the bound included."""
    return df.where(F.col(column) >= F.lit(now - timedelta(days=days)))


def backfill_window(df: DataFrame, start: date, end: date, column: str = "published") -> DataFrame:
    """Rows of the half-open day range; takes the place of the lookback."""
    low, high = day_bounds(start, end)
    return df.where((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def require_fields(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows where a needed field is null or blank."""
    types = dict(df.dtypes)
    for name in columns:
        cond = F.col(name).isNotNull()
        if types[name] == "string":
            cond = cond & (strip(F.col(name)) != "")
        df = df.where(cond)
    return df


def filter_runs(
    df: DataFrame, profile: str | None = None, statuses: Iterable[str] = (), degraded_only: bool = False
) -> DataFrame:
    statuses = list(statuses)
    if profile is not None:
        df = df.where(F.col("profile") == profile)
    if statuses:
        df = df.where(F.col("status").isin(statuses))
    return df.where(F.col("degraded")) if degraded_only else df


def filter_logs(
    df: DataFrame, levels: Iterable[str] = (), run_id: object = None, sweep_stage: str | None = None,
    contains: str | None = None,
) -> DataFrame:
    levels = list(levels)
    if levels:
        df = df.where(F.col("level").isin(levels))
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    if sweep_stage is not None:
        df = df.where(F.col("sweep_stage") == sweep_stage)
    return df if contains is None else df.where(F.col("message").contains(contains))


def length_problem(text: Column, minimum: int) -> Column:
    """`too_short` below the minimum, null otherwise."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) < minimum, "too_short")


#: fixed values: content types each kind of download may have
CONTENT_TYPES = {
    "html": ("text/html", "application/xhtml+xml"),
    "pdf": ("application/pdf",),
    "xml": ("application/xml", "text/xml", "application/atom+xml", "application/rss+xml"),
}


def fetch_problem(
    status: Column, content_type: Column, n_bytes: Column, expected: str, max_bytes: int = MAX_DOWNLOAD_BYTES
) -> Column:
    """Failure kind of one crawled row, null when it is usable."""
    family = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return (
        F.when(status.isNull(), "network")
        .when(status >= 400, "http")
        .when(n_bytes > max_bytes, "oversize")
        .when(~F.coalesce(family.isin(*CONTENT_TYPES[expected]), F.lit(False)), "content_type_mismatch")
    )


def enabled_sources(sources: DataFrame, profiles: DataFrame) -> DataFrame:
    """Sources that are enabled and belong to a known, enabled profile."""
    return sources.where(F.col("enabled")).join(profiles.where(F.col("enabled")).select("profile"), "profile", "left_semi")


def effective_sinks(sinks: DataFrame, legacy_url: str | None = None) -> DataFrame:
    """The explicit sinks; where there are none at all, one digest sink for the legacy url."""
    if not legacy_url:
        return sinks
    spark = sinks.sparkSession
    columns = {
        "name": F.lit("legacy-generic-digest"), "type": F.lit("digest"), "event_mode": F.lit("digest"),
        "enabled": F.lit(True), "notify_on": F.array(F.lit("scheduled"), F.lit("manual")), "url": F.lit(legacy_url),
    }
    fallback = spark.range(1).select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in sinks.schema.fields]
    )
    any_sink = sinks.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sinks.unionByName(fallback.where(any_sink == 0))


def notify_sinks(sinks: DataFrame, runs: DataFrame, items: DataFrame) -> DataFrame:
    """(sink, run, item) rows to deliver.

    Digest sinks give one row per run, skipped where `min_score` is set and the run has no item reaching it; article
    sinks give one row per item reaching `min_score`.  `sinks` is configuration (a handful of rows).
    """
    best = items.groupBy("run_id").agg(F.max("score").alias("best_score"))
    active = sinks.where(F.col("enabled")).withColumn("kind", F.explode("notify_on"))
    offered = runs.join(active, "kind")
    digests = (
        offered.where(F.col("event_mode") == "digest")
        .join(best, "run_id", "left")
        .where(F.col("min_score").isNull() | F.coalesce(F.col("best_score") >= F.col("min_score"), F.lit(False)))
        .select("run_id", "profile", "kind", F.col("name").alias("sink"), "type",
                F.lit(None).cast("string").alias("item_id"))
    )
    articles = (
        offered.where(F.col("event_mode") == "article")
        .join(items.select("run_id", "item_id", "score"), "run_id")
        .where(F.col("min_score").isNull() | (F.col("score") >= F.col("min_score")))
        .select("run_id", "profile", "kind", F.col("name").alias("sink"), "type", "item_id")
    )
    return digests.unionByName(articles)


def edge_gate(df: DataFrame, threshold: float | str = 0.75, score: str = "score") -> DataFrame:
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    return df.where(F.col(score) >= limit)


#: fixed values
PROFILE_NAME = r"^[a-z][a-z0-9-]{0,31}$"
SINK_NAME = r"^[a-z0-9][a-z0-9-]{0,63}$"
FEED_TAGS = ("rss", "blog")
SINK_MODES = {"digest": ("digest",), "toast": ("article",), "message": ("digest", "article"),
              "agent": ("digest", "article")}


def config_violations(profiles: DataFrame, sources: DataFrame, sinks: DataFrame) -> DataFrame:
    """Every broken rule of the configuration tables as (object, name, problem)."""
    def rows(df: DataFrame, kind: str, name: str, problem: Column) -> DataFrame:
        return (
            df.select(F.lit(kind).alias("object"), F.col(name).alias("name"), problem.alias("problem"))
            .where(F.col("problem").isNotNull())
        )

    def repeated(df: DataFrame, kind: str, name: str) -> DataFrame:
        return (
            df.groupBy(F.col(name).alias("name")).count().where(F.col("count") > 1)
            .select(F.lit(kind).alias("object"), "name", F.lit("duplicate_name").alias("problem"))
        )

    feeds = sources.where(F.col("kind") == "rss")
    mode_ok = F.lit(False)
    for kind, modes in SINK_MODES.items():
        mode_ok = mode_ok | ((F.col("type") == kind) & F.col("event_mode").isin(*modes))
    parts = [
        rows(profiles, "profile", "profile", F.when(~F.col("profile").rlike(PROFILE_NAME), "bad_name")),
        repeated(profiles, "profile", "profile"),
        rows(feeds, "feed", "feed_name", F.when(slugify(F.col("feed_name")) == "", "empty_slug")),
        rows(feeds, "feed", "feed_name", F.when(~F.col("source_key").rlike(r"^https?://"), "bad_url")),
        rows(feeds, "feed", "feed_name", F.when(~F.col("source_tag").isin(*FEED_TAGS), "bad_source_tag")),
        rows(sinks, "sink", "name", F.when(~F.col("name").rlike(SINK_NAME), "bad_name")),
        rows(sinks, "sink", "name", F.when(~F.col("url").rlike(r"^https?://"), "bad_url")),
        rows(sinks, "sink", "name", F.when(~mode_ok, "bad_mode")),
        repeated(sinks, "sink", "name"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
