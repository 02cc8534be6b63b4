"""Feed snapshots and configuration tables as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions.dates import feed_published, parse_iso
from gleaner.functions.text import collapse, rss_item_id, strip
from gleaner.functions.urls import arxiv_canonical_url, arxiv_id, url_hash
from gleaner.operators.predicates import require_fields
from gleaner.schemas import ATOM_ENTRY, PROFILES, RSS_ITEM, SINKS, SOURCES
from gleaner.vocabulary import THRESHOLDS


def _xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def _atom_rows(entries: DataFrame) -> DataFrame:
    """arXiv entries: id, title, abstract, published, categories; incomplete entries fall away."""
    return require_fields(
        entries.select(
            arxiv_id(F.col("id")).alias("item_id"),
            collapse(F.col("title")).alias("title"),
            strip(F.col("summary")).alias("abstract"),
            parse_iso(strip(F.col("published"))).alias("published"),
            F.transform(F.coalesce("category", F.array().cast("array<struct<_term:string>>")), lambda c: c["_term"])
            .alias("categories"),
        ),
        ["item_id", "title", "abstract", "published"],
    )


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    return _atom_rows(_xml(spark, path, "entry", ATOM_ENTRY))


def stream_atom(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """The same rows from snapshots landing in a folder: every poll's snapshot is part of a micro-batch."""
    entries = (
        spark.readStream.format("xml").option("rowTag", "entry").option("maxFilesPerTrigger", max_files)
        .schema(ATOM_ENTRY).load(path)
    )
    return _atom_rows(entries)


def stream_candidates(spark: SparkSession, path: str, schema: str, max_files: int = 16) -> DataFrame:
    """Candidates landing as JSON lines."""
    return spark.readStream.format("json").schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def read_rss(spark: SparkSession, path: str, feeds: DataFrame, now: Column | None = None) -> DataFrame:
    """RSS items and Atom entries, stamped with their feed's own tag and name, in no order.

    `feeds` has (file, feed_url, source_tag, feed_name): which snapshot belongs to which feed.
    """
    alternates = F.filter("link", lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    file_name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")
    items = _xml(spark, path, "item", RSS_ITEM).select(
        file_name, "title", F.col("link").alias("url"),
        feed_published(F.col("pubDate"), now=now).alias("published"), F.col("description").alias("summary"))
    entries = _xml(spark, path, "entry", ATOM_ENTRY).select(
        file_name, "title", F.get(alternates, F.lit(0))["_href"].alias("url"),
        feed_published(F.col("published"), F.col("updated"), now).alias("published"), "summary")
    rows = require_fields(items.unionByName(entries), ["title", "url"])
    return rows.join(feeds, "file").withColumn("title", strip(F.col("title")))


def to_candidates(df: DataFrame, kind: str) -> DataFrame:
    """The normal form shared by both kinds of source; a profile column is kept where there is one."""
    profile = F.col("profile") if "profile" in df.columns else F.lit(None).cast("string")
    if kind == "arxiv":
        return df.select(
            profile.alias("profile"), F.lit("arxiv").alias("source"), "item_id", "title", "abstract",
            arxiv_canonical_url(F.col("item_id")).alias("source_url"), "published", "categories",
            F.lit("arxiv").alias("source_tag"), F.lit(None).cast("string").alias("feed_name"))
    return df.select(
        profile.alias("profile"), F.lit("rss").alias("source"), url_hash(F.col("url")).alias("item_id"), "title",
        F.coalesce("summary", F.lit("")).alias("abstract"), F.col("url").alias("source_url"), "published",
        F.array().cast("array<string>").alias("categories"), "source_tag", "feed_name")


def archive_item_id(df: DataFrame) -> DataFrame:
    """Feed rows with the id their archived body is stored under."""
    return df.withColumn("archive_item_id", rss_item_id(F.col("feed_name"), F.col("published"), F.col("source_url")))


def union_sources(arxiv: DataFrame, rss: DataFrame) -> DataFrame:
    return arxiv.unionByName(rss)


def max_results_per_category(df: DataFrame, cap: int, by: str = "category") -> DataFrame:
    """Newest `cap` rows per category."""
    newest = Window.partitionBy(by).orderBy(F.col("published").desc(), "item_id")
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= cap).drop("_rn")


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("published").desc(), "item_id")


def first_seen(df: DataFrame, order: Iterable[str] = ("day", "pos"), key: str = "item_id") -> DataFrame:
    """The first occurrence of every item over the days of a backfill."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r")).select(key, "_r.*")


def fetch_once(requests: DataFrame, key: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Do the work once per distinct key and hand the results to every row that asked."""
    return requests.join(work(requests.select(key).distinct()), key)


def route_to_profiles(items: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per item and interested profile: shared categories for arXiv, equal feed url for feeds.

    `sources` is configuration: (profile, kind, source_key, enabled).
    """
    wanted = sources.where(F.col("enabled")).select("profile", "kind", "source_key").distinct()
    keyed = items.drop("profile") if "profile" in items.columns else items
    keys = F.when(F.col("kind") == "arxiv", F.col("categories")).otherwise(F.array("feed_url"))
    return (
        keyed.withColumn("source_key", F.explode(F.array_distinct(keys)))
        .join(wanted, ["kind", "source_key"])
        .drop("source_key")
        .dropDuplicates(["profile", "kind", "item_id"])
    )


def _table(spark: SparkSession, rows: Iterable[dict], schema: str, defaults: dict) -> DataFrame:
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schema)


def profiles_table(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return _table(spark, rows, PROFILES, {"enabled": True, "description": "", **THRESHOLDS})


def sources_table(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return _table(spark, rows, SOURCES, {"enabled": True, "max_results": 200, "lookback_days": 3})


def sinks_table(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return _table(spark, rows, SINKS, {"enabled": True, "event_mode": "digest", "type": "digest",
                                       "notify_on": ["scheduled", "manual"], "deliver": True})
