"""Sinks: notes, rendered text, ledgers, edges, payloads, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.markdown import render_note
from gleaner.functions.tags import archive_problem
from gleaner.functions.text import archive_path
from gleaner.operators.graph import upsert_edges
from gleaner.schemas import EDGES
from gleaner.sinks.generations import Generations
from gleaner.vocabulary import TAGS, TagVocabulary

LAYOUT = ("kind", "source", "year", "month")
EDGE_BUCKETS = 256


def with_layout(notes: DataFrame, published: str = "published") -> DataFrame:
    """Partition columns from where a note belongs: papers/arxiv/YYYY/MM or articles/<tag>/YYYY/MM."""
    return (
        notes.withColumn("kind", F.when(F.col("source_tag") == "arxiv", "papers").otherwise("articles"))
        .withColumn("source", F.col("source_tag"))
        .withColumn("year", F.date_format(published, "yyyy"))
        .withColumn("month", F.date_format(published, "MM"))
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_notes(notes: DataFrame, path: str) -> None:
    """Put the rows in place of the stored notes of the same id; all other notes of their months stay.

    The months the rows belong to, and those that hold an older row of one of their ids, are written anew beside the old
    ones; then all change at once (`Generations`).  `read_notes_table` reads the table.
    """
    rows = with_layout(notes)
    table = Generations(notes.sparkSession, path, list(LAYOUT))
    stored = table.read(_ddl(rows))
    moved = stored.join(rows.select("note_id"), "note_id", "left_semi")
    touched = table.parts_of(rows.select(*LAYOUT).unionByName(moved.select(*LAYOUT)))
    kept = table.read(_ddl(rows), touched).join(rows.select("note_id"), "note_id", "left_anti")
    table.replace(rows.unionByName(kept), touched)


def read_notes_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Notes as `write_notes` left them, with the partition columns; `schema` names them all."""
    return Generations(spark, path, list(LAYOUT)).read(schema)


def rendered(notes: DataFrame, vocab: TagVocabulary = TAGS) -> tuple[DataFrame, DataFrame]:
    """(notes with `text`, rows that may not be written with their `problem`)."""
    checked = notes.withColumn("problem", archive_problem(F.col("archive_path"), F.col("tags"), vocab))
    names = ("title", "source_url", "tags", "confidence", "archive_path", "summary", "tier1", "full_text", "tier3",
             "relevance", "repair", "user_notes")
    good = checked.where(F.col("problem").isNull()).drop("problem")
    return (
        good.withColumn("text", render_note(**{n: F.col(n) for n in names}, vocab=vocab)),
        checked.where(F.col("problem").isNotNull()),
    )


def render_notes(notes: DataFrame, path: str, vocab: TagVocabulary = TAGS) -> DataFrame:
    """Write note texts as (slug, text) rows laid out by month; returns the rows that were refused."""
    good, bad = rendered(notes, vocab)
    with_layout(good).select("slug", "text", *LAYOUT).write.mode("overwrite").partitionBy(*LAYOUT).json(path)
    return bad


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_runs(runs: DataFrame, path: str) -> None:
    append_json(runs, path)


def append_filter_tags(items: DataFrame, path: str) -> None:
    """Tag set per scored item, kept until the profile's next rejection report."""
    items.select("profile", "title", F.array_distinct("filter_tags").alias("tags")).write.mode("append").parquet(path)


def save_notes_table(notes: DataFrame, table: str, buckets: int, key: str = "source_url") -> None:
    """The note store bucketed and sorted by its key: lookups and merges on the key then move only the other side."""
    notes.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def append_collisions(results: DataFrame, path: str) -> None:
    """The rows whose collision could not be resolved."""
    append_json(results.where(F.col("status") == "slug_collision"), path)


def write_edges(new: DataFrame, path: str, buckets: int = EDGE_BUCKETS) -> None:
    """Merge edges into the table: buckets (by source note) that new edges fall into are written anew, then all change at
    once.  The number of buckets must stay the same for a table."""
    table = Generations(new.sparkSession, path, ["bucket"])
    place = F.pmod(F.xxhash64("source_note_id"), F.lit(buckets)).cast("int")
    touched = table.parts_of(new.select(place.alias("bucket")))
    merged = upsert_edges(table.read(f"{EDGES}, bucket INT", touched).drop("bucket"), new)
    table.replace(merged.select("type", "source_note_id", "target_note_id", "evidence", place.alias("bucket")), touched)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return Generations(spark, path, ["bucket"]).read(f"{EDGES}, bucket INT").drop("bucket")


def write_digests(payloads: DataFrame, path: str) -> None:
    """Payload rows as JSON lines by sink."""
    payloads.write.mode("append").partitionBy("sink").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").partitionBy("name").parquet(path)


def archive_layout(df: DataFrame) -> DataFrame:
    """Where each stored body goes."""
    return df.withColumn(
        "archive_path", archive_path(F.col("source_tag"), F.col("published"), F.col("item_id"), F.col("ext")))
