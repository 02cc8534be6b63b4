"""Ledger, log, note and archive files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import markdown as md
from gleaner.functions.text import slugify
from gleaner.schemas import COLLISIONS, LOGS, RUNS, TIER1, TIER3

_CORRUPT = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines) of a JSON lines file; only objects count as rows."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(
        "value", F.from_json("value", f"{schema}, {_CORRUPT} STRING", {"columnNameOfCorruptRecord": _CORRUPT}).alias("r"))
    bad = ~F.ltrim("value").startswith("{") | F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    good = parsed.where(~bad).select("r.*").drop(_CORRUPT)
    return good, parsed.where(bad).select(F.col("value").alias("line"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run ledger; malformed lines are skipped, timestamps parsed next to their raw text."""
    good, _ = read_json_lines(spark, path, RUNS)
    return good.withColumn("started_ts", F.try_to_timestamp("started_at")).withColumn(
        "completed_ts", F.try_to_timestamp("completed_at"))


def read_active_runs(spark: SparkSession, path: str) -> DataFrame:
    """The object of active runs, one row per run; a value that is not an object is dropped.

    The file holds the runs under way at one moment: its size is bounded by the number of profiles.
    """
    values = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,string>")).alias("key", "body"))
    return (
        values.where(F.ltrim("body").startswith("{"))
        .select(F.col("key"), F.from_json("body", RUNS).alias("r"))
        .select(F.coalesce("r.run_id", "key").alias("run_id"),
                *[F.col(f"r.{f.name}") for f in T.StructType.fromDDL(RUNS) if f.name != "run_id"])
    )


def read_collisions(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, COLLISIONS)[0]


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """JSON log lines; other lines are ignored and unknown keys stay in `extra`."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).where(F.col("value").startswith("{"))
    parsed = lines.select(
        F.from_json("value", LOGS).alias("r"), F.try_parse_json("value").alias("extra")).where(F.col("extra").isNotNull())
    return parsed.select("r.*", "extra")


def read_notes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(notes, errors) of a folder of Markdown notes."""
    files = (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    )
    return parse_notes(files)


def parse_notes(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(notes, errors) from rows of (file, text)."""
    checked = md.split_note(files.select("file", "text"))

    def body(heading: str) -> Column:
        return md.section_body(F.col("sections"), heading)

    archive = md.stored_archive_path(body("Archive"))
    summary = body("Summary")
    structured = summary.startswith("### Contributions")

    def sub(heading: str) -> Column:
        return F.regexp_extract(summary, rf"(?s)(?:\A|\n)### {heading}\r?\n(.*?)(?:\n\n### |\z)", 1)

    tier1 = F.when(structured, F.struct(
        md.parse_bullets(sub("Contributions")).alias("contributions"), sub("Method").alias("method"),
        sub("Result").alias("result"), sub("Relevance").alias("relevance")))
    tier3 = F.when(body("Claims").isNotNull(), F.struct(
        md.parse_bullets(body("Claims")).alias("claims"),
        md.parse_bullets(body("Datasets & Benchmarks")).alias("datasets"),
        md.parse_bullets(body("Builds On")).alias("builds_on"),
        md.parse_bullets(body("Open Questions")).alias("open_questions"),
        F.array().cast("array<string>").alias("potential_connections")))
    front = F.col("front")
    fields = F.struct(
        F.col("title"), slugify(F.col("title")).alias("slug"),
        md.header_value(front, "source_url").alias("source_url"), md.header_tags(front).alias("tags"),
        md.header_value(front, "confidence").try_cast("double").alias("confidence"),
        archive["path"].alias("archive_path"),
        F.when(~structured, summary).alias("summary"), body("Full Text").alias("full_text"),
        tier1.cast(TIER1).alias("tier1"), tier3.cast(TIER3).alias("tier3"),
        F.coalesce(md.parse_relevance(body("Profile Relevance")),
                   F.array().cast("array<struct<profile:string,score:int,reason:string>>")).alias("relevance"),
        F.when(body("Repair").isNotNull(), md.parse_repair(body("Repair"))).alias("repair"),
        F.col("user_notes"),
    )
    judged = checked.withColumn("error", F.coalesce("note_error", archive["error"]))
    # a filter would be pushed below the parsing and repeat it; generating zero or one row is not
    notes = judged.select("file", F.inline(F.when(F.col("error").isNull(), F.array(fields))))
    return notes, judged.where(F.col("error").isNotNull()).select("file", "error")


_ARCHIVE = r"([^/]+)/([0-9]{4})/([0-9]{2})/([^/]+?)(\.[A-Za-z0-9]+)?$"


def read_archive(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Stored bodies with what their path says; without `content` only file metadata is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    cols = ["path", "length", "modificationTime"] + (["content"] if content else [])
    out = files.select(*cols)
    for i, name in enumerate(("source", "year", "month", "item_id", "ext"), start=1):
        out = out.withColumn(name, F.regexp_extract("path", _ARCHIVE, i))
    return out.where(F.col("item_id") != "").withColumn("year", F.col("year").cast("int")).withColumn(
        "month", F.col("month").cast("int")).withColumn(
        "extractor", F.when(F.lower("ext") == ".pdf", "pdf").otherwise("html"))
