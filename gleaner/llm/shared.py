"""What several operators of this folder need."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import checkpoint_dir

#: ASCII white space, as a regular expression; words are what stands between.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes that Spark hands to a Python worker at once; texts may be long, so both are kept low.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Shuffle files of an execution go when it ends, not when the driver next collects its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """Written once to the shared checkpoint folder, so that a lost executor costs no recomputation and no other rows.

    Its shuffle files are deleted as soon as it is written.  The setting holds for this execution alone: a frame that is
    executed twice still needs its shuffle files.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(_CLEAN_UP, before)


def stored(df: DataFrame) -> DataFrame:
    """Like `settled`, as a compressed table: for wide rows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """`wish`, with underscores before it until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null like a text of its own."""
    return F.struct(F.xxhash64(F.lit(1), text).alias("a"), F.xxhash64(F.lit(2), text, F.length(text)).alias("b"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column, block: int = 256) -> Column:
    """For each place of an array of integers the sum of those before it.

    Summed by blocks, so that an array of n places costs about n * block steps and not n * n.
    """
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)

    def blocks(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int")),
                           lambda b: total(F.slice(x, b * block + 1, F.lit(block))))

    def places(x: Column, before: Column) -> Column:
        def at(i: Column) -> Column:
            first = F.floor(i / block).cast("int") * block
            return F.get(before, F.floor(i / block).cast("int")) + total(F.slice(x, first + 1, i - first))

        return F.transform(F.sequence(F.lit(0), F.size(x) - 1), at)

    some = let(sizes, lambda x: let(blocks(x), lambda b: let(
        F.transform(F.sequence(F.lit(0), F.size(b) - 1), lambda i: total(F.slice(b, F.lit(1), i))),
        lambda before: places(x, before))))
    return F.when(F.size(sizes) > 0, some).otherwise(F.array().cast("array<bigint>"))
