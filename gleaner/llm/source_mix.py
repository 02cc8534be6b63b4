"""Mixing sources to target weights by systematic sampling (operator 5).

Within a source every document is expected as often as the source's target over its size.  Documents are laid out by
size, the expected copies are summed along that order, one offset per source is added, and a document is given out once
for every integer the sum crosses at it.  Laid out by size, the words taken stay within about one document of the
target.

The expected copies being equal within a source, the sum at a document is its place times that number.  Places are
counted from tables of counts, by source, band of sizes, size and slot, so no task orders a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.shared import settled, word_count

WEIGHTS, SHARE, MOST, SLOTS, BAND = (5, 2, 1), 1.5, 2.0, 64, 64


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) with target and rate, the expected copies of each of the source's documents.

    Sources take the weights in turn, by code point, null last.  They share `share` of all sizes by weight; none gets
    more than `most` times its own size, and what is over is shared again by weight.  Shares only rise as sources
    stop, so sources stop in the order of what they may take per weight.  One row per source is ordered in one task.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    order = W.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("weight", F.get(cycle, (F.row_number().over(order) - 1) % len(weights))) \
        .withColumn("cap", most * F.col("source_size"))
    every = W.partitionBy(F.lit(1))
    by_ratio = W.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("nth", F.row_number().over(by_ratio)).withColumn("all", share * F.sum("source_size").over(every)) \
        .withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source in this order whose share lies within what it may take, and so do all after it
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("nth", "level"))
    return rows.withColumn("line", F.min(fits).over(every)["level"]) \
        .withColumn("target", F.least("cap", F.coalesce("line", F.lit(float("inf"))) * F.col("weight"))) \
        .select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target")
                                                          / F.col("source_size")).otherwise(0.0).alias("rate"))


def offset(source: Column, seed: str = "mix") -> Column:
    """The offset of a source in [0, 1), drawn from a hash of its name."""
    text = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def with_copies(docs: DataFrame, keep: Sequence[str], id_col: str = "doc_id", text: str = "text",
                source: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                most: float = MOST) -> DataFrame:
    """The columns `keep` (as column kept) with doc_id, size, source, source_size, target and copies.

    Size is the number of words (null text: 0); a source without words has target and rate 0.  Places of equal size
    follow the id (null first), then a hash of the text; rows alike in both may change places, not the result.  Reruns
    agree.  An empty table gives an empty result.
    """
    id_value = F.col(id_col)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(None).alias("kept"),
                       id_value.alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       F.coalesce(F.pmod(id_value, F.lit(SLOTS)), F.lit(0)).cast("int").alias("slot"),
                       F.xxhash64(text).alias("tie"))
    counts = settled(rows.groupBy("source", "size", "slot").agg(F.count("*").alias("n")))
    wide = F.expr(f"size div {BAND}").alias("band")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(sizes, weights, share, most)
    bands = counts.groupBy("source", wide).agg(F.sum("n").alias("n")).select(
        "source", "band", _before("n", ["source"], "band").alias("b1"))
    steps = counts.groupBy("source", wide, "size").agg(F.sum("n").alias("n")).select(
        "source", "band", "size", _before("n", ["source", "band"], "size").alias("b2"))
    slots = counts.select("source", "size", "slot", _before("n", ["source", "size"], "slot").alias("b3"))
    places = slots.join(steps, slots["source"].eqNullSafe(steps["source"]) & (slots["size"] == steps["size"])) \
        .select(slots["source"], slots["size"], "slot", "band", "b2", "b3")
    places = places.join(bands, places["source"].eqNullSafe(bands["source"]) & (places["band"] == bands["band"])) \
        .select(places["source"], "size", "slot", (F.col("b1") + F.col("b2") + F.col("b3")).alias("before"))
    places = places.join(goals, places["source"].eqNullSafe(goals["source"])).select(
        places["source"].alias("p_source"), F.col("size").alias("p_size"), F.col("slot").alias("p_slot"), "before",
        "source_size", "target", "rate")
    numbered = rows.withColumn("at", F.row_number().over(
        W.partitionBy("source", "size", "slot").orderBy("doc_id", "tie")))
    joined = numbered.join(places, numbered["source"].eqNullSafe(places["p_source"])
                           & (numbered["size"] == places["p_size"]) & (numbered["slot"] == places["p_slot"]))
    place, start = F.col("before") + F.col("at"), offset(F.col("source"))
    copies = F.floor(start + F.col("rate") * place) - F.floor(start + F.col("rate") * (place - 1))
    return joined.select("kept", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def _before(value: str, keys: list[str], order: str) -> Column:
    """The sum of a column over the rows before, within the keys."""
    own = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(own), F.lit(0))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents, each as often as the mix takes it; all columns are kept."""
    taken = with_copies(docs, docs.columns, **options)
    return taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))) \
        .select("kept.*")
