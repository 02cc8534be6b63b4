"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.shared import settled


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), both long and not null: the smallest node reachable.

    Large and small stars alternate until nothing changes: first every node hangs its larger neighbours under the
    smallest node it sees, then its smaller ones and itself.  Each round is written out once; the number of rounds
    grows with the logarithm of the longest path.  A node of very many links is looked up by joining one smallest node
    per node, so its links stay spread over tasks.
    """
    edges = settled(links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                    .distinct())
    before = None
    while True:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(edges.select("hi", "lo"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = large.where("lo <> hi").distinct()
        floor = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.join(floor, F.col("hi") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("u").alias("hi")),
                              F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e")).select("e.*")
        edges = settled(small.where("lo <> hi").distinct())
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)")).alias("h")).first()
        if seen == before:
            break
        before = seen
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)
