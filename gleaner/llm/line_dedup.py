"""Line dedup by overlapping three-line windows (operator 4), in DataFrame functions only.

Each line is hashed once; a window is the hash of three consecutive line hashes (128 bits in all).  Of every window
that occurs more than once anywhere, the occurrences after the first are covered; the covered positions of a document,
merged into runs, are cut out.  A line is only cut where the same line stands earlier within the same three-line window,
so every passage survives once, at its first place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.shared import free_name, settled

LINES = 3


def _windows(text: Column) -> Column:
    """An array of (pos, a, b), one per window that holds a line that is not blank."""
    lines = F.split(text, "\n", -1)

    def hashed(seed: int, side: Column) -> Column:
        return F.transform(side, lambda x: F.xxhash64(F.lit(seed), x))

    # hashes are kept in one array of structs so that the text is split and hashed once
    marks = F.transform(lines, lambda x: F.struct(
        F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"), (F.trim(x) == "").alias("blank")))
    one = F.transform(F.array(marks), lambda m: F.filter(F.transform(
        F.when(F.size(m) >= LINES, F.sequence(F.lit(0), F.size(m) - LINES)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[F.get(m, i + k)["a"] for k in range(LINES)]).alias("a"),
            F.xxhash64(*[F.get(m, i + k)["b"] for k in range(LINES)]).alias("b"),
            (F.get(m, i)["blank"] & F.get(m, i + 1)["blank"] & F.get(m, i + 2)["blank"]).alias("blank"))),
        lambda w: ~w["blank"]))
    return F.get(one, F.lit(0))


def covered_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document with lines to cut: doc (id, ka, kb), and runs, an ordered array of (first, last) positions."""
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   F.xxhash64(F.lit(1), text).alias("ka"), F.xxhash64(F.lit(2), text, F.length(text)).alias("kb"))
    windows = docs.where(F.col(text).isNotNull()).select(key.alias("doc"), F.inline(_windows(F.col(text)))) \
        .select("doc", "pos", "a", "b")
    windows = settled(windows)
    repeated = windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pos")).alias("first")) \
        .where("n > 1").drop("n")
    later = windows.join(repeated, ["a", "b"]).where(F.struct("doc", "pos") != F.col("first")) \
        .select("doc", "pos").distinct()
    in_doc = W.partitionBy("doc").orderBy("pos")
    runs = later.withColumn("opens", F.coalesce(F.col("pos") - F.lag("pos").over(in_doc) > LINES, F.lit(True))) \
        .withColumn("run", F.sum(F.col("opens").cast("int")).over(in_doc)) \
        .groupBy("doc", "run").agg(F.min("pos").alias("first"), (F.max("pos") + LINES - 1).alias("last"))
    return runs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with the repeated passages cut out of their texts, and two more columns: lines and lines_cut (long).

    Occurrences are ordered by id (nulls last), a hash of the text, and position.  Rows that agree in id and text are
    the same document: none of them counts as later than the others.  Lines are what stands between line feeds; a text
    of fewer than three lines has no window and stays whole, as does a null one (0 lines); windows of blank lines alone
    do not count.  A document that repeats wholly keeps its row with an empty text.
    """
    f_id, f_a, f_b, f_runs = (free_name(docs, n) for n in ("f_id", "f_a", "f_b", "runs"))
    found = covered_runs(docs, id_col, text).select(
        F.col("doc.id").alias(f_id), F.col("doc.ka").alias(f_a), F.col("doc.kb").alias(f_b), F.col("runs").alias(f_runs))
    runs = F.col(f_runs)
    joined = docs.join(
        found, docs[id_col].eqNullSafe(F.col(f_id)) & (F.xxhash64(F.lit(1), docs[text]) == F.col(f_a))
        & (F.xxhash64(F.lit(2), docs[text], F.length(docs[text])) == F.col(f_b)), "left")
    # between run i - 1 and run i stand the lines that are kept
    kept = F.get(F.transform(F.array(F.split(docs[text], "\n", -1)), lambda lines: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(runs)), lambda i: F.get(F.transform(
            F.array(F.coalesce(F.get(runs, i - 1)["last"] + 1, F.lit(0))), lambda start: F.slice(
                lines, start + 1, F.greatest(
                    F.lit(0), F.coalesce(F.get(runs, i)["first"], F.size(lines)) - start))), F.lit(0))))), F.lit(0))
    cut = F.aggregate(runs, F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"] + 1)
    new = F.when(runs.isNull(), docs[text]).otherwise(F.array_join(kept, "\n"))
    lines = F.when(docs[text].isNull(), F.lit(0)).otherwise(F.size(F.split(docs[text], "\n", -1))).cast("long")
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns],
                         lines.alias(free_name(docs, "lines")),
                         F.coalesce(cut, F.lit(0).cast("long")).alias(free_name(docs, "lines_cut")))
