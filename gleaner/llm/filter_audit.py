"""How filters overlap: what each removes alone, after others, and in every order (operator 11).

A document fails a set of filters, its mask.  Counts per mask are all that any order of the filters can tell apart, so a
part of the corpus shrinks to one cell per mask.  A Gray code then visits every subset of filters by toggling one filter
at a time: every cell keeps a counter of the active filters it fails, and the running survivors change by the cells
whose counter leaves or reaches zero.  The survivors of all subsets are stored; any step of any order is the
difference of two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.shared import WORD, let, settled, text_key

Check = Callable[[Column], Column]


def too_short(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)) < 50


def repetitive(text: Column) -> Column:
    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
               lambda words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words))


def shouting(text: Column) -> Column:
    return 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text)


def symbols(text: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Filters that look at one text, by letter, and the letter of the one that compares texts table-wide.
CHECKS: dict[str, Check] = {"A": too_short, "B": repetitive, "C": shouting, "D": symbols}
COPY = "E"
COUNTS = ("n", "good", "toxic")


def failing_masks(docs: DataFrame, checks: dict[str, Check], id_col: str, text: str, part: str) -> DataFrame:
    """(id, part, mask) per document: bit i of the mask is set if it fails check i, the last one if it copies a smaller id.

    Texts are read once; what is shuffled are keys of texts.  A text's smallest id is pre-aggregated, and looked up by
    text and id together, so that a text of very many copies stays spread over tasks.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bits = sum((F.when(check(body), 1 << i).otherwise(0) for i, check in enumerate(checks.values())), F.lit(0))
    key = text_key(body)
    rows = settled(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                               bits.cast("int").alias("bits"), key["a"].alias("ka"), key["b"].alias("kb")))
    firsts = rows.where(F.col("id").isNotNull()).groupBy("ka", "kb").agg(F.min("id").alias("id")) \
        .withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return rows.join(firsts, ["ka", "kb", "id"], "left").select(
        "id", "part", (F.col("bits") + F.when(copy, 1 << len(checks)).otherwise(0)).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame, checks: dict[str, Check] | None = None, id_col: str = "doc_id",
          text: str = "text", part: str = "source") -> DataFrame:
    """Documents per (part, mask): n, and those labelled good (quality 1) and toxic (1).

    A null text is empty, a null part the empty string.  A null id is no copy and nothing copies it.  Repeated rows
    count each; equal id and text are no copies of each other.  Of several labels of an id any 1 counts.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    masks = failing_masks(docs, CHECKS if checks is None else checks, id_col, text, part)
    return masks.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def survivors(counts: np.ndarray) -> np.ndarray:
    """Counts (parts, masks, kinds) to survivors (parts, subsets, kinds): what no filter of the subset removes."""
    masks = np.arange(counts.shape[1])
    failed = np.zeros(len(masks), np.int64)
    alive, subset = counts.sum(1), 0
    stored = np.empty_like(counts)
    stored[:, 0] = alive
    for turn in range(1, len(masks)):
        toggled = turn & -turn
        subset ^= toggled
        touched = masks & toggled != 0
        if subset & toggled:
            alive = alive - counts[:, touched & (failed == 0)].sum(1)
            failed[touched] += 1
        else:
            failed[touched] -= 1
            alive = alive + counts[:, touched & (failed == 0)].sum(1)
        stored[:, subset] = alive
    return stored


def _steps(letters: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Every order of the letters, and per order and step the filters before it and the filter itself, as bits."""
    orders = list(permutations(range(len(letters))))
    own = 1 << np.array(orders)
    return ["".join(letters[i] for i in o) for o in orders], np.cumsum(own, axis=1) - own, own


def interactions(cell_rows: DataFrame, letters: str = "".join(CHECKS) + COPY) -> DataFrame:
    """One row per part, filter_order and step (from 1) from the cells of `cells`; counts of the step's filter:

    kept after it, removed by it, redundant (fails it, removed earlier), unique_fails (fails nothing else), good_lost
    and toxic_lost (removed by it), and shapley (removed by it, summed over all orders).  No cells, no rows.
    """
    size, (orders, before, own) = 1 << len(letters), _steps(letters)
    filters = range(len(letters))
    fields = T.StructType([
        T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in (
            "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                block = batch.slice(at, 64)
                counts = np.zeros((block.num_rows, size, len(COUNTS)), np.int64)
                for i, found in enumerate(block.column(1).to_pylist()):
                    for cell in found:
                        counts[i, cell["mask"]] = [cell[c] for c in COUNTS]
                alive = survivors(counts)
                lost = alive[:, before] - alive[:, before | own]
                fails = np.stack([counts[:, np.arange(size) >> f & 1 == 1, 0].sum(1) for f in filters], axis=1)
                which = np.log2(own).astype(int)
                shapley = np.stack([lost[..., 0][:, which == f].sum(1) for f in filters], axis=1)
                made = [alive[:, before | own][..., 0], lost[..., 0], fails[:, which] - lost[..., 0], counts[:, own, 0],
                        lost[..., 1], lost[..., 2], shapley[:, which]]
                n, each = block.num_rows, own.size
                yield pa.RecordBatch.from_arrays([
                    block.column(0).take(pa.array(np.repeat(np.arange(n), each))),
                    pa.array(np.tile(np.repeat(orders, own.shape[1]), n).tolist(), pa.string()),
                    pa.array(np.tile(np.arange(1, own.shape[1] + 1, dtype=np.int32), n * len(orders))),
                    *[pa.array(m.reshape(-1)) for m in made]], fields.names)

    return cell_rows.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells")).mapInArrow(run, fields)
