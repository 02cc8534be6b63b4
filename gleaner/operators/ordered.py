"""Ordered per-key computations that hold up when one key owns a large share of all rows.

A plain `row_number().over(partitionBy(key))` sorts all rows of a key in one task.  That is fine for most keys and
fatal for the few that own more than a task's share.  There are at most as many such hot keys as there are tasks; they
are found with one pre-aggregated count, and only they are cut into chunks along their order, at cut points taken
from their own quantiles.  Work inside a chunk is an ordinary window; what a chunk needs to know about earlier chunks
(a running total, the last few rows) is aggregated to one small row per hot key and chunk and joined back.  Without
hot keys the plan is the plain window.  The cuts only decide where the work is split, never what the result is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

CHUNK = "_chunk"
HALO = "_halo"
_SKETCHES = 64
#: rows drawn per chunk where quantiles come from a sample
_SAMPLED = 50
_PREFIX_BYTES = 7
_LOWEST = -(2**63)
#: below this a key is never worth cutting
MIN_HOT_ROWS = 200_000


def default_chunks(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _string_rank(col: Column, skip: int) -> Column:
    """A number that grows with the string's binary order: its first bytes after a shared prefix."""
    body = F.rpad(F.hex(F.substring(F.encode(col, "UTF-8"), skip + 1, _PREFIX_BYTES)), 2 * _PREFIX_BYTES, "0")
    return F.conv(body, 16, 10).cast("bigint")


def _numeric_order(df: DataFrame, col: Column) -> Column:
    kind = df.select(col.alias("v")).schema["v"].dataType
    if isinstance(kind, T.StringType):
        ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo, hi = (ends.lo or "").encode(), (ends.hi or "").encode()
        skip = 0
        while skip < min(len(lo), len(hi)) and lo[skip] == hi[skip]:
            skip += 1
        return _string_rank(col, skip)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    return col.cast("double") if isinstance(kind, (T.FractionalType, T.DecimalType)) else col.cast("bigint")


def _sketched(df: DataFrame, keys: list[str], n: int) -> list:
    """Quantile sketches of `v` (per key), taken in 64 slices so that no task merges them all.

    Text has no quantile sketch: there the quantiles are those of a bounded sample, the values of the rows with the
    smallest hashes, and compare as text, whatever their prefixes.
    """
    if not keys and isinstance(df.schema["v"].dataType, T.StringType):
        drawn = df.orderBy(F.xxhash64(*df.columns), *df.columns).limit(_SAMPLED * n).select("v").collect()
        values = sorted((r.v for r in drawn), key=lambda v: v.encode())
        return [Row(cuts=[values[len(values) * i // n] for i in range(1, n)])] if values else []
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    return (
        df.groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(_SKETCHES)).alias("part"))
        .agg(F.percentile_approx("v", probs, max(1000, 2 * n)).alias("cuts"))
        .collect()
    )


def _binary(value: object) -> object:
    """Text in the order Spark compares it in."""
    return value.encode() if isinstance(value, str) else value


def _merge(sketches: list) -> list:
    values = sorted((x for s in sketches for x in s), key=_binary)
    return values[len(sketches) // 2 :: len(sketches)] if sketches else []


def cut_points(df: DataFrame, first: Column, second: Column | None, chunks: int) -> list[tuple]:
    """About `chunks - 1` ascending cut points (first, second), where second is None for "from the start".

    They come from bounded quantile sketches.  A value of the first column so frequent that several cut points fall
    on it is cut further along the second column.
    """
    if chunks <= 1:
        return []
    slim = df.select(first.alias("v"), *([] if second is None else [second.alias("w")])).where(F.col("v").isNotNull())
    picks = Counter(_merge([r.cuts for r in _sketched(slim, [], chunks)]))
    cuts: list[tuple] = [(v, None) for v in picks]
    heavy = {v: n for v, n in picks.items() if n > 1}
    if heavy and second is not None:
        inside = slim.where(F.col("v").isin(list(heavy))).select(F.col("v").alias("k"), F.col("w").alias("v"))
        found: dict = {}
        for row in _sketched(inside.where(F.col("v").isNotNull()), ["k"], max(heavy.values()) + 1):
            found.setdefault(row.k, []).append(row.cuts)
        for value, sketches in found.items():
            cuts += [(value, w) for w in sorted(set(_merge(sketches)))]
    # the frequent value's own start comes first, then the cuts inside it
    return sorted(cuts, key=lambda c: (_binary(c[0]), c[1] is not None, c[1] if c[1] is not None else 0))


def _chunk_number(first: Column, second: Column | None, cuts: Sequence[tuple]) -> Column:
    """How many cut points lie at or below the row: a balanced tree of comparisons, or a search in a constant array."""
    rank = F.lit(_LOWEST) if second is None else F.coalesce(second, F.lit(_LOWEST))
    if len(cuts) <= 64:
        def below(cut: tuple) -> Column:
            if cut[1] is None:
                return first < F.lit(cut[0])
            return (first < F.lit(cut[0])) | ((first == F.lit(cut[0])) & (rank < F.lit(cut[1])))

        def tree(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(below(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

        return tree(0, len(cuts))
    bits = len(cuts).bit_length()
    table = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(_LOWEST if w is None else w).alias("w")) for v, w in cuts])
    here = F.struct(first.alias("v"), rank.alias("w"))
    # add the largest power of two that still lands on a cut point at or below the row
    return F.aggregate(
        F.array(*[F.lit(1 << b) for b in reversed(range(bits))]),
        F.lit(0),
        lambda acc, step: F.when(
            (acc + step <= len(cuts)) & (F.try_element_at(table, acc + step) <= here), acc + step
        ).otherwise(acc),
    )


Split = Column | Sequence[Column]


def hot_key_hashes(df: DataFrame, keys: Sequence[str], chunks: int, hot_rows: int | None = None) -> list[int]:
    """Hashes of the keys owning more than one task's share of the rows: never more than `chunks` of them.

    Two keys with the same hash are both cut, which costs a little and changes nothing.
    """
    total = Observation()
    top = (
        df.select(F.xxhash64(*keys).alias("h")).observe(total, F.count(F.lit(1)).alias("n"))
        .groupBy("h").count().orderBy(F.col("count").desc()).limit(chunks).collect()
    )
    if not top:
        return []
    limit = max(total.get["n"] // chunks, MIN_HOT_ROWS) if hot_rows is None else hot_rows
    return [r.h for r in top if r["count"] > limit]


def with_chunks(
    df: DataFrame, keys: Sequence[str], split_on: Split, chunks: int | None = None, hot_rows: int | None = None
) -> tuple[DataFrame, bool]:
    """Add `_chunk`: -1 for ordinary keys, else a number that does not decrease along the order.

    `split_on` is the leading column of the order, or the leading two, ascending.  Also tells whether any key was cut.
    """
    chunks = default_chunks(df) if chunks is None else chunks
    hashes = hot_key_hashes(df, keys, chunks, hot_rows) if chunks > 1 else []
    if not hashes:
        return df.withColumn(CHUNK, F.lit(-1)), False
    is_hot = F.xxhash64(*keys).isin(hashes)
    columns = [split_on] if isinstance(split_on, Column) else list(split_on)[:2]
    hot = df.where(is_hot)
    text = isinstance(hot.select(columns[0].alias("v")).schema["v"].dataType, T.StringType)
    leading = columns[0] if text else _numeric_order(hot, columns[0])
    first, second = [leading, *[_numeric_order(hot, c) for c in columns[1:]], None][:2]
    cuts = cut_points(hot, first, second, chunks)
    number = F.coalesce(_chunk_number(first, second, cuts), F.lit(0)) if cuts else F.lit(0)
    return df.withColumn(CHUNK, F.when(is_hot, number).otherwise(-1)), True


_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: dict[str, tuple[str, Column]],
    split_on: Split,
    *,
    strictly_before: bool = False,
    chunks: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Running sum / max / min per key, `values` being {output: (kind, expression)}.

    Key columns must not be null.  With `strictly_before` the current row is not counted in.
    """
    keys = list(keys)
    last = -1 if strictly_before else 0
    chunked, cut = with_chunks(df, keys, split_on, chunks, hot_rows)
    local = Window.partitionBy(*keys, CHUNK) if cut else Window.partitionBy(*keys)
    local = local.orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    if not cut:
        plain = {name: _COMBINE[kind][0](expr).over(local) for name, (kind, expr) in values.items()}
        return df.select(*df.columns, *[
            (F.coalesce(c, F.lit(0)) if values[name][0] == "sum" else c).alias(name) for name, c in plain.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.where(F.col(CHUNK) >= 0).groupBy(*keys, CHUNK).agg(
        *[_COMBINE[kind][0](expr).alias(f"_t_{name}") for name, (kind, expr) in values.items()]
    )
    prefix = totals.select(
        *keys, CHUNK,
        *[_COMBINE[kind][0](f"_t_{name}").over(earlier).alias(f"_p_{name}") for name, (kind, _) in values.items()],
    )
    with_local = chunked.select(
        "*", *[_COMBINE[kind][0](expr).over(local).alias(f"_l_{name}") for name, (kind, expr) in values.items()]
    )
    return with_local.join(prefix, [*keys, CHUNK], "left").select(
        *df.columns,
        *[
            _COMBINE[kind][1](F.col(f"_l_{name}"), F.col(f"_p_{name}")).alias(name)
            for name, (kind, _) in values.items()
        ],
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], split_on: Split, name: str = "rn",
    chunks: int | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """`row_number()` per key; `order` must be total within the key."""
    one = {name: ("sum", F.lit(1).cast("bigint"))}
    return running(df, keys, order, one, split_on, chunks=chunks, hot_rows=hot_rows)


def with_lookback(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, split_on: Split, chunks: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every (key, chunk) together with the key's `n` rows before it, marked `_halo`.

    Windows over (keys, _chunk) with frames reaching back at most `n` rows are then exact for the rows
    where `_halo` is false.  `order` is ascending and total within the key.
    """
    keys, order = list(keys), list(order)
    chunked, cut = with_chunks(df, keys, split_on, chunks, hot_rows)
    own = chunked.withColumn(HALO, F.lit(False))
    if not cut:
        return own
    payload = [c for c in df.columns if c not in (*keys, *order)]
    newest = Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        chunked.where(F.col(CHUNK) >= 0)
        .withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= n)
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(*order, *payload))).alias("_tail"))
    )
    # every listed chunk holds at least one row, so the last n rows lie within the n chunks before
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-n, -1)
    halo = (
        tails.withColumn("_rows", F.flatten(F.collect_list("_tail").over(before)))
        .where(F.size("_rows") > 0)
        .select(
            *keys, CHUNK,
            F.explode(F.slice("_rows", F.greatest(F.size("_rows") - (n - 1), F.lit(1)), n)).alias("_r"),
        )
        .select(*keys, CHUNK, "_r.*", F.lit(True).alias(HALO))
    )
    return own.unionByName(halo)


def streaks(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], match: Column, split_on: Split,
    name: str = "streak", chunks: int | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """Number of consecutive matching rows ending at each row (0 where the row does not match)."""
    keys = list(keys)
    chunked, cut = with_chunks(df, keys, split_on, chunks, hot_rows)
    rows = Window.partitionBy(*keys, CHUNK) if cut else Window.partitionBy(*keys)
    rows = rows.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = (
        chunked.withColumn("_m", F.coalesce(match, F.lit(False)))
        .withColumn("_n", F.count(F.lit(1)).over(rows))
        .withColumn("_break", F.coalesce(F.max(F.when(~F.col("_m"), F.col("_n"))).over(rows), F.lit(0)))
        .withColumn("_run", F.col("_n") - F.col("_break"))
    )
    if not cut:
        return local.select(*df.columns, F.col("_run").cast("bigint").alias(name))
    ends = local.where(F.col(CHUNK) >= 0).groupBy(*keys, CHUNK).agg(
        F.max_by("_run", "_n").alias("_open"), (F.max("_break") > 0).alias("_broken")
    )
    chunk_order = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = (
        ends.withColumn("_grp", F.sum(F.col("_broken").cast("int")).over(chunk_order))
        .withColumn("_acc", F.sum("_open").over(Window.partitionBy(*keys, "_grp").orderBy(CHUNK)))
        .select(*keys, CHUNK, F.coalesce(F.lag("_acc").over(chunk_order), F.lit(0)).alias("_carry"))
    )
    total = F.col("_run") + F.when(F.col("_break") > 0, 0).otherwise(F.coalesce("_carry", F.lit(0)))
    return local.join(carried, [*keys, CHUNK], "left").select(*df.columns, total.cast("bigint").alias(name))


def paged(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], split_on: Split, page_size: int,
    name: str = "page", chunks: int | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """Number the rows of each key and cut them into pages of a fixed size, so lists stay bounded and whole."""
    return numbered(df, keys, order, split_on, "_rn", chunks, hot_rows).select(
        *df.columns, F.floor((F.col("_rn") - 1) / page_size).cast("bigint").alias(name), F.col("_rn").alias("pos")
    )


def mark_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "is_first") -> DataFrame:
    """Flag the first row of each key.

    The minimum is pre-aggregated before the shuffle; the flag is a lookup of one row per key, which adaptive
    execution splits where a key is hot.  `order` must be total within the key.
    """
    keys = list(keys)
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_first"))
    here = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return df.join(firsts, keys, "left").select(
        *df.columns, F.coalesce(here == F.col("_first"), F.lit(False)).alias(name)
    )
