"""Computing a costly value once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body names it.

    Without this every mention repeats the whole expression, in the plan and in the generated code.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The columns `keep` and the given ones, the latter behind a one-row generator.

    Filters on the new columns, also those a join implies, then stay above.  Through a plain projection they would be
    pushed down and repeat the whole computation.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
