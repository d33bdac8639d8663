"""Arrays to rows, and values bound once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

StrCol = Column | str


def col(c: StrCol) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_items(
    df: DataFrame, keep: list[str | Column], items: Column | str, pos: str, value: str
) -> DataFrame:
    """``keep``, the 0-based ``pos`` and the ``value`` of every array item.

    From an inner explode Spark infers a filter on the array's size and pushes it to
    the scan, which computes a derived array a second and third time.  The outer form
    has no such inference; the row it makes for an empty array is dropped here.
    """
    rows = df.select(*keep, F.posexplode_outer(col(items)).alias(pos, value))
    return rows.filter(F.col(pos).isNotNull()).withColumn(pos, F.col(pos).cast("bigint"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for a body that uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
