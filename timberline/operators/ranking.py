"""Places and running sums in a total order without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timberline.staging import written

#: Bits of a row's number within its range; those above are the range.
_BITS = 33


def dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds __at: rows are dealt by ranges of ``order``, sorted, numbered and written once.

    The number's upper bits are the range, so that whatever is computed of the
    table afterwards, however it is read, means the same ranges.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_.withColumn("__at", F.monotonically_increasing_id()), "ranges")


def _before(per_range: DataFrame, amount: str) -> DataFrame:
    """__range and the sum of ``amount`` in the ranges before; one row for every range."""
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per_range.select("__range", F.coalesce(F.sum(amount).over(before), F.lit(0)).alias("__before")))


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds place, from 1, in the total order of all rows; rows that tie get places in any order."""
    rows = dealt(df, order).withColumn("__range", F.shiftright("__at", _BITS))
    counts = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    own = F.col("__at").bitwiseAND((1 << _BITS) - 1) + 1
    return rows.join(_before(counts, "__n"), "__range").withColumn("place", F.col("__before") + own).drop("__range", "__before", "__at")


def running(df: DataFrame, order: list[Column], amount: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over all rows before in the order."""
    rows = dealt(df, order).withColumn("__range", F.shiftright("__at", _BITS))
    sums = rows.groupBy("__range").agg(F.sum(amount).alias("__n"))
    inside = F.coalesce(F.sum(amount).over(Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn(out, inside).join(_before(sums, "__n"), "__range").withColumn(out, F.col(out) + F.col("__before")).drop("__range", "__before", "__at")
