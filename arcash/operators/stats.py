"""Exact percentile by refining buckets: no sort, and no exchange of the values.

Spark's ``percentile`` is exact but its final merge keeps a histogram of *all* distinct values
in one reducer, which does not hold for money amounts at 10^11 rows. Here every pass counts the
values of at most ``BUCKETS`` buckets, with the least and greatest value in each, combined in the
map tasks; the bucket that holds the two order statistics around ``p * (n - 1)`` is cut into
buckets again, until they are known. The first pass cuts by magnitude (a 1,024th of the value's
logarithm), so a few huge amounts cost no resolution; the next cut the range that is left evenly.
Amounts under 10^5 take two passes, any 18-digit amount five at most.
"""

from __future__ import annotations

import math
from decimal import Decimal
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arcash.session import RunFolder

BUCKETS = 1 << 16


def by_magnitude(v: Column, scale: int) -> Column:
    """A bucket number that never falls as the value grows; zero is in the middle."""
    units = F.abs(v).cast("double") * float(10 ** scale)
    return (F.signum(v.cast("double")) * F.floor(F.log1p(units) * 1024)).cast("long")


def evenly(v: Column, least: Decimal, greatest: Decimal, scale: int) -> Column:
    """The number of the bucket among ``BUCKETS`` of equal width from ``least`` to ``greatest``."""
    units = int((greatest - least).scaleb(scale)) + 1
    width = Decimal(-(-units // BUCKETS)).scaleb(-scale)
    # whole-number division of exact decimals
    return F.call_function("div", v - F.lit(least), F.lit(width))


def holding(values: DataFrame, bucket: Column, before: int, p: float, total: Optional[int]) -> list:
    """The one or two buckets that hold the ranks, with the rows up to and including each."""
    everything, in_order = Window.partitionBy(), Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum("n").over(everything) if total is None else F.lit(total)
    # one row a bucket, so the windows see BUCKETS rows at most, whatever the table's size
    counted = (values.groupBy(bucket.alias("k"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"))
               .select("*", (F.sum("n").over(in_order) + before).alias("upto"), n.alias("total")))
    first = F.floor(F.lit(p) * (F.col("total") - 1))
    last = F.least(first + 1, F.col("total") - 1)
    return counted.where((F.col("upto") - F.col("n") <= last) & (first < F.col("upto"))).orderBy("k").collect()


def exact_percentile(df: DataFrame, column: str, p: float, written: bool = False) -> Optional[float]:
    """Exact ``percentile(column, p)`` (linear interpolation) of a decimal column, as a Python float.

    ``None`` when there are no non-null values. Call it once and use it as a literal. Unless ``df``
    is a ``written`` table, its one column is written first, so that its plan runs once.
    """
    scale = df.schema[column].dataType.scale
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    folder = RunFolder(df.sparkSession, "percentile")
    try:
        if not written:
            values = folder.cut(values, "values")
        found = holding(values, by_magnitude(F.col("v"), scale), 0, p, None)
        if not found:
            return None
        total = found[0]["total"]
        pos = p * (total - 1)
        while len(found) == 1 and found[0]["least"] != found[0]["greatest"]:
            b = found[0]
            within = values.where(F.col("v").between(F.lit(b["least"]), F.lit(b["greatest"])))
            found = holding(within, evenly(F.col("v"), b["least"], b["greatest"], scale), b["upto"] - b["n"], p, total)
        # ranks in two buckets: the last value of one, the first of the next
        lo, hi = found[0]["greatest"], found[-1]["least"]
        return float(lo) + (float(hi) - float(lo)) * (pos - math.floor(pos))
    finally:
        folder.delete()
