"""Row numbers over a whole table, without bringing the table into one task.

The rows are range-partitioned by the order, numbered inside their partition, and each
partition adds the number of rows before it: one sum per partition, the only thing that is
ever ordered as a whole. The partitioned rows are written once, so both readings see the
same boundaries.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arcash.session import RunFolder


def running_total(df: DataFrame, order: Sequence[Column], weight: str, folder: RunFolder,
                  name: str = "ranged") -> DataFrame:
    """``df`` with ``_upto``: the sum of ``weight`` over this row and all rows before it."""
    ranged = folder.cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    # one row per partition
    before = F.sum("_w").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy("_part").agg(F.sum(weight).alias("_w"))
               .select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    within = F.sum(weight).over(Window.partitionBy("_part").orderBy(*order)
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.withColumn("_within", within).join(offsets, "_part")
            .withColumn("_upto", F.col("_before") + F.col("_within")).drop("_part", "_within", "_before"))
