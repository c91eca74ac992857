"""Small dimensions: category, payment method, invoice status.

Each is: canonicalise names, fill blank attributes from the fixed maps, keep the first row
(in ingest order) per canonical name, and append an ``Unknown`` member when absent so
imputed fact values can join. First-wins is an aggregation (``min_by`` on ``_seq``), so
the raw export may be arbitrarily long and skewed. It runs twice: over the spellings as they
are written, so that the rules for names and attributes see one row per spelling, and then
over canonical names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import canon, is_blank, lookup, strip, to_int_id
from arcash.operators.dedup import first_per_key
from arcash.sources.raw import SEQ


def first_named(df: DataFrame, name: str, default: dict = None) -> DataFrame:
    """The first row of each ``name``; ``default`` is one more row behind all others, so it stays
    only if no row has its name."""
    rows = df.withColumn("_order", F.struct(F.lit(0).alias("late"), F.col(SEQ).alias("seq"))).drop(SEQ)
    if default:
        member = [F.lit(default.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "_order"]
        last = F.struct(F.lit(1).alias("late"), F.lit(None).cast(df.schema[SEQ].dataType).alias("seq"))
        rows = rows.unionByName(df.sparkSession.range(1).select(*member, last.alias("_order")))
    return first_per_key(rows, name, "_order").drop("_order")


def dim_category(raw: DataFrame) -> DataFrame:
    df = (first_per_key(raw, "category").withColumn("category_id", to_int_id("category_id"))
          .withColumn("category", canon("category", C.CATEGORY_CANON))
          .withColumn("revenue_group", F.when(is_blank("revenue_group"), lookup(C.REVENUE_GROUP, F.col("category")))
                      .otherwise(F.col("revenue_group"))))
    first = first_named(df.select("category", "category_id", "revenue_group", SEQ), "category",
                        {"category_id": 0, "category": "Unknown", "revenue_group": "Unknown"})
    return first.select(F.col("category_id").cast("bigint"), "category", "revenue_group")


def method_name(c) -> F.Column:
    """Method names: mapped synonym, else the stripped text; blank -> null."""
    return F.when(is_blank(c), F.lit(None).cast("string")) \
        .otherwise(F.coalesce(lookup(C.METHOD_CANON, F.lower(strip(c))), strip(c)))


def dim_payment_method(raw: DataFrame) -> DataFrame:
    df = (first_per_key(raw, "payment_method").withColumn("method_id", to_int_id("method_id"))
          .withColumn("payment_method", method_name(F.col("payment_method")))
          .withColumn("method_type", F.when(is_blank("method_type"), lookup(C.METHOD_TYPE, F.col("payment_method")))
                      .otherwise(F.col("method_type")))
          .filter(F.col("payment_method").isNotNull()))
    first = first_named(df.select("payment_method", "method_id", "method_type", SEQ), "payment_method",
                        {"method_id": 0, "payment_method": "Unknown", "method_type": "Unknown"})
    return first.select(F.col("method_id").cast("bigint"), "payment_method", "method_type")


def dim_invoice_status(raw: DataFrame) -> DataFrame:
    """Blank status -> Open; first row per status; no Unknown member."""
    df = (first_per_key(raw, "status").withColumn("status_id", to_int_id("status_id"))
          .withColumn("status", canon("status", C.STATUS_CANON, missing="Open")))
    first = first_named(df.select("status", "status_id", "description", SEQ), "status")
    return first.select(F.col("status_id").cast("bigint"), "status", "description")
