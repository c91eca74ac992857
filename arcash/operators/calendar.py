"""Date dimensions over the span of every date the star uses.

The calendar row count is bounded by the date span (days), not by data volume, so the
single ``explode(sequence(min, max))`` is safe; min/max are partial aggregates.
"""

from __future__ import annotations

from typing import Sequence, Tuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_span(sources: Sequence[Tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row (lo, hi) over all non-null dates in the given (frame, columns) pairs."""
    parts = []
    for df, cols in sources:
        cs = [F.col(c) for c in cols]
        lo = F.least(*cs) if len(cs) > 1 else cs[0]
        hi = F.greatest(*cs) if len(cs) > 1 else cs[0]
        parts.append(df.agg(F.min(lo).alias("lo"), F.max(hi).alias("hi")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def calendar_days(span: DataFrame, pad_days: int = 0) -> DataFrame:
    return (span.filter(F.col("lo").isNotNull())
            .select(F.explode(F.sequence(F.col("lo"), F.date_add(F.col("hi"), pad_days))).alias("date")))


def dim_date(sources, pad_days: int = 0) -> DataFrame:
    """date_key (yyyymmdd), date, year, quarter ('Q1'..), month_no, month_name ('Jan'..)."""
    d = F.col("date")
    return calendar_days(date_span(sources), pad_days).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d.alias("date"),
        F.year(d).alias("year"), F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month_no"), F.date_format(d, "MMM").alias("month_name"))


def dim_date_fiscal(sources, pad_days: int = 2) -> DataFrame:
    """Legacy extended calendar: financial year starting 1 July, weekday and month-end flags,
    with a 2-day buffer after the last date."""
    d = F.col("date")
    fy = F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)
    return calendar_days(date_span(sources), pad_days).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d.alias("date"),
        F.year(d).alias("year"), F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month_no"), F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "MMM yyyy").alias("month_year"),
        F.concat(F.lit("FY"), F.lpad((fy % 100).cast("string"), 2, "0")).alias("fin_year"),
        F.concat(F.lit("FQ"), F.quarter(F.add_months(d, 6)).cast("string")).alias("fin_qtr"),
        F.date_format(d, "EEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (F.last_day(d) == d).alias("is_month_end"))
