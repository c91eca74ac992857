"""First-wins de-duplication, repeated keys and conflicting copies by one aggregate per key.

``keyed_rows`` reads the rows once and exchanges them once: every map task combines the rows
of a key into its first row, its number of copies and the extremes of a 128-bit fingerprint,
so a hot key (or one of a handful of dimension names) is one row a task before the shuffle.
The first row, whether the key repeats and whether its copies differ all come from that row;
no join follows. What a query does not use of it is pruned.
"""

from __future__ import annotations

from itertools import chain
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcash.sources.raw import SEQ

COPIES, DIFFERS = "_copies", "_differs"


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; nulls are told from values and from each other's places."""
    cells = list(chain.from_iterable((F.col(c), F.col(c).isNull()) for c in columns))
    return [F.xxhash64(F.lit(seed), *cells) for seed in (17, 83)]


def keyed_rows(df: DataFrame, key: str, order: str = SEQ, compare: Sequence[str] = None) -> DataFrame:
    """One row per ``key``: the columns of its first row in ``order``, ``_copies`` (its number of
    rows) and ``_differs`` (whether they differ in any of ``compare``, by default all columns
    but the order; nulls compare equal)."""
    others = [c for c in df.columns if c != key]
    one, two = fingerprint(compare or [c for c in others if c != order])
    seen = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.col(order)).alias("_first"), F.count(F.lit(1)).alias(COPIES),
        F.min(one).alias("_lo1"), F.max(one).alias("_hi1"), F.min(two).alias("_lo2"), F.max(two).alias("_hi2"))
    differs = (F.col("_lo1") != F.col("_hi1")) | (F.col("_lo2") != F.col("_hi2"))
    return seen.select(key, *[F.col("_first")[c].alias(c) for c in others], COPIES, differs.alias(DIFFERS))


def first_per_key(df: DataFrame, key: str, order: str = SEQ) -> DataFrame:
    """Keep, for each ``key``, the row with the smallest ``order`` (file order)."""
    return keyed_rows(df, key, order).drop(COPIES, DIFFERS)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their row count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def all_copies(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once."""
    return df.join(repeated_keys(df, key).select(key), on=key, how="left_semi")


def conflicting_keys(df: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Keys whose copies differ in any of ``compare`` (nulls compare equal), with the number of
    variants and of rows. Only keys and fingerprints are exchanged, equal ones combined first."""
    one, two = fingerprint(compare)
    variants = df.select(key, one.alias("_one"), two.alias("_two")).groupBy(key, "_one", "_two") \
        .agg(F.count(F.lit(1)).alias("_n"))
    return (variants.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_variants"), F.sum("_n").alias("n_rows"))
            .filter(F.col("n_variants") > 1))
