"""Exact percentiles by bucket refinement, against sorted values."""

import math
import random
from decimal import Decimal

import pytest

from arcash.operators import stats
from arcash.operators.stats import exact_percentile


def plain(values, p):
    v = sorted(x for x in values if x is not None)
    pos = p * (len(v) - 1)
    lo, hi = v[math.floor(pos)], v[min(math.floor(pos) + 1, len(v) - 1)]
    return float(lo) + (float(hi) - float(lo)) * (pos - math.floor(pos))


def cents(*units):
    return [None if u is None else Decimal(u).scaleb(-2) for u in units]


rnd = random.Random(7)
CASES = {
    "one huge amount": cents(*range(1, 400), 10**17),
    "18 digits close together": cents(*[10**17 + rnd.randrange(10**6) for _ in range(500)]),
    "18 digits far apart": cents(*[rnd.randrange(10**17) for _ in range(500)], -(10**17)),
    "below and above zero": cents(*[rnd.randrange(-500, 500) for _ in range(500)], 0, 0),
    "all equal": cents(*[1234] * 50),
    "a hot value": cents(*[777] * 300, *range(700, 900)),
    "two values": cents(100, 10**12),
    "nulls": cents(None, 5, None, 9, 7),
    "neighbours in different buckets": cents(*[2**k for k in range(50)]),
}


@pytest.mark.parametrize("name", CASES)
def test_any_percentile_equals_sorting(spark, name):
    df = spark.createDataFrame([(v,) for v in CASES[name]], "a decimal(18,2)").repartition(3)
    for p in (0.0, 0.01, 0.5, 0.99, 1.0):
        assert exact_percentile(df, "a", p) == plain(CASES[name], p), p


def test_passes_narrow_the_range(spark, monkeypatch):
    monkeypatch.setattr(stats, "BUCKETS", 4)           # as if the values spanned far more buckets
    values = cents(*[rnd.randrange(10**9) for _ in range(300)])
    df = spark.createDataFrame([(v,) for v in values], "a decimal(18,2)")
    assert exact_percentile(df, "a", 0.9) == plain(values, 0.9)


def test_no_sort_and_no_copy_of_a_written_table(spark, tmp_path, monkeypatch):
    values = cents(*[rnd.randrange(10**7) for _ in range(2000)])
    spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a decimal(22,2), other int").write.parquet(str(tmp_path / "t"))
    plans, real = [], stats.holding

    def seen(table, bucket, *rest):
        plans.append(table.groupBy(bucket.alias("k")).count()._jdf.queryExecution().executedPlan().toString())
        return real(table, bucket, *rest)
    monkeypatch.setattr(stats, "holding", seen)
    monkeypatch.setattr(stats.RunFolder, "cut", lambda *a, **k: pytest.fail("a copy was written"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert exact_percentile(df, "a", 0.99, written=True) == plain(values, 0.99)
    assert len(plans) <= 2
    for plan in plans:
        assert "Sort" not in plan and "rangepartitioning" not in plan and "other" not in plan
        assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
