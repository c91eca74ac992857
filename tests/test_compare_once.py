"""Two runs over the same exports share the parsed first invoice rows."""

import dataclasses

from pyspark.sql import functions as F

from arcash import config as C
from tests.test_clean_cost import _tables


def test_compare_runs_cleans_the_export_once(spark, tmp_path, monkeypatch):
    from arcash.operators import fact
    from arcash.plans.catalog import queries
    from arcash.plans.star import star_for
    calls, keyed = [], fact.keyed_rows
    monkeypatch.setattr(fact, "keyed_rows", lambda df, key, *a, **k: calls.append(key) or keyed(df, key, *a, **k))
    rows = {r["metric"]: r for r in queries()["compare_runs"](spark, _tables(spark, tmp_path)).collect()}
    assert calls == ["invoice_id"]
    alone = star_for(spark, str(tmp_path), dataclasses.replace(C.FORECAST, snapshot="2026-02-28")).fact
    seen = alone.agg(F.count("*").alias("n"), F.sum("amount_incl_gst").cast("double").alias("total")).first()
    assert (seen["n"], seen["total"]) == (rows["rows.FactInvoice"]["previous"], rows["total_invoiced"]["previous"])
