"""CSV scan with ingest order, exact percentile, refresh + publish, oracle agreement."""

import json
import os
import random
from types import SimpleNamespace
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from arcash import config as C
from arcash.operators.stats import exact_percentile
from arcash.sources import read_raw_csv, scrub_nulls
from arcash.operators.customers import clean_customers

from tests.helpers import SF_SMALL, rows


def test_csv_scan_orders_rows_by_file_and_position(spark, tmp_path):
    d = tmp_path / "cust"
    d.mkdir()
    # Columns in a different order than the schema; two files, the first wins on ids.
    (d / "a.csv").write_text("state,customer_id,customer_name,industry,member_tier,payment_terms_days,credit_limit,member_since\n"
                             "NSW,CUST001,First,tech,std,14,5000,2020-01-01\nNSW,CUST002,N/A,law,std,14,5000,\n")
    (d / "b.csv").write_text("customer_id,customer_name,industry,member_tier,payment_terms_days,credit_limit,member_since,state\n"
                             "CUST001,Second,tech,std,14,5000,2020-01-01,NSW\n")
    raw = scrub_nulls(read_raw_csv(spark, str(d), "DimCustomer"))
    assert raw.columns[:8] == ["customer_id", "customer_name", "industry", "member_tier",
                               "payment_terms_days", "credit_limit", "member_since", "state"]
    clean = clean_customers(raw).clean
    assert rows(clean, "customer_id", "customer_name") == [(1, "First"), (2, "Unknown Customer 2")]


def test_missing_file_and_column(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "nope.csv"), "DimCategory")
    p = tmp_path / "cat.csv"
    p.write_text("category_id,category\nCAT01,Membership Income\n")
    with pytest.raises(ValueError):
        read_raw_csv(spark, str(p), "DimCategory")


@pytest.mark.parametrize("n", [1, 2, 1000, 20_000])
def test_exact_percentile_matches_numpy(spark, n):
    rnd = random.Random(n)
    vals = [Decimal(rnd.randint(1, 10**7)) / 100 for _ in range(n)]
    vals += vals[: n // 3]                      # repeated values (a hot amount)
    df = spark.createDataFrame([(v,) for v in vals], "a decimal(18,2)")
    got = exact_percentile(df, "a", 0.99)
    want = float(np.percentile(np.array([float(v) for v in vals]), 99))
    assert got == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_exact_percentile_empty(spark):
    assert exact_percentile(spark.createDataFrame([], "a decimal(18,2)"), "a", 0.99) is None


def test_refresh_publishes_and_compares(spark, tmp_path):
    from arcash.plans.publish import current_run, read_published
    from arcash.plans.refresh import run_refresh
    from arcash.sources.derived import load_inputs
    base = str(tmp_path / "pub")
    inputs = load_inputs(spark, SF_SMALL)
    before = run_folders(spark)
    r1 = run_refresh(spark, inputs, base, C.FORECAST, run_id="r1")
    assert current_run(spark, base) == "r1"
    pub = read_published(spark, base)
    assert {f"rows_{k}": v.count() for k, v in pub.items()} == {
        k: v for k, v in r1.report["figures"].items() if k.startswith("rows_")}
    saved = json.loads((tmp_path / "pub" / "run_id=r1" / "_validation_report.json").read_text())
    assert saved["figures"]["rows_FactInvoice"] > 0 and saved["compare_with_previous"] == []
    assert saved["figures"]["reconciliation_status"] == "PASS" and "duplicate_invoice_rows" in saved["figures"]
    assert r1.review["unusable_invoice_id"].count() == 0
    assert run_folders(spark) == before                     # nothing of the run is left behind
    r2 = run_refresh(spark, inputs, base, C.FORECAST, run_id="r2")
    assert current_run(spark, base) == "r2"
    changed = [m for m in r2.report["compare_with_previous"] if m["changed"]]
    assert len(r2.report["compare_with_previous"]) == 11 and changed == []


def run_folders(spark):
    return [p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith("arcash-star")]


def test_csv_publish_reads_back_and_compares_with_a_partial_run(spark, tmp_path):
    from arcash.plans import publish as P
    from arcash.plans.star import star_for
    base = str(tmp_path / "pub")
    s = star_for(spark, SF_SMALL, materialize=True)
    tables = {n: s.tables()[n] for n in ("DimCustomer", "FactInvoice")}
    P.publish(spark, tables, base, "a", fmt="csv")
    back = P.read_published(spark, base)
    for n, df in tables.items():
        assert back[n].dtypes == df.dtypes and rows(back[n]) == rows(df)
    got = P.compare_runs(P.run_metrics(back), P.run_metrics(s.tables())).collect()
    new = {r.metric for r in got if r.changed}
    assert "rows.DimDate" in new and "rows.FactInvoice" not in new and len(got) == 11
    s.close()


def test_runs_are_compared_from_stored_metrics(spark, tmp_path):
    from arcash.plans import publish as P
    base = str(tmp_path / "pub")
    fact = spark.createDataFrame([(i, Decimal("10.25")) for i in range(4)], "invoice_id int, amount_incl_gst decimal(18,2)")
    days = spark.createDataFrame([(1,)], "date_key int")
    P.publish(spark, {"FactInvoice": fact, "DimDate": days}, base, "a", report={"compare_with_previous": []})
    report = {"compare_with_previous": None}
    P.publish(spark, {"FactInvoice": fact.limit(3), "DimDate": days.limit(0)}, base, "b", report=report, fmt="csv")
    want = [("rows.DimDate", "count", 1, 0, True), ("rows.FactInvoice", "count", 4, 3, True),
            ("total_invoiced", "total", Decimal("41.00"), Decimal("30.75"), True)]
    assert [(r["metric"], r["kind"], r["previous"], r["current"], r["changed"])
            for r in report["compare_with_previous"]] == want
    got = P.compare_published(spark, base, "a")
    assert rows(got, "metric", "kind", "previous", "current", "changed") == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan and "Scan csv" not in plan
    assert not any(r.changed for r in P.compare_published(spark, base, "b", "b").collect())
    # the same metrics as those taken from the tables; a run without the file is read instead
    for rid in "ab":
        tables = P.read_published(spark, base, rid)
        stored = rows(P.stored_metrics(spark, base, rid))
        assert rows(P.run_metrics(tables)) == stored
        (tmp_path / "pub" / f"run_id={rid}" / P.METRICS).rename(tmp_path / f"{rid}.json")
        assert rows(P.stored_metrics(spark, base, rid)) == stored
    with pytest.raises(ValueError):
        P.compare_published(spark, base, "none")
    assert P.stored_metrics(spark, str(tmp_path / "nothing")) is None


def test_pointer_switch_is_one_rename(spark, tmp_path):
    from arcash.plans import publish as P
    base = str(tmp_path)
    P.write_text(spark, f"{base}/{P.POINTER}", "one")
    (tmp_path / f"{P.POINTER}.tmp").write_text("half")       # a crash between write and switch
    assert P.current_run(spark, base) == "one"
    P.write_text(spark, f"{base}/{P.POINTER}", "two")
    assert P.current_run(spark, base) == "two" and not (tmp_path / f"{P.POINTER}.tmp").exists()


def test_single_reader_queries_write_nothing(spark):
    import __spark_entry__ as E
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    for name in ("aging_buckets", "dup_invoices", "invalid_amounts"):
        assert E.queries()[name](spark, SF_SMALL).count() > 0
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == before


def test_dedup_is_one_exchange_without_a_join(spark):
    from arcash.operators.dedup import conflicting_keys, first_per_key, keyed_rows
    rows_ = [(i % 50, None if i == 53 else f"v{i % 50}", i) for i in range(60)] + [(None, "n", 90), (None, "n", 80)]
    df = spark.createDataFrame(rows_, "k int, v string, _seq long").repartition(3)
    got = {r.k: (r.v, r._seq, r._copies, r._differs) for r in keyed_rows(df, "k").collect()}
    assert got == {k: (f"v{k}", k, 1 + (k < 10), k == 3) for k in range(50)} | {None: ("n", 80, 2, False)}
    assert first_per_key(df, "k").columns == ["k", "v", "_seq"]
    assert rows(conflicting_keys(df, "k", ["v"])) == [(3, 2, 2)]
    plan = first_per_key(spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumnRenamed("o_orderkey", "_seq"), "o_custkey") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_null_and_a_value_in_each_other_s_place_differ(spark):
    from arcash.operators.dedup import conflicting_keys, keyed_rows
    df = spark.createDataFrame([(1, "a", None, 1), (1, None, "a", 2)], "k int, v string, w string, _seq long")
    assert keyed_rows(df, "k").first()._differs and rows(conflicting_keys(df, "k", ["v", "w"])) == [(1, 2, 2)]


def test_debtors_are_all_ranked(spark):
    import __spark_entry__ as E
    got = E.queries()["ar_concentration_debtor"](spark, SF_SMALL).orderBy("debtor_rank").collect()
    assert [r.debtor_rank for r in got] == list(range(1, len(got) + 1)) and len(got) > 10
    assert all(a.open_ar >= b.open_ar for a, b in zip(got, got[1:]))


def test_session_settings():
    from arcash.session import settings
    conf = settings()
    assert "spark.master" not in conf and "spark.sql.shuffle.partitions" not in conf
    conf = settings("local[2]", 6, {"spark.x": "y"})
    assert (conf["spark.master"], conf["spark.sql.shuffle.partitions"], conf["spark.x"]) == ("local[2]", "6", "y")


def test_no_scratch_folder_on_a_cluster():
    from arcash.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(
        getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)


def test_result_invariant_under_repartitioning(spark):
    from arcash.plans.star import Star
    from arcash.sources.derived import RawInputs, load_inputs
    inputs = load_inputs(spark, SF_SMALL)
    shuffled = RawInputs(*[getattr(inputs, k).repartition(7, F.rand(3)) for k in RawInputs._fields])
    a = rows(Star(inputs).forecast_weekly)
    b = rows(Star(shuffled).forecast_weekly)
    assert a == b and len(a) > 0


ORACLE_SUBSET = ["forecast_weekly", "fact_invoice", "dim_customer", "dim_category", "status_corrections",
                 "amount_outliers", "lag_source_mix", "cash_milestones"]


def test_oracle_agreement_on_a_subset(spark):
    import duckdb
    import __spark_entry__ as E
    from scripts.oracle_check import canon_rows
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    for name in ORACLE_SUBSET:
        df = qs[name](spark, SF_SMALL)
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert canon_rows(df.columns, [tuple(r) for r in df.collect()]) == canon_rows(dcols, cur.fetchall()), name
