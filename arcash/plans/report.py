"""The validation report of a run as a one-row DataFrame.

Most figures are counted while the run writes its tables (``RunFolder.cut(observe=...)``): the
report reads them, not the tables. What is left are the raw row counts, the large amounts
(one column, once the p99 is known), the customers whose tier and limit disagree, and the
dates without a calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash import config as C
from arcash.plans.star import Star

DATES = ("issue_date", "due_date", "payment_date")
TABLES = {"DimCustomer": "dim_customer", "DimCategory": "dim_category", "DimPaymentMethod": "dim_payment_method",
          "DimInvoiceStatus": "dim_invoice_status", "DimDate": "dim_date", "FactInvoice": "fact",
          "forecast_by_invoice": "forecast_by_invoice", "forecast_weekly": "forecast_weekly"}


def missing_days(fact: DataFrame, days: DataFrame) -> dict:
    """Rows of each date column without a calendar day, from its distinct dates."""
    keys = (fact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("date")) for c in DATES])))
            .where("date is not null").groupBy("c", "date").agg(F.count(F.lit(1)).alias("n")))
    lost = keys.join(days.select("date"), on="date", how="left_anti")
    return lost.agg(*[F.coalesce(F.sum(F.when(F.col("c") == c, F.col("n"))), F.lit(0)).alias(c) for c in DATES]) \
        .first().asDict()


def figures(s: Star) -> dict:
    """The report's values by name; ``s`` must write its tables (materialize and review)."""
    fc, cfg = s.fact_clean, s.cfg
    tables = s.tables()                              # writes what is not written yet
    n = {t: s.figures(name) for t, name in TABLES.items()}
    routed, fact = s.figures("fact_routed"), n["FactInvoice"]
    threshold = None if fc.p99 is None else cfg.outlier_factor * fc.p99
    large = 0 if threshold is None else fc.valid_amounts.filter(F.col("amount_incl_gst") > F.lit(threshold)).count()
    missing = missing_days(tables["FactInvoice"], tables["DimDate"])
    by_invoice, weekly = n["forecast_by_invoice"]["total"], n["forecast_weekly"]["total"]
    return {
        "fact_rows_before": fc.raw_rows.count(), "fact_rows_after": fact["n"],
        "customer_rows_before": s.customers.raw_rows.count(), "customer_rows_after": n["DimCustomer"]["n"],
        **{f"rows_{t}": n[t]["n"] for t in C.LOAD_ORDER},
        "due_dates_kept": routed["due_kept"], "due_dates_recomputed": routed["due_recomputed"],
        "orphan_rows": routed["orphans"],
        "duplicate_invoice_rows": routed["duplicate_rows"], "duplicate_invoice_ids": routed["duplicate_ids"],
        "conflicting_invoice_ids": routed["conflicting_ids"],
        "invalid_amount_rows": routed["invalid_amounts"], "invalid_date_rows": routed["invalid_dates"],
        "unknown_category_rows": fact["unknown_category"],
        "unknown_industry_rows": n["DimCustomer"]["unknown_industry"],
        "unknown_payment_method_rows": fact["unknown_method"],
        "tier_credit_limit_mismatches": s.customers.tier_mismatch.count(),
        "large_invoice_amount_warnings": large,
        "status_corrected_rows": routed["status_corrected"], "gst_rule_violations": routed["bad_gst"],
        **{f"{c}_dimdate_orphans": missing[c] for c in DATES},
        "total_invoiced": fact["total"], "open_ar": fact["open_ar"],
        "forecast_by_invoice_total": by_invoice, "forecast_weekly_total": weekly,
        "reconciliation_difference": by_invoice - weekly,
    }


def validation_report(s: Star) -> DataFrame:
    if not (s.materialize and s.review):
        s = Star(s.inputs, s.cfg, materialize=True, review=True)
    money = {"total_invoiced", "open_ar", "forecast_by_invoice_total", "forecast_weekly_total", "reconciliation_difference"}
    row = [F.lit(v).cast("decimal(32,2)" if name in money else "bigint").alias(name) for name, v in figures(s).items()]
    tol = F.lit(s.cfg.forecast_tol).cast("decimal(10,2)")
    return SparkSession.active().range(1).select(*row, tol.alias("reconciliation_tolerance")).withColumn(
        "reconciliation_status",
        F.when(F.abs("reconciliation_difference") <= tol, F.lit("PASS")).otherwise(F.lit("FAIL")))
