"""Named queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Each builds the run from the given tables (raw exports derived from ``orders`` and
``customer``), applies one operator or reads one output of the star, and returns the
report form (``present``: ISO dates, decimals as doubles). Column names are fixed here
and mirrored by the SQL oracle.
"""

from __future__ import annotations

import dataclasses
from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import (canon, canon_known, canon_or_null, format_id, normalise_state,
                              repair_issue_date, repair_payment_date, to_int_id, to_number, to_terms)
from arcash.functions.dates import with_date
from arcash.functions.numbers import round_money
from arcash.operators import measures as M
from arcash.operators import quality as Q
from arcash.operators.customers import derive_member_tier, derive_payment_terms, fill_customer_name
from arcash.operators.forecast import lag_divergence, lag_source_mix
from arcash.plans.star import Star, present, star_for
from arcash.sources.derived import derived_raw, load_inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: Dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        REGISTRY[name].__name__ = name
        return fn
    return deco


def _star(spark, sf_dir, cfg=C.FORECAST) -> Star:
    """The lazy run for a query with one reader of each table: nothing is written, and the
    query's columns and filters reach the scan."""
    return star_for(spark, sf_dir, cfg)


def _shared(spark, sf_dir, cfg=C.FORECAST) -> Star:
    """The run for a query of which several branches read the gated fact: it is written once."""
    return star_for(spark, sf_dir, cfg, materialize=True)


def _raw(spark, sf_dir, table):
    return derived_raw(spark, sf_dir, table)


# ---- 2.1 scans / sinks --------------------------------------------------------------

@query("scrub_nulls")
def q_scrub_nulls(spark, sf_dir):
    """Raw customer export with missing-value placeholders turned into nulls."""
    return _raw(spark, sf_dir, "DimCustomer")


# ---- 2.2 scalar projections ---------------------------------------------------------

@query("parse_money")
def q_parse_money(spark, sf_dir):
    r = _raw(spark, sf_dir, "FactInvoice")
    return r.select("_seq", F.col("amount_incl_gst").alias("amount_incl_gst_text"),
                    to_number("amount_incl_gst").alias("amount_incl_gst"),
                    to_number("gst").alias("gst"), to_number("amount_paid").alias("amount_paid"))


@query("parse_ids")
def q_parse_ids(spark, sf_dir):
    r = _raw(spark, sf_dir, "FactInvoice")
    return r.select("_seq", F.col("invoice_id").alias("invoice_id_text"),
                    to_int_id("invoice_id").alias("invoice_id"),
                    F.col("customer_id").alias("customer_id_text"),
                    to_int_id("customer_id").alias("customer_id"))


@query("format_ids")
def q_format_ids(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCustomer")
    return r.select("_seq", F.col("customer_id").alias("customer_id_text"),
                    format_id("customer_id", "CUST", 3).alias("customer_label"))


@query("parse_dates")
def q_parse_dates(spark, sf_dir):
    r = _raw(spark, sf_dir, "FactInvoice")
    for c in ("issue_date", "due_date", "payment_date"):
        r = with_date(r, c, f"{c}_parsed")
    return r.select("_seq", "issue_date", "issue_date_parsed", "due_date", "due_date_parsed",
                    "payment_date", "payment_date_parsed")


@query("parse_untidy")
def q_parse_untidy(spark, sf_dir):
    """Dates with full month names and cells padded with no-break spaces, derived from orders."""
    from arcash.sources.derived import UNTIDY_SQL
    r = spark.sql(UNTIDY_SQL, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return with_date(r, "date_text", "date_parsed").select(
        "_seq", "date_text", "date_parsed", "amount_text", to_number("amount_text").alias("amount"), "method_text",
        canon_or_null("method_text", C.METHOD_CANON).alias("payment_method"))


@query("repair_dates")
def q_repair_dates(spark, sf_dir):
    cfg = C.DEFAULT
    r = with_date(with_date(_raw(spark, sf_dir, "FactInvoice"), "issue_date", "_i"), "payment_date", "_p")
    return r.select("_seq", F.col("_i").alias("issue_parsed"),
                    repair_issue_date(F.col("_i"), cfg).alias("issue_repaired"),
                    F.col("_p").alias("payment_parsed"),
                    repair_payment_date(F.col("_p"), cfg).alias("payment_repaired"))


@query("canon_dimension_names")
def q_canon_dimension_names(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCategory")
    return r.select("_seq", F.col("category").alias("category_text"),
                    canon("category", C.CATEGORY_CANON).alias("category"))


@query("canon_industry_category")
def q_canon_industry_category(spark, sf_dir):
    cust = _raw(spark, sf_dir, "DimCustomer").select(
        F.lit("DimCustomer.industry").alias("source"), "_seq", F.col("industry").alias("raw_value"),
        canon_known("industry", C.INDUSTRY_CANON, sorted(set(C.INDUSTRY_CANON.values()))).alias("canonical"))
    fact = _raw(spark, sf_dir, "FactInvoice").select(
        F.lit("FactInvoice.category").alias("source"), "_seq", F.col("category").alias("raw_value"),
        canon_known("category", C.CATEGORY_CANON, list(C.REVENUE_GROUP)).alias("canonical"))
    return cust.unionByName(fact)


@query("canon_payment_method")
def q_canon_payment_method(spark, sf_dir):
    r = _raw(spark, sf_dir, "FactInvoice")
    return r.select("_seq", F.col("payment_method").alias("payment_method_text"),
                    canon_or_null("payment_method", C.METHOD_CANON).alias("payment_method"))


@query("derive_member_tier")
def q_derive_member_tier(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCustomer")
    return r.select("_seq", F.col("member_tier").alias("member_tier_text"), "credit_limit",
                    derive_member_tier(F.col("member_tier"), to_number("credit_limit")).alias("member_tier"))


@query("derive_payment_terms")
def q_derive_payment_terms(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCustomer").withColumn(
        "_tier", derive_member_tier(F.col("member_tier"), to_number("credit_limit")))
    return r.select("_seq", F.col("payment_terms_days").alias("payment_terms_text"),
                    F.col("_tier").alias("member_tier"),
                    derive_payment_terms(to_terms("payment_terms_days"), F.col("_tier")).alias("payment_terms_days"))


@query("normalise_state")
def q_normalise_state(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCustomer")
    return r.select("_seq", F.col("state").alias("state_text"), normalise_state("state").alias("state"))


@query("fill_customer_name")
def q_fill_customer_name(spark, sf_dir):
    r = _raw(spark, sf_dir, "DimCustomer")
    return r.select("_seq", F.col("customer_name").alias("customer_name_text"),
                    fill_customer_name(F.col("customer_name"), to_int_id("customer_id")).alias("customer_name"))


def _gst_rows(spark, sf_dir, recompute: bool):
    r = _raw(spark, sf_dir, "FactInvoice")
    incl = to_number("amount_incl_gst")
    gst = round_money(incl / F.lit(C.GST_DIVISOR)) if recompute else round_money(F.coalesce(to_number("gst"), F.lit(0)))
    return (r.select("_seq", incl.alias("amount_incl_gst"), gst.alias("gst"))
            .withColumn("amount_excl_gst", round_money(F.col("amount_incl_gst") - F.col("gst"))))


@query("gst_split")
def q_gst_split(spark, sf_dir):
    return _gst_rows(spark, sf_dir, False)


@query("gst_recompute")
def q_gst_recompute(spark, sf_dir):
    """Legacy profile: GST recomputed as incl / 11."""
    return _gst_rows(spark, sf_dir, True)


@query("due_date_repair")
def q_due_date_repair(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.due_repair


@query("derive_status")
def q_derive_status(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.status_derivation


@query("normalise_payment")
def q_normalise_payment(spark, sf_dir):
    f = _star(spark, sf_dir).fact_clean.clean
    return f.select("invoice_id", "status", "payment_date", "amount_incl_gst", "amount_paid")


# ---- 2.3 review sets and gates --------------------------------------------------------

@query("dup_customers")
def q_dup_customers(spark, sf_dir):
    return _star(spark, sf_dir).customers.duplicates


@query("dup_invoices")
def q_dup_invoices(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.duplicates


@query("dup_invoice_conflicts")
def q_dup_invoice_conflicts(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.conflicts


@query("dup_invoice_conflicts_planted")
def q_dup_invoice_conflicts_planted(spark, sf_dir):
    """The conflict listing over an export in which some copies differ in one cell: every
    700th invoice is repeated with another status, every 900th with another amount."""
    from arcash.operators.dedup import conflicting_keys
    from arcash.operators.fact import with_fact_ids
    raw = _raw(spark, sf_dir, "FactInvoice")
    more = (raw.where("_seq % 700 = 4").withColumn("status", F.lit("Open?"))
            .unionByName(raw.where("_seq % 900 = 8").withColumn("amount_incl_gst", F.lit("0.01"))))
    return conflicting_keys(with_fact_ids(raw.unionByName(more)), "invoice_id",
                            [c for c in raw.columns if c not in ("invoice_id", "_seq")])


@query("invalid_amounts")
def q_invalid_amounts(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.invalid_amounts.select(
        "invoice_id", "customer_id", "amount_incl_gst", "gst", "amount_paid")


@query("amount_outliers")
def q_amount_outliers(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.outliers.select(
        "invoice_id", "customer_id", "amount_incl_gst", "p99_amount_incl_gst", "outlier_threshold")


@query("invalid_dates")
def q_invalid_dates(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.invalid_dates.select(
        "invoice_id", "customer_id", "issue_date", "due_date", "payment_date",
        "parsed_issue_date", "parsed_due_date", "parsed_payment_date")


@query("status_corrections")
def q_status_corrections(spark, sf_dir):
    return _star(spark, sf_dir).fact_clean.status_corrections


@query("suspicious_names")
def q_suspicious_names(spark, sf_dir):
    return _star(spark, sf_dir).customers.name_warnings


@query("tier_limit_mismatch")
def q_tier_limit_mismatch(spark, sf_dir):
    return _star(spark, sf_dir).customers.tier_mismatch


@query("unknown_mappings")
def q_unknown_mappings(spark, sf_dir):
    s = _star(spark, sf_dir)
    return Q.unknown_mappings(s.dim_customer, s.fact)


@query("orphan_facts")
def q_orphan_facts(spark, sf_dir):
    return _star(spark, sf_dir).gated.orphans


@query("bad_gst")
def q_bad_gst(spark, sf_dir):
    return _star(spark, sf_dir).gated.bad_gst


@query("referential_integrity")
def q_referential_integrity(spark, sf_dir):
    return Q.referential_integrity(_shared(spark, sf_dir).tables())


@query("referential_integrity_planted")
def q_referential_integrity_planted(spark, sf_dir):
    """The integrity counts over a star whose parents lack some keys."""
    t = _shared(spark, sf_dir).tables()
    lost = {"DimCustomer": "customer_id % 50 = 3", "DimCategory": "category = 'Events Income'",
            "DimInvoiceStatus": "status = 'Open'", "DimPaymentMethod": "payment_method = 'BPAY'",
            "DimDate": "day(date) = 5"}
    return Q.referential_integrity({n: df.where(f"not ({lost[n]})") if n in lost else df for n, df in t.items()})


@query("quality_report")
def q_quality_report(spark, sf_dir):
    return Q.quality_report(_star(spark, sf_dir).fact)


@query("constraint_violations")
def q_constraint_violations(spark, sf_dir):
    return Q.constraint_violations(_shared(spark, sf_dir).tables())


# ---- 2.4 dimensions and the fact ---------------------------------------------------------

@query("dim_category")
def q_dim_category(spark, sf_dir):
    return _star(spark, sf_dir).dim_category


@query("dim_payment_method")
def q_dim_payment_method(spark, sf_dir):
    return _star(spark, sf_dir).dim_payment_method


@query("dim_invoice_status")
def q_dim_invoice_status(spark, sf_dir):
    return _star(spark, sf_dir).dim_invoice_status


@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return _star(spark, sf_dir).dim_customer


@query("fact_invoice")
def q_fact_invoice(spark, sf_dir):
    return _star(spark, sf_dir).fact


@query("legacy_fact")
def q_legacy_fact(spark, sf_dir):
    """FactInvoice of the legacy profile: GST recomputed, due dates from terms, dates outside
    their window swapped whatever results."""
    return _star(spark, sf_dir, C.LEGACY).fact


def _legacy(spark, sf_dir):
    from arcash.plans.refresh import legacy_tables
    from arcash.session import RunFolder
    return legacy_tables(load_inputs(spark, sf_dir), RunFolder(spark, "legacy"))


@query("legacy_clean_fact")
def q_legacy_clean_fact(spark, sf_dir):
    """FactInvoice of the older job's own clean: nothing set aside but orphans."""
    return _legacy(spark, sf_dir)["FactInvoice"]


@query("legacy_clean_customer")
def q_legacy_clean_customer(spark, sf_dir):
    from arcash.operators.legacy import legacy_customers
    return legacy_customers(load_inputs(spark, sf_dir).customer)


@query("legacy_validation")
def q_legacy_validation(spark, sf_dir):
    """The older job's checks over its six tables, and whether they stop it."""
    from arcash.operators.legacy import legacy_checks
    t = _legacy(spark, sf_dir)
    return legacy_checks({n: df for n, df in t.items() if n != "_orphans"})


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return _shared(spark, sf_dir).dim_date


@query("dim_date_fiscal")
def q_dim_date_fiscal(spark, sf_dir):
    return _star(spark, sf_dir).dim_date_fiscal()


# ---- 2.6 lag statistics and forecast --------------------------------------------------------

@query("lag_by_customer")
def q_lag_by_customer(spark, sf_dir):
    return _star(spark, sf_dir).lags.by_customer.select(
        "customer_id", F.col("value").alias("lag_value"), F.col("n").alias("n_paid"))


@query("lag_by_tier")
def q_lag_by_tier(spark, sf_dir):
    return _star(spark, sf_dir).lags.by_tier.select(
        "member_tier", F.col("value").alias("lag_value"), F.col("n").alias("n_paid"))


@query("lag_overall")
def q_lag_overall(spark, sf_dir):
    """The overall level that the forecast falls back to (0 without paid history)."""
    row = _star(spark, sf_dir).lags.overall
    return row.agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("lag_value"),
                   F.coalesce(F.max("n"), F.lit(0)).alias("n_paid"))


@query("forecast_by_invoice")
def q_forecast_by_invoice(spark, sf_dir):
    return _shared(spark, sf_dir).forecast_by_invoice


@query("lag_source_mix")
def q_lag_source_mix(spark, sf_dir):
    return lag_source_mix(_shared(spark, sf_dir).forecast_by_invoice)


@query("lag_divergence")
def q_lag_divergence(spark, sf_dir):
    return lag_divergence(_star(spark, sf_dir).fact)


@query("forecast_weekly")
def q_forecast_weekly(spark, sf_dir):
    return _shared(spark, sf_dir).forecast_weekly


@query("book_totals")
def q_book_totals(spark, sf_dir):
    return M.book_totals(_star(spark, sf_dir).fact)


@query("forecast_reconciliation")
def q_forecast_reconciliation(spark, sf_dir):
    """By-invoice total vs the weekly schedule's final cumulative value (tolerance 0.01)."""
    s = _shared(spark, sf_dir)
    weekly_total = s.forecast_weekly.agg(F.max_by("cumulative", "week_start")).scalar()
    zero = F.lit(0).cast("decimal(18,2)")
    row = s.forecast_by_invoice.agg(F.coalesce(F.sum("amount_incl_gst"), zero).alias("forecast_by_invoice_total"))
    row = row.withColumn("forecast_weekly_total", F.coalesce(weekly_total, zero))
    diff = F.col("forecast_by_invoice_total") - F.col("forecast_weekly_total")
    tol = F.lit(s.cfg.forecast_tol).cast("decimal(10,2)")
    return row.select("forecast_by_invoice_total", "forecast_weekly_total", diff.alias("difference"),
                      tol.alias("tolerance"),
                      F.when(F.abs(diff) <= tol, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


@query("compare_runs")
def q_compare_runs(spark, sf_dir):
    """Previous run (snapshot one month earlier) vs this run: row counts and key totals."""
    from arcash.plans.publish import compare_runs, run_metrics
    cur = _shared(spark, sf_dir)
    prev = Star(cur.inputs, dataclasses.replace(cur.cfg, snapshot="2026-02-28"), materialize=True)
    # customers and the small dimensions don't depend on the snapshot
    for name in ("dim_customer", "dim_category", "dim_payment_method", "dim_invoice_status"):
        setattr(prev, name, getattr(cur, name))
    cur.share_rows(prev)
    return compare_runs(run_metrics(prev.tables()), run_metrics(cur.tables()))


# ---- 2.8 measures ----------------------------------------------------------------------

@query("collection_rate")
def q_collection_rate(spark, sf_dir):
    return M.collection_rate(_star(spark, sf_dir).fact)


@query("ar_position")
def q_ar_position(spark, sf_dir):
    return M.ar_position(_star(spark, sf_dir).fact)


@query("aging_buckets")
def q_aging_buckets(spark, sf_dir):
    return M.aging_buckets(_star(spark, sf_dir).fact)


@query("ar_concentration_group")
def q_ar_concentration_group(spark, sf_dir):
    s = _star(spark, sf_dir)
    return M.ar_concentration_group(s.fact, s.dim_category)


@query("ar_concentration_debtor")
def q_ar_concentration_debtor(spark, sf_dir):
    s = _star(spark, sf_dir)
    return M.ar_concentration_debtor(s.fact, s.dim_customer, s.folder)


@query("credit_utilisation")
def q_credit_utilisation(spark, sf_dir):
    s = _star(spark, sf_dir)
    return M.credit_utilisation(s.fact, s.dim_customer)


@query("cohort_collection")
def q_cohort_collection(spark, sf_dir):
    return M.cohort_collection(_star(spark, sf_dir).fact)


@query("on_time_by_month")
def q_on_time_by_month(spark, sf_dir):
    return M.on_time_by_month(_star(spark, sf_dir).fact)


@query("days_late_by_tier")
def q_days_late_by_tier(spark, sf_dir):
    s = _star(spark, sf_dir)
    return M.days_late_by_tier(s.fact, s.dim_customer)


@query("receipts_by_method")
def q_receipts_by_method(spark, sf_dir):
    s = _star(spark, sf_dir)
    return M.receipts_by_method(s.fact, s.dim_payment_method)


@query("cash_milestones")
def q_cash_milestones(spark, sf_dir):
    return M.cash_milestones(_shared(spark, sf_dir).forecast_weekly)


@query("stress_forecast")
def q_stress_forecast(spark, sf_dir):
    return _shared(spark, sf_dir).stress_forecast()


@query("invoiced_by_month")
def q_invoiced_by_month(spark, sf_dir):
    return M.invoiced_by_month(_star(spark, sf_dir).fact)


# ---- 2.1 sinks (registered last: they reuse the star) -----------------------------------

@query("validation_report")
def q_validation_report(spark, sf_dir):
    from arcash.plans.report import validation_report
    return validation_report(star_for(spark, sf_dir, materialize=True, review=True))


@query("publish_star")
def q_publish_star(spark, sf_dir):
    """Export the 8 tables with a pointer switch, then read the published run back."""
    from arcash.plans.publish import publish, read_published
    s = _shared(spark, sf_dir)
    tables = s.tables()
    base = f"{s.folder.root}/published"
    publish(spark, tables, base, "r1")
    out = None
    for name, df in read_published(spark, base).items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def queries() -> Dict[str, Query]:
    return dict(REGISTRY)
