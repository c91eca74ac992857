"""Data-quality gates, review sets and rule reports over the cleaned star.

Gates return violation DataFrames; only the job runner (``plans.refresh``) raises.
Every multi-rule report is a single aggregation (one scan) or a union of a few, so one
action evaluates all rules.
"""

from __future__ import annotations

from typing import Dict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcash import config as C


def orphan_facts(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Fact rows without a customer. A null customer_id never matches, so it is kept."""
    return fact.join(customers.select("customer_id"), on="customer_id", how="left_anti")


def gst_off_rule(cfg: C.RunConfig) -> Column:
    """GST present and off incl/11 by more than the tolerance, in exact decimals:
    |gst - incl/11| > tol  <=>  |11*gst - incl| > 11*tol."""
    gst, incl = F.col("gst"), F.col("amount_incl_gst")
    tol = F.lit(cfg.gst_rule_tol).cast("decimal(10,4)") * F.lit(cfg.gst_divisor)
    return (gst != 0) & (F.abs(gst * F.lit(cfg.gst_divisor) - incl) > tol)


def unknown_mappings(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Long form (table, row_id, warning_field, warning_value) of values mapped to Unknown."""
    def part(df, table, key, field):
        return df.filter(F.col(field) == "Unknown").select(
            F.lit(table).alias("table"), F.col(key).cast("bigint").alias("row_id"),
            F.lit(field).alias("warning_field"), F.col(field).alias("warning_value"))
    return (part(customers, "DimCustomer", "customer_id", "industry")
            .unionByName(part(fact, "FactInvoice", "invoice_id", "category"))
            .unionByName(part(fact, "FactInvoice", "invoice_id", "payment_method")))


def quality_report(fact: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """One row: rows, GST ok (0 or ~incl/11), GST-free, total ok, due >= issue, issue
    dates outside the period."""
    incl, gst, excl = F.col("amount_incl_gst"), F.col("gst"), F.col("amount_excl_gst")
    tol = F.lit(cfg.money_tol).cast("decimal(10,4)")
    return fact.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((gst == 0) | ~gst_off_rule(cfg)).alias("gst_ok"),
        F.count_if(gst == 0).alias("gst_free"),
        F.count_if(F.abs(incl - (excl + gst)) <= tol).alias("total_ok"),
        F.count_if(F.col("due_date") >= F.col("issue_date")).alias("due_ok"),
        F.count_if(~F.col("issue_date").between(F.lit(cfg.period_start).cast("date"),
                                                F.lit(cfg.period_end).cast("date"))).alias("issue_outside_period"))


_RELATIONS = (  # child table, column, parent table, parent column, nulls exempt
    ("FactInvoice", "customer_id", "DimCustomer", "customer_id", False),
    ("FactInvoice", "category", "DimCategory", "category", False),
    ("FactInvoice", "status", "DimInvoiceStatus", "status", False),
    ("FactInvoice", "payment_method", "DimPaymentMethod", "payment_method", True),
    ("FactInvoice", "issue_date", "DimDate", "date", True),
    ("FactInvoice", "due_date", "DimDate", "date", True),
    ("FactInvoice", "payment_date", "DimDate", "date", True),
    ("forecast_by_invoice", "customer_id", "DimCustomer", "customer_id", False),
    ("forecast_by_invoice", "status", "DimInvoiceStatus", "status", False),
    ("forecast_by_invoice", "expected_collection", "DimDate", "date", False),
)


def stacked_keys(df: DataFrame, columns: Dict[str, str]) -> DataFrame:
    """(relation, k): the named columns of every row as text keys, one row each."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(r).alias("relation"), F.col(c).cast("string").alias("k"))
                                        for r, c in columns.items()])))


def referential_integrity(t: Dict[str, DataFrame]) -> DataFrame:
    """Violations per relation (10 relations); all zero means the star is consistent.

    Each child is read once: its key columns are stacked and reduced to one row per relation and
    distinct key before the shuffle (a hot category or date never reaches the join as raw rows),
    and one anti join against the stacked parent keys leaves the keys without a parent. Null
    payment method and null dates are exempt; a null customer, category or status counts as a
    violation (null never matches).
    """
    names = [f"{child}.{col} -> {parent}" for child, col, parent, _, _ in _RELATIONS]
    keys = parents = None
    for child in dict.fromkeys(r[0] for r in _RELATIONS):
        part = stacked_keys(t[child], {n: r[1] for n, r in zip(names, _RELATIONS) if r[0] == child})
        keys = part if keys is None else keys.unionByName(part)
    for parent, pcol in dict.fromkeys((r[2], r[3]) for r in _RELATIONS):
        to = [n for n, r in zip(names, _RELATIONS) if r[2:4] == (parent, pcol)]
        part = stacked_keys(t[parent], {n: pcol for n in to})
        parents = part if parents is None else parents.unionByName(part)
    exempt = [n for n, r in zip(names, _RELATIONS) if r[4]]
    missing = (keys.where(~F.col("relation").isin(*exempt) | F.col("k").isNotNull())
               .groupBy("relation", "k").agg(F.count(F.lit(1)).alias("n"))
               .join(parents, on=["relation", "k"], how="left_anti"))
    row = missing.agg(*[F.coalesce(F.sum(F.when(F.col("relation") == n, F.col("n"))), F.lit(0)).cast("bigint").alias(f"r{i}")
                        for i, n in enumerate(names)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("relation"), F.col(f"r{i}").alias("violations"))
                                         for i, n in enumerate(names)])))


# ---- declared constraints (the DDL's checks, uniqueness and not-null rules) ----------

def _checks(table: str, df: DataFrame, rules: Dict[str, Column]) -> DataFrame:
    """A CHECK fails only when its expression is false (null passes, as in SQL)."""
    aggs = [F.count_if(F.coalesce(~expr, F.lit(False))).alias(f"c{i}") for i, expr in enumerate(rules.values())]
    row = df.agg(*aggs)
    stacked = F.inline(F.array(*[F.struct(F.lit(name).alias("constraint_name"),
                                          F.col(f"c{i}").alias("violations"))
                                 for i, name in enumerate(rules)]))
    return row.select(F.lit(table).alias("table_name"), stacked)


def _unique(table: str, df: DataFrame, key: str) -> DataFrame:
    """Number of key values held by more than one row (null keys ignored)."""
    dup = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    return dup.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(f"unique_{key}").alias("constraint_name"), "violations")


# FIXED VALUES: the constraint names below are those of the declared tables.
def constraint_violations(t: Dict[str, DataFrame], cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    c = F.col
    nn = lambda col: c(col).isNotNull()
    rules = {
        "DimCustomer": {
            "nn_customer_id": nn("customer_id"), "nn_customer_name": nn("customer_name"),
            "nn_industry": nn("industry"), "nn_member_tier": nn("member_tier"),
            "ck_member_tier": c("member_tier").isin(*C.VALID_TIERS),
            "nn_payment_terms_days": nn("payment_terms_days"),
            "ck_payment_terms_days": c("payment_terms_days").isin(*C.VALID_TERMS),
            "nn_credit_limit": nn("credit_limit"), "ck_credit_limit": c("credit_limit") > 0,
        },
        "DimCategory": {"nn_category_id": nn("category_id"), "nn_category": nn("category"),
                        "nn_revenue_group": nn("revenue_group")},
        "DimPaymentMethod": {"nn_method_id": nn("method_id"), "nn_payment_method": nn("payment_method"),
                             "nn_method_type": nn("method_type")},
        "DimInvoiceStatus": {"nn_status_id": nn("status_id"), "nn_status": nn("status"),
                             "ck_status": c("status").isin(*C.VALID_STATUS)},
        "DimDate": {"nn_date_key": nn("date_key"), "nn_date": nn("date"),
                    "nn_year": nn("year"), "nn_quarter": nn("quarter"), "nn_month_no": nn("month_no"),
                    "nn_month_name": nn("month_name"), "ck_month_no": c("month_no").between(1, 12)},
        "FactInvoice": {
            "nn_invoice_id": nn("invoice_id"), "nn_customer_id": nn("customer_id"),
            "nn_category": nn("category"), "nn_status": nn("status"),
            "nn_issue_date": nn("issue_date"), "nn_due_date": nn("due_date"),
            "nn_amount_excl_gst": nn("amount_excl_gst"), "nn_gst": nn("gst"),
            "nn_amount_incl_gst": nn("amount_incl_gst"), "nn_amount_paid": nn("amount_paid"),
            "ck_amount_excl_gst": c("amount_excl_gst") >= 0, "ck_gst": c("gst") >= 0,
            "ck_amount_incl_gst": c("amount_incl_gst") >= 0,
            "ck_gst_rule": (c("gst") == 0) | ~gst_off_rule(cfg),
            "ck_incl_sum": F.abs(c("amount_incl_gst") - (c("amount_excl_gst") + c("gst"))) <= F.lit("0.02").cast("decimal(4,2)"),
            "ck_due_after_issue": c("due_date") >= c("issue_date"),
            "ck_payment_only_when_paid":
                ((c("status") == "Paid") & c("payment_date").isNotNull() & (c("amount_paid") > 0))
                | ((c("status") != "Paid") & c("payment_date").isNull() & (c("amount_paid") == 0)),
        },
        "forecast_by_invoice": {
            "nn_invoice_id": nn("invoice_id"), "nn_customer_id": nn("customer_id"),
            "nn_customer_name": nn("customer_name"), "nn_member_tier": nn("member_tier"),
            "nn_category": nn("category"), "nn_status": nn("status"),
            "nn_issue_date": nn("issue_date"), "nn_due_date": nn("due_date"),
            "nn_expected_collection": nn("expected_collection"),
            "nn_already_overdue": nn("already_overdue"),
            "nn_amount_incl_gst": nn("amount_incl_gst"),
            "ck_forecast_amount_positive": c("amount_incl_gst") >= 0,
        },
        "forecast_weekly": {
            **{f"nn_{x}": nn(x) for x in ("week_start", "n_invoices", "normal_flow", "overdue_backlog",
                                          "amount", "cumulative", "pct_of_book")},
            "ck_n_invoices": c("n_invoices") >= 0, "ck_normal_flow": c("normal_flow") >= 0,
            "ck_overdue_backlog": c("overdue_backlog") >= 0, "ck_amount": c("amount") >= 0,
            "ck_cumulative": c("cumulative") >= 0,
            "ck_pct_of_book": c("pct_of_book").between(0, 100),
        },
    }
    keys = {"DimCustomer": ["customer_id"], "DimCategory": ["category_id", "category"],
            "DimPaymentMethod": ["method_id", "payment_method"],
            "DimInvoiceStatus": ["status_id", "status"], "DimDate": ["date", "date_key"],
            "FactInvoice": ["invoice_id"], "forecast_by_invoice": ["invoice_id"],
            "forecast_weekly": ["week_start"]}
    out = None
    for table, r in rules.items():
        parts = [_checks(table, t[table], r)] + [_unique(table, t[table], k) for k in keys[table]]
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out
