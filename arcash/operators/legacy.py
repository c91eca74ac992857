"""The older clean-only job: its own rules, not the live clean with switches.

Whole rows that repeat are one; no row is set aside (rows without a known customer leave the
fact, nothing else does); invoice ids stay as written and customer ids become labels; a stated
status is only canonised; unmapped payment methods stay as text; GST is recomputed and the due
date is always issue + terms; a paid invoice is paid in full, whatever was paid. Dates are
tried in the main formats only, and a date outside its window swaps day and month whatever
that gives. The checks then judge every row, so bad rows stop the job instead of vanishing.

Null cells stay null (the source wrote some of them as the word ``nan``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import (canon, format_id, is_blank, lookup, normalise_state, round_money, strip,
                              swap_unconditional, to_number, to_terms)
from arcash.functions.dates import parse_date_sql, staged
from arcash.operators.dedup import first_per_key
from arcash.operators.fact import FACT_COLUMNS, MONEY_RAW, fill_status
from arcash.operators.quality import stacked_keys
from arcash.sources.raw import SEQ


def _dated(df: DataFrame, **columns: str) -> DataFrame:
    """Date columns parsed with the main formats only: ``new=old``."""
    texts = df.withColumns({f"_{new}_text": strip(old) for new, old in columns.items()})
    return staged(texts, **{new: parse_date_sql(f"_{new}_text", fallback=()) for new in columns}) \
        .drop(*[f"_{new}_text" for new in columns])


def legacy_customers(raw: DataFrame, cfg: C.RunConfig = C.LEGACY) -> DataFrame:
    """First row per customer label. Terms are kept as stated, whatever they are."""
    first = first_per_key(raw.withColumn("customer_id", format_id("customer_id")), "customer_id")
    typed = first.withColumns({"_credit": to_number("credit_limit"), "_terms": to_terms("payment_terms_days")})
    by_credit = lookup(C.CREDIT_LIMIT_TO_TIER, F.col("_credit").try_cast("bigint"))
    typed = typed.withColumn("member_tier", F.when(is_blank("member_tier"), by_credit)
                             .otherwise(canon("member_tier", C.TIER_CANON, missing=None)))
    return _dated(typed, _since="member_since").select(
        "customer_id", strip("customer_name").alias("customer_name"),
        canon("industry", cfg.industry_canon).alias("industry"), "member_tier",
        F.coalesce(F.col("_terms").try_cast("int"), lookup(C.TERMS_BY_TIER, "member_tier"),
                   F.lit(cfg.default_terms_days)).cast("int").alias("payment_terms_days"),
        F.col("_credit").try_cast("bigint").alias("credit_limit"), F.col("_since").alias("member_since"),
        normalise_state("state").alias("state"))


def legacy_fact(raw: DataFrame, customers: DataFrame, cfg: C.RunConfig = C.LEGACY) -> DataFrame:
    """The fact's columns and ``_known`` (the customer exists), one row per distinct raw row."""
    snap = F.lit(cfg.snapshot).cast("date")
    start, end = F.lit(cfg.period_start).cast("date"), F.lit(cfg.period_end).cast("date")
    rows = raw.drop(SEQ).dropDuplicates().withColumn("customer_id", format_id("customer_id"))
    rows = _dated(staged(rows, **{c: to_number(c) for c in MONEY_RAW}),
                  _issue="issue_date", _pay="payment_date", _due="due_date")
    incl, issue, pay = F.col("amount_incl_gst"), F.col("_issue"), F.col("_pay")
    rows = rows.withColumn("_stated", fill_status(F.col("status"), pay, F.col("amount_paid"), F.col("_due"), snap))
    rows = staged(rows, status=canon("_stated", C.STATUS_CANON, missing="Open"),
                  category=canon("category", C.CATEGORY_CANON),
                  payment_method=F.when(~is_blank("payment_method"), F.coalesce(
                      lookup(C.METHOD_CANON, F.lower(strip("payment_method"))), strip("payment_method"))),
                  issue_date=F.when(issue.between(start, end), issue).otherwise(swap_unconditional(issue)),
                  payment_date=F.when(pay > snap, swap_unconditional(pay)).otherwise(pay),
                  gst=round_money(incl / F.lit(cfg.gst_divisor)))
    terms = customers.select("customer_id", F.col("payment_terms_days").alias("_terms"), F.lit(True).alias("_found"))
    rows = rows.join(terms, "customer_id", "left")
    return rows.withColumns({
        "amount_excl_gst": round_money(incl - F.col("gst")),
        "due_date": F.date_add("issue_date", F.coalesce("_terms", F.lit(cfg.default_terms_days))),
        "amount_paid": round_money(F.when(F.col("status") == "Paid", incl).otherwise(F.lit(0)))}) \
        .select(*FACT_COLUMNS, F.coalesce("_found", F.lit(False)).alias("_known"))


def legacy_category(raw: DataFrame) -> DataFrame:
    """Distinct rows with canonical names, and the default member if no row has its name."""
    df = raw.drop(SEQ).dropDuplicates().withColumn("category", canon("category", C.CATEGORY_CANON))
    df = df.withColumn("revenue_group", F.when(is_blank("revenue_group"), lookup(C.REVENUE_GROUP, "category"))
                       .otherwise(F.col("revenue_group"))).select("category_id", "category", "revenue_group")
    member = df.sparkSession.range(1).select(F.lit("CAT00").alias("category_id"), F.lit("Unknown").alias("category"),
                                             F.lit("Unknown").alias("revenue_group"))
    return df.unionByName(member.join(df.where("category = 'Unknown'").select("category"), "category", "left_anti"))


def legacy_method(raw: DataFrame) -> DataFrame:
    df = raw.drop(SEQ).dropDuplicates().withColumn(
        "payment_method", F.coalesce(lookup(C.METHOD_CANON, F.lower(strip("payment_method"))), strip("payment_method")))
    return df.select("method_id", "payment_method", F.when(
        is_blank("method_type"), lookup(C.METHOD_TYPE, "payment_method")).otherwise(F.col("method_type")).alias("method_type"))


def legacy_status(raw: DataFrame) -> DataFrame:
    return raw.drop(SEQ).dropDuplicates().select("status_id", canon("status", C.STATUS_CANON).alias("status"), "description")


#: (check, fact column, table, key); a null method or date is no orphan.
RELATIONS = (("customer_orphans", "customer_id", "DimCustomer", "customer_id"),
             ("category_orphans", "category", "DimCategory", "category"),
             ("status_orphans", "status", "DimInvoiceStatus", "status"),
             ("method_orphans", "payment_method", "DimPaymentMethod", "payment_method"),
             ("issue_date_orphans", "issue_date", "DimDate", "date"),
             ("due_date_orphans", "due_date", "DimDate", "date"),
             ("payment_date_orphans", "payment_date", "DimDate", "date"))
NULLS_EXEMPT = ("method_orphans", "issue_date_orphans", "due_date_orphans", "payment_date_orphans")


def legacy_checks(t: dict, cfg: C.RunConfig = C.LEGACY) -> DataFrame:
    """One row over the six tables: seven orphan counts, GST rows that pass and rows, issue dates
    outside the period (a missing one counts), and three totals."""
    fact, incl = t["FactInvoice"], F.col("amount_incl_gst")
    keys = stacked_keys(fact, {check: col for check, col, _, _ in RELATIONS}) \
        .where(~F.col("relation").isin(*NULLS_EXEMPT) | F.col("k").isNotNull()) \
        .groupBy("relation", "k").agg(F.count(F.lit(1)).alias("n"))
    parents = None
    for check, _, table, key in RELATIONS:
        part = stacked_keys(t[table], {check: key}).distinct()
        parents = part if parents is None else parents.unionByName(part)
    lost = keys.join(parents, ["relation", "k"], "left_anti").agg(F.struct(*[
        F.coalesce(F.sum(F.when(F.col("relation") == check, F.col("n"))), F.lit(0)).alias(check)
        for check, *_ in RELATIONS]).alias("s")).scalar()

    def total(condition) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, incl)), F.lit(0)).cast("decimal(22,2)")
    paid = F.col("status") == "Paid"
    inside = F.col("issue_date").between(F.lit(cfg.period_start).cast("date"), F.lit(cfg.period_end).cast("date"))
    off = F.abs(F.col("gst") * F.lit(cfg.gst_divisor) - incl)
    near = off <= F.lit(cfg.gst_rule_tol).cast("decimal(10,4)") * F.lit(cfg.gst_divisor)
    return fact.agg(
        F.count_if(F.coalesce(near, F.lit(False))).alias("gst_pass"), F.count(F.lit(1)).alias("gst_rows"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("issue_outside_period"),
        total(F.lit(True)).alias("total_invoiced"), total(paid).alias("total_collected"), total(~paid).alias("open_ar")) \
        .withColumn("_lost", lost).select("_lost.*", "gst_pass", "gst_rows", "issue_outside_period",
                                          "total_invoiced", "total_collected", "open_ar")


def failures(checks: dict) -> list:
    """What stops the job, in words."""
    out = [f"{c}: {checks[c]}" for c, *_ in RELATIONS if checks[c]]
    if checks["gst_pass"] != checks["gst_rows"]:
        out.append(f"GST is off in {checks['gst_rows'] - checks['gst_pass']} rows")
    if checks["issue_outside_period"]:
        out.append(f"{checks['issue_outside_period']} issue dates outside the period")
    return out
