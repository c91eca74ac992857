"""FactInvoice clean: a composition of the scalar rules, in the order that matters.

Order (each step sees only rows that survived the previous set-aside):
ids -> duplicate listing / conflict gate -> first-wins dedup -> numbers -> invalid amounts
set aside -> p99 outlier warning (rows kept) -> date parse + day/month repair -> blank
status fill + canon -> category / method canon -> GST split -> due date repair ->
invalid dates set aside -> payment normalisation + status derivation (corrections warned).
"""

from __future__ import annotations

from functools import cached_property
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import (canon, canon_known, canon_or_null, is_blank, iso,
                              repair_issue_date, repair_payment_date, round_money, strip,
                              swap_unconditional, to_int_id, to_number)
from arcash.functions.dates import parse_date_sql, staged
from arcash.operators.dedup import COPIES, DIFFERS, all_copies, conflicting_keys, keyed_rows
from arcash.operators.quality import gst_off_rule
from arcash.operators.stats import exact_percentile
from arcash.schemas import RAW_COLUMNS
from arcash.sources.raw import SEQ

FACT_COLUMNS = ("invoice_id", "customer_id", "category", "payment_method", "status",
                "issue_date", "due_date", "payment_date",
                "amount_excl_gst", "gst", "amount_incl_gst", "amount_paid")
MONEY_RAW = ("amount_excl_gst", "gst", "amount_incl_gst", "amount_paid")


#: The rules that take a row out of the fact, in the order they are judged, and the fact itself.
RULES = ("invalid_amount", "invalid_dates", "orphan_fact", "gst_fact", "fact")


class FactClean:
    """Outputs of the fact clean: lazy DataFrames, each built when it is first asked for.

    ``cut(df, name, **how)`` may write the shared stage, the typed and dated rows each tagged
    with the rule that takes it out (``routed``), the first time an output needs it, in one
    folder a rule: a caller that asks for many outputs computes the clean once and reads only
    the folders it wants, and one that asks for a few never pays for the rest. ``p99`` runs a
    few small jobs on first access (large amounts are warned about only). ``rows`` may give the
    ``parsed_dates`` of the ``first_rows``, which no setting of a run changes.
    """

    def __init__(self, raw: DataFrame, customers: DataFrame, cfg: C.RunConfig = C.DEFAULT,
                 p99: Optional[float] = None, cut=None, rows: DataFrame = None):
        self.raw_rows, self._customers, self._cfg = raw, customers, cfg
        self._cut, self._given_rows = cut, rows
        self._given_p99 = p99
        self._ids = with_fact_ids(raw)

    # ---- ids and duplicates -----------------------------------------------------------
    @cached_property
    def unusable_ids(self) -> DataFrame:
        """Rows without an invoice id, or with one that does not fit, as raw text."""
        return self.raw_rows.filter(to_int_id("invoice_id").isNull()).drop(SEQ)

    @cached_property
    def duplicates(self) -> DataFrame:
        """Every copy of a repeated invoice_id."""
        return all_copies(self._ids, "invoice_id").drop(SEQ)

    @cached_property
    def conflicts(self) -> DataFrame:
        """Ids whose copies differ (gate)."""
        compare = [c for c in RAW_COLUMNS["FactInvoice"] if c != "invoice_id"]
        return conflicting_keys(self._ids, "invoice_id", compare)

    # ---- amounts ----------------------------------------------------------------------
    @cached_property
    def _typed(self) -> DataFrame:
        return first_rows(self.raw_rows) if self._given_rows is None else self._given_rows.drop(*PARSED)

    @cached_property
    def _parsed(self) -> DataFrame:
        return self._typed if self._given_rows is None else self._given_rows

    def _rows(self, rule: str) -> DataFrame:
        """The rows that one rule takes out, from the written stage."""
        return self.routed.filter(F.col("rule") == rule)

    @cached_property
    def invalid_amounts(self) -> DataFrame:
        """Set aside, with the amounts as parsed."""
        rows = self._typed.filter(invalid_amount(self._cfg)) if self._cut is None else self._rows("invalid_amount")
        return rows.select("customer_id", *[c for c in self._typed.columns if c not in ("customer_id", COPIES, DIFFERS)])

    @cached_property
    def valid_amounts(self) -> DataFrame:
        """Rows the p99 is taken over."""
        rows = self._typed.filter(~invalid_amount(self._cfg)) if self._cut is None \
            else self.routed.filter(F.col("rule") != "invalid_amount")
        return rows.select([c for c in self._typed.columns if c not in (COPIES, DIFFERS)])

    @cached_property
    def p99(self) -> Optional[float]:
        if self._given_p99 is not None:
            return self._given_p99
        return exact_percentile(self.valid_amounts, "amount_incl_gst", self._cfg.outlier_p, written=self._cut is not None)

    @cached_property
    def outliers(self) -> DataFrame:
        """Rows above ``outlier_factor`` x p99, with the p99 and threshold (2 dp)."""
        p99 = self.p99
        threshold = None if p99 is None else self._cfg.outlier_factor * p99
        value = lambda x: F.lit(x).cast("double")
        return (self.valid_amounts.filter(F.coalesce(F.col("amount_incl_gst") > value(threshold), F.lit(False)))
                .withColumn("p99_amount_incl_gst", F.round(value(p99), 2))
                .withColumn("outlier_threshold", F.round(value(threshold), 2)))

    # ---- dates, status, GST, due date ---------------------------------------------------
    @cached_property
    def routed(self) -> DataFrame:
        """Every first row, typed and dated, with the ``rule`` that takes it out of the fact."""
        rows = settled_rows(dated_rows(self._parsed, self._customers, self._cfg), self._cfg)
        rule = F.when(invalid_amount(self._cfg), RULES[0]).when(bad_dates(self._cfg), RULES[1]) \
            .when(~F.col("_known"), RULES[2]).when(gst_off_rule(self._cfg), RULES[3]).otherwise(RULES[4])
        if self._cut is None:
            return rows.withColumn("rule", rule)
        return self._cut(rows.withColumn("rule", rule), "fact_routed", partition_by="rule",
                         observe=routed_figures(self._cfg))

    @cached_property
    def _dated(self) -> DataFrame:
        if self._cut is None:
            return dated_rows(self._parsed.filter(~invalid_amount(self._cfg)), self._customers, self._cfg)
        return self.routed.filter(F.col("rule") != "invalid_amount")

    @cached_property
    def due_repair(self) -> DataFrame:
        """The due-date decision per dated row."""
        return self._dated.select(
            "invoice_id", "customer_id", F.col("_due_raw").alias("raw_due_date"),
            F.col("_issue").alias("issue_date"), terms_days(self._cfg).alias("terms_days"),
            F.col("_due").alias("due_date"), F.col("_recalc").alias("recomputed"))

    @cached_property
    def _kept(self) -> DataFrame:
        if self._cut is None:
            return settled_rows(self._dated.filter(~bad_dates(self._cfg)), self._cfg)
        return self.routed.filter(F.col("rule").isin(*RULES[2:]))

    @cached_property
    def invalid_dates(self) -> DataFrame:
        """Set aside."""
        rows = self._dated.filter(bad_dates(self._cfg)) if self._cut is None else self._rows("invalid_dates")
        return (rows.withColumn("parsed_issue_date", iso("_issue"))
                .withColumn("parsed_due_date", iso("_due"))
                .withColumn("parsed_payment_date", iso("_pay")).drop(COPIES, DIFFERS))

    @cached_property
    def status_corrections(self) -> DataFrame:
        """Warned: the stated status differs from the derived one."""
        return (self._kept.filter(F.col("_status_canon") != F.col("_derived"))
                .select("invoice_id", "customer_id", F.col("_status_canon").alias("status"),
                        "payment_method", "issue_date", "due_date", "payment_date",
                        "amount_incl_gst", F.col("_paid").alias("amount_paid"),
                        F.col("_status_canon").alias("original_status"),
                        F.col("_derived").alias("corrected_status")))

    @cached_property
    def status_derivation(self) -> DataFrame:
        """Stated (canonical) and derived status per kept row."""
        return self._kept.select("invoice_id", F.col("_status_canon").alias("original_status"),
                                 F.col("_derived").alias("status"))

    @cached_property
    def clean(self) -> DataFrame:
        """FactInvoice, before the gates."""
        return published_rows(self._kept)

    @cached_property
    def gated(self) -> Gated:
        return Gated(self)


class Gated:
    """The gates: rows without a known customer, then rows whose GST is off. A gate takes its
    rows out of the fact if the run allows it; the rows it judges are listed either way."""

    def __init__(self, clean: FactClean):
        self._clean, self._cfg = clean, clean._cfg

    def _rows(self, *rules: str) -> DataFrame:
        """Kept rows; of a written stage only the folders of ``rules``."""
        kept = self._clean._kept
        return kept if self._clean._cut is None else kept.filter(F.col("rule").isin(*rules))

    def _judged(self) -> Column:
        return F.col("_known") if self._cfg.allow_drop_orphans else F.lit(True)

    @cached_property
    def fact(self) -> DataFrame:
        """The fact after the gates."""
        out = {r for r, drop in (("orphan_fact", self._cfg.allow_drop_orphans), ("gst_fact", self._cfg.allow_drop_bad_gst)) if drop}
        stays = self._judged() & ~gst_off_rule(self._cfg) if self._cfg.allow_drop_bad_gst else self._judged()
        return published_rows(self._rows(*[r for r in RULES[2:] if r not in out]).filter(stays))

    @cached_property
    def orphans(self) -> DataFrame:
        """Rows whose customer is absent or null."""
        return published_rows(self._rows("orphan_fact").filter(~F.col("_known")))

    @cached_property
    def bad_gst(self) -> DataFrame:
        """Rows whose GST is neither 0 nor about a divisor-th of the total."""
        return published_rows(self._rows("orphan_fact", "gst_fact").filter(self._judged() & gst_off_rule(self._cfg)))

    @cached_property
    def known_bad_gst(self) -> DataFrame:
        """Such rows of known customers only."""
        return published_rows(self._rows("gst_fact").filter(F.col("_known") & gst_off_rule(self._cfg)))


def published_rows(kept: DataFrame) -> DataFrame:
    """The columns of FactInvoice."""
    incl, is_paid = F.col("amount_incl_gst"), F.col("_derived") == "Paid"
    paid_final = F.when(is_paid, F.when(F.col("_paid").isNull() | (F.col("_paid") <= 0), incl)
                        .otherwise(F.col("_paid"))).otherwise(F.lit(0))
    return kept.select(
        F.col("invoice_id").cast("bigint").alias("invoice_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "category", "payment_method", F.col("_derived").alias("status"),
        F.col("_issue").alias("issue_date"), F.col("_due").alias("due_date"),
        F.when(is_paid, F.col("_pay")).alias("payment_date"),
        F.col("amount_excl_gst").alias("amount_excl_gst"),
        F.col("gst").alias("gst"),
        round_money(incl).alias("amount_incl_gst"),
        round_money(paid_final).alias("amount_paid"))


def routed_figures(cfg: C.RunConfig) -> dict:
    """Figures of the routed rows, counted while they are written."""
    rule = F.col("rule")
    dated, kept = rule != "invalid_amount", rule.isin(*RULES[2:])
    repeated = F.col(COPIES) > 1
    return {
        "duplicate_rows": F.coalesce(F.sum(F.when(repeated, F.col(COPIES))), F.lit(0)),
        "duplicate_ids": F.count_if(repeated), "conflicting_ids": F.count_if(DIFFERS),
        "invalid_amounts": F.count_if(~dated), "invalid_dates": F.count_if(rule == "invalid_dates"),
        "due_kept": F.count_if(dated & ~F.col("_recalc")), "due_recomputed": F.count_if(dated & F.col("_recalc")),
        "status_corrected": F.count_if(kept & (F.col("_status_canon") != F.col("_derived"))),
        "orphans": F.count_if(kept & ~F.col("_known")),
        "bad_gst": F.count_if(kept & (F.col("_known") if cfg.allow_drop_orphans else F.lit(True)) & gst_off_rule(cfg)),
        "known_bad_gst": F.count_if(kept & F.col("_known") & gst_off_rule(cfg)),
    }


def with_fact_ids(raw: DataFrame) -> DataFrame:
    """Digits-only ids; rows without an invoice id are left out. The ids are staged, so a join on
    them stays above the export it reads."""
    return staged(raw, invoice_id=to_int_id("invoice_id"), customer_id=to_int_id("customer_id")) \
        .filter(F.col("invoice_id").isNotNull())


def first_rows(raw: DataFrame) -> DataFrame:
    """The first row of every invoice id, with its amounts as numbers."""
    return parse_amounts(keyed_rows(with_fact_ids(raw), "invoice_id").drop(SEQ))


PARSED = ("_issue_p", "_pay_p", "_due_raw")


def parsed_dates(rows: DataFrame) -> DataFrame:
    """The three dates as parsed, beside their texts."""
    texts = rows.withColumns({f"_{c}": strip(c) for c in ("issue_date", "payment_date", "due_date")})
    return staged(texts, _issue_p=parse_date_sql("_issue_date"), _pay_p=parse_date_sql("_payment_date"),
                  _due_raw=parse_date_sql("_due_date")).drop("_issue_date", "_payment_date", "_due_date")


def parse_amounts(df: DataFrame) -> DataFrame:
    return staged(df, **{c: to_number(c) for c in MONEY_RAW})


def invalid_amount(cfg: C.RunConfig) -> Column:
    incl, paid = F.col("amount_incl_gst"), F.col("amount_paid")
    tol = F.lit(cfg.money_tol).cast("decimal(26,6)")
    return incl.isNull() | (incl <= 0) | (paid.isNotNull() & (paid > incl + tol))


def fill_status(status: Column, pay: Column, paid: Column, due_raw: Column, snap: Column) -> Column:
    """Blank status from the evidence: paid, overdue at snapshot, else open."""
    derived = (F.when(pay.isNotNull() | (F.coalesce(paid, F.lit(0)) > 0), F.lit("Paid"))
               .when(due_raw.isNotNull() & (due_raw < snap), F.lit("Overdue"))
               .otherwise(F.lit("Open")))
    return F.when(is_blank(status), derived).otherwise(status)


def gst_split(df: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """Source GST kept (blank -> 0, GST-free), excl = incl - gst. Legacy: gst = incl/11."""
    if cfg.recompute_gst:
        gst = round_money(F.col("amount_incl_gst") / F.lit(cfg.gst_divisor))
    else:
        gst = round_money(F.coalesce(F.col("gst"), F.lit(0)))
    return (df.withColumn("gst", gst)
            .withColumn("amount_excl_gst", round_money(F.col("amount_incl_gst") - F.col("gst"))))


def terms_days(cfg: C.RunConfig) -> Column:
    return F.coalesce(F.col("_terms"), F.lit(cfg.default_terms_days))


def dated_rows(valid: DataFrame, customers: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """Parsed and repaired dates, canonical names and status, GST, and the due date."""
    snap = F.lit(cfg.snapshot).cast("date")
    start, end = F.lit(cfg.period_start).cast("date"), F.lit(cfg.period_end).cast("date")
    dated = valid if set(PARSED) <= set(valid.columns) else parsed_dates(valid)
    issue, pay = F.col("_issue_p"), F.col("_pay_p")
    if cfg.swap_dates_always:   # legacy: swapped whether or not the result lies in the window
        issue = F.when(issue.between(start, end), issue).otherwise(swap_unconditional(issue))
        pay = F.when(pay > snap, swap_unconditional(pay)).otherwise(pay)
    else:
        issue, pay = repair_issue_date(issue, cfg), repair_payment_date(pay, cfg)
    dated = staged(dated, _issue=issue, _pay=pay,
                   category=canon_known("category", C.CATEGORY_CANON, list(C.REVENUE_GROUP)),
                   payment_method=canon_or_null("payment_method", C.METHOD_CANON)).drop("_issue_p", "_pay_p")
    dated = dated.withColumn("_status_filled", fill_status(
        F.col("status"), F.col("_pay"), F.col("amount_paid"), F.col("_due_raw"), snap))
    dated = staged(dated, _status_canon=canon("_status_filled", C.STATUS_CANON, missing="Open")).drop("_status_filled")
    dated = gst_split(dated, cfg)

    # Due date: keep the raw one unless blank / unparseable / before issue; then issue +
    # the customer's terms (default 14). The same join tells whether the customer is known, which
    # the orphan gate asks later. Customers are unique per id, so the left join
    # never multiplies rows; AQE turns it into a broadcast when the customer side is small.
    terms = customers.select("customer_id", F.col("payment_terms_days").alias("_terms"), F.lit(True).alias("_found"))
    dated = dated.join(terms, on="customer_id", how="left") \
        .withColumn("_known", F.coalesce("_found", F.lit(False))).drop("_found")
    need_recalc = F.col("_due_raw").isNull() | (F.col("_issue").isNotNull() & (F.col("_due_raw") < F.col("_issue")))
    if cfg.due_from_terms_always:
        need_recalc = F.lit(True)
    due = F.when(need_recalc, F.date_add(F.col("_issue"), terms_days(cfg))).otherwise(F.col("_due_raw"))
    return dated.withColumns({"_recalc": need_recalc, "_due": due})


def bad_dates(cfg: C.RunConfig) -> Column:
    """No issue date, one outside the period (unless a later gate judges that), no due date,
    or a due or payment date before issue."""
    start, end = F.lit(cfg.period_start).cast("date"), F.lit(cfg.period_end).cast("date")
    i, d, p = F.col("_issue"), F.col("_due"), F.col("_pay")
    bad = i.isNull() | ~i.between(start, end) | d.isNull() | (d < i) | (p.isNotNull() & (p < i))
    return F.coalesce(bad, F.lit(True))


def settled_rows(kept: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """The paid amount and the derived status."""
    snap = F.lit(cfg.snapshot).cast("date")
    paid_raw, incl, p, d = F.col("amount_paid"), F.col("amount_incl_gst"), F.col("_pay"), F.col("_due")
    kept = kept.withColumn(
        "_paid", F.when(p.isNotNull() & (paid_raw.isNull() | (paid_raw <= 0)), incl).otherwise(paid_raw))
    derived = (F.when(p.isNotNull() & (F.coalesce(F.col("_paid"), F.lit(0)) > 0), F.lit("Paid"))
               .when(d < snap, F.lit("Overdue")).otherwise(F.lit("Open")))
    return kept.withColumn("_derived", derived)


def clean_fact(raw: DataFrame, customers: DataFrame, cfg: C.RunConfig = C.DEFAULT,
               p99: Optional[float] = None, cut=None, rows: DataFrame = None) -> FactClean:
    """Clean the raw fact against the cleaned customers (for payment terms). Nothing runs and
    nothing is written until an output is asked for; ``p99`` may be given from another run,
    and so may the parsed first rows."""
    return FactClean(raw, customers, cfg, p99, cut, rows)
