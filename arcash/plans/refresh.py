"""The full refresh job: clean -> gates -> forecast -> calendar -> integrity -> compare ->
publish -> report. Every gate is evaluated before anything is published.

It runs on a materialised ``Star``: what several branches read is written once as parquet
under the shared ``spark.checkpoint.dir`` and read back, so a lost executor recomputes only
from there; the folder is deleted at the end. When a gate stops the run, the review sets
that show the rows to mend are written first, under ``<base>/_stopped/run_id=<id>``.
"""

from __future__ import annotations

import datetime as dt
import json
from typing import Dict, NamedTuple

from pyspark.sql import DataFrame, SparkSession

from arcash import config as C
from arcash.operators import legacy as L
from arcash.operators import quality as Q
from arcash.operators.calendar import dim_date_fiscal
from arcash.plans import publish as P
from arcash.plans.report import validation_report
from arcash.plans.star import Star
from arcash.session import RunFolder
from arcash.sources.derived import RawInputs


class GateError(ValueError):
    """A hard data-quality gate failed; nothing was published. ``review_dir`` holds the rows."""

    def __init__(self, message: str, review_dir: str):
        super().__init__(f"{message} (rows in {review_dir})")
        self.review_dir = review_dir


class RefreshResult(NamedTuple):
    run_dir: str
    tables: Dict[str, DataFrame]
    review: Dict[str, DataFrame]
    report: dict


def _stop(base: str, run_id: str, message: str, review: Dict[str, DataFrame]) -> None:
    out = f"{base}/_stopped/run_id={run_id}"
    P.write_review(review, out)
    raise GateError(message, out)


def check_gates(star: Star, base: str, run_id: str) -> dict:
    """Conflicting copies, then orphans, then GST (judged over rows whose customer exists)."""
    fc, cfg = star.fact_clean, star.cfg
    fc.routed                                # writes the stage, which counts the gates' rows
    seen = star.figures("fact_routed")
    conflicts = seen["conflicting_ids"]
    if conflicts:
        _stop(base, run_id, f"copies of {conflicts} invoice ids disagree",
              {"duplicate_invoice": fc.duplicates, "duplicate_invoice_conflicts": fc.conflicts})
    n = {"orphan_rows": seen["orphans"], "bad_gst_rows": seen["known_bad_gst"],
         "conflicting_duplicate_ids": conflicts}
    if n["orphan_rows"] and not cfg.allow_drop_orphans:
        _stop(base, run_id, f"{n['orphan_rows']} invoices name no known customer; allow_drop_orphans sets them aside",
              {"duplicate_invoice": fc.duplicates, "orphan_fact": star.gated.orphans})
    if n["bad_gst_rows"] and not cfg.allow_drop_bad_gst:
        _stop(base, run_id, f"the GST of {n['bad_gst_rows']} invoices is off; allow_drop_bad_gst sets them aside",
              {"duplicate_invoice": fc.duplicates, "gst_fact": star.gated.known_bad_gst})
    return n


def run_refresh(spark: SparkSession, inputs: RawInputs, base: str, cfg: C.RunConfig = C.DEFAULT,
                run_id: str = None, fmt: str = "parquet") -> RefreshResult:
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    started = P.current_version(spark, base)
    star = Star(inputs, cfg, materialize=True, review=True)
    try:
        gates = check_gates(star, base, run_id)
        fc, cust = star.fact_clean, star.customers
        tables = star.tables()          # materialises fact, lags, forecast, dimensions, calendar
        bad = [r for r in Q.referential_integrity(tables).collect() if r["violations"]]
        if bad:
            _stop(base, run_id, "keys without a parent: " + ", ".join(
                f"{r['violations']} of {r['relation']}" for r in bad), {"duplicate_invoice": fc.duplicates})
        review = {"duplicate_customer": cust.duplicates, "duplicate_invoice": fc.duplicates,
                  "unusable_customer_id": cust.unusable_ids, "unusable_invoice_id": fc.unusable_ids,
                  "invalid_amount": fc.invalid_amounts, "invalid_dates": fc.invalid_dates,
                  "orphan_fact": star.gated.orphans, "gst_fact": star.gated.bad_gst,
                  "customer_name": cust.name_warnings, "tier_limit_mismatch": cust.tier_mismatch,
                  "large_invoice_amount": fc.outliers, "status_corrected": fc.status_corrections,
                  "unknown_mapping": Q.unknown_mappings(star.dim_customer, tables["FactInvoice"])}
        figures = validation_report(star).first().asDict()
        if figures["reconciliation_status"] != "PASS":
            _stop(base, run_id, "the forecast by invoice and by week differ by "
                  f"{figures['reconciliation_difference']}", {"duplicate_invoice": fc.duplicates})

        report = {"status": "PASS", "run_id": run_id, "snapshot": cfg.snapshot, "gates": gates, "figures": figures,
                  "compare_with_previous": [], "review_sets": sorted(review)}
        run_dir = P.publish(spark, tables, base, run_id, review=review, report=report, fmt=fmt,
                            based_on=started)
    finally:
        star.close()
    return RefreshResult(run_dir, P.read_published(spark, base, run_id),
                         {n: spark.read.parquet(f"{run_dir}/_review/{n}") for n in review}, report)


LEGACY_TABLES = ("DimCustomer", "DimCategory", "DimPaymentMethod", "DimInvoiceStatus", "DimDate", "FactInvoice")


def legacy_tables(inputs: RawInputs, folder: RunFolder, cfg: C.RunConfig = C.LEGACY) -> Dict[str, DataFrame]:
    """The six tables of the older job, and the ``_orphans`` it leaves out, each written once."""
    customers = folder.cut(L.legacy_customers(inputs.customer, cfg), "customers")
    rows = folder.cut(L.legacy_fact(inputs.fact, customers, cfg), "fact")
    fact = rows.where("_known").drop("_known")
    days = dim_date_fiscal([(fact, ["issue_date", "due_date", "payment_date"])])
    return {"DimCustomer": customers, "DimCategory": folder.cut(L.legacy_category(inputs.category), "category"),
            "DimPaymentMethod": folder.cut(L.legacy_method(inputs.method), "method"),
            "DimInvoiceStatus": folder.cut(L.legacy_status(inputs.status), "status"),
            "DimDate": folder.cut(days, "days"), "FactInvoice": fact, "_orphans": rows.where("not _known").drop("_known")}


def run_legacy_export(spark: SparkSession, inputs: RawInputs, base: str, run_id: str = "legacy",
                      cfg: C.RunConfig = C.LEGACY, fmt: str = "csv") -> str:
    """The older clean-only job: clean, check every row (integrity, GST, period), then export the
    six tables. The report is written either way; if a check fails nothing else is."""
    started = P.current_version(spark, base)
    folder = RunFolder(spark, "legacy")
    try:
        tables = legacy_tables(inputs, folder, cfg)
        orphans = tables.pop("_orphans")
        checks = L.legacy_checks(tables, cfg).first().asDict()
        errors = L.failures(checks)
        report = {**checks, "status": "FAIL" if errors else "PASS", "errors": errors}
        if errors:
            P.write_text(spark, f"{base}/_stopped/run_id={run_id}/_validation_report.json",
                         json.dumps(report, indent=2, default=str))
            _stop(base, run_id, "validation failed: " + "; ".join(errors), {"orphan_fact": orphans})
        report["outputs"] = list(LEGACY_TABLES)
        return P.publish(spark, {n: tables[n] for n in LEGACY_TABLES}, base, run_id,
                         review={"orphan_fact": orphans}, report=report, fmt=fmt, based_on=started)
    finally:
        folder.delete()
