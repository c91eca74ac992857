"""One run of the receivables star, declared lazily.

``Star`` wires every operator together without running anything (except the
on-demand p99). Each attribute is a DataFrame whose plan Catalyst optimises as a whole
when it is finally written or collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash import config as C
from arcash.operators.calendar import dim_date, dim_date_fiscal
from arcash.operators.customers import clean_customers
from arcash.operators.dimensions import dim_category, dim_invoice_status, dim_payment_method
from arcash.operators.fact import clean_fact, first_rows, parsed_dates
from arcash.operators.forecast import (customer_lags, forecast_by_invoice, forecast_weekly,
                                       lag_statistics, lag_tables, stress_forecast)
from arcash.session import RunFolder
from arcash.sources.derived import RawInputs, load_inputs


def table_figures() -> dict:
    """What is counted of each table while it is written, beside its rows."""
    incl, unpaid, zero = F.col("amount_incl_gst"), F.col("status") != "Paid", F.lit(0).cast("decimal(18,2)")
    return {
        "dim_customer": {"unknown_industry": F.count_if(F.col("industry") == "Unknown")},
        "fact": {"total": F.coalesce(F.sum(incl), zero), "open_ar": F.coalesce(F.sum(F.when(unpaid, incl)), zero),
                 "unknown_category": F.count_if(F.col("category") == "Unknown"),
                 "unknown_method": F.count_if(F.col("payment_method") == "Unknown")},
        "forecast_by_invoice": {"total": F.coalesce(F.sum(incl), zero)},
        "forecast_weekly": {"total": F.coalesce(F.max_by("cumulative", "week_start"), zero)},
    }


class Star:
    """All tables and review sets of one run, lazy by default.

    With ``materialize`` the tables that several branches read (customers, the gated fact,
    lags, the forecast, the small dimensions) are written once to a run folder under
    ``spark.checkpoint.dir`` on first use and read back: the clean isn't repeated in every
    branch, plans stay small, and a lost executor recomputes from the last table only.
    With ``review`` the typed and dated invoices are written too, for jobs that list the
    review sets. ``close`` deletes the folder; else it goes when the process ends.
    """

    def __init__(self, inputs: RawInputs, cfg: C.RunConfig = C.FORECAST, materialize: bool = False,
                 review: bool = False):
        self.inputs, self.cfg, self.materialize, self.review = inputs, cfg, materialize, review
        self.folder = RunFolder(SparkSession.active(), "star")
        self.fact_rows = None

    def _cut(self, df: DataFrame, name: str, **how) -> DataFrame:
        if not self.materialize:
            return df
        figures = {"n": F.count(F.lit(1)), **table_figures().get(name, {}), **how.pop("observe", {})}
        return self.folder.cut(df, name, observe=figures, **how)

    def figures(self, name: str) -> dict:
        """The figures of a written table, counted while it was written."""
        return self.folder.figures[name]

    def close(self) -> None:
        self.folder.delete()

    # ---- cleaning ------------------------------------------------------------------
    @cached_property
    def customers(self):
        return clean_customers(self.inputs.customer, self.cfg)

    def share_rows(self, other: "Star") -> None:
        """Write the parsed first invoice rows once for this run and ``other``, a run over the same
        exports: they depend on no setting."""
        self.fact_rows = other.fact_rows = self.folder.cut(parsed_dates(first_rows(self.inputs.fact)), "fact_rows")

    @cached_property
    def fact_clean(self):
        return clean_fact(self.inputs.fact, self.dim_customer, self.cfg, cut=self._cut if self.review else None,
                          rows=self.fact_rows)

    @cached_property
    def gated(self):
        return self.fact_clean.gated

    # ---- the 8 published tables --------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._cut(self.customers.clean, 'dim_customer')

    @cached_property
    def dim_category(self) -> DataFrame:
        return self._cut(dim_category(self.inputs.category), 'dim_category')

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return self._cut(dim_payment_method(self.inputs.method), 'dim_payment_method')

    @cached_property
    def dim_invoice_status(self) -> DataFrame:
        return self._cut(dim_invoice_status(self.inputs.status), 'dim_invoice_status')

    @cached_property
    def fact(self) -> DataFrame:
        """FactInvoice as published: after the orphan / GST gates."""
        return self._cut(self.gated.fact, 'fact')

    @cached_property
    def lags(self):
        stats = self._cut(lag_statistics(self.fact, self.dim_customer, self.cfg), "lag_statistics")
        return lag_tables(stats)

    @cached_property
    def customer_lags(self) -> DataFrame:
        """One row per customer with the lag its invoices use. Always written, so that the
        invoices join one table on customer_id and a hot customer's side can be split."""
        return self.folder.cut(customer_lags(self.dim_customer, self.lags, self.cfg), "customer_lags")

    @cached_property
    def forecast_by_invoice(self) -> DataFrame:
        return self._cut(forecast_by_invoice(self.fact, self.customer_lags, self.lags, self.cfg), 'forecast_by_invoice')

    @cached_property
    def forecast_weekly(self) -> DataFrame:
        return self._cut(forecast_weekly(self.forecast_by_invoice), 'forecast_weekly')

    def _date_sources(self):
        return [(self.fact, ["issue_date", "due_date", "payment_date"]),
                (self.forecast_by_invoice, ["expected_collection"]),
                (self.forecast_weekly, ["week_start"])]

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every day from the earliest to the latest date used anywhere in the star."""
        return self._cut(dim_date(self._date_sources()), 'dim_date')

    def dim_date_fiscal(self) -> DataFrame:
        return dim_date_fiscal([(self.fact, ["issue_date", "due_date", "payment_date"])])

    def stress_forecast(self) -> DataFrame:
        return stress_forecast(self.fact, self.customer_lags, self.lags, self.cfg)

    def tables(self) -> dict:
        """The 8 output tables by name, in publish (parents-first) order."""
        t = {"DimCustomer": self.dim_customer, "DimCategory": self.dim_category,
             "DimPaymentMethod": self.dim_payment_method, "DimInvoiceStatus": self.dim_invoice_status,
             "DimDate": self.dim_date, "FactInvoice": self.fact,
             "forecast_by_invoice": self.forecast_by_invoice, "forecast_weekly": self.forecast_weekly}
        return {k: t[k] for k in C.LOAD_ORDER}


def star_for(spark: SparkSession, sf_dir: str, cfg: C.RunConfig = C.FORECAST,
             materialize: bool = False, review: bool = False) -> Star:
    return Star(load_inputs(spark, sf_dir), cfg, materialize, review)


def present(df: DataFrame) -> DataFrame:
    """Report form of a result, as the published CSVs carry it: dates as ISO text,
    decimals as doubles (exact decimals convert to the nearest double)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "date":
            out.append(F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd").alias(f.name))
        elif t == "decimal":
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
