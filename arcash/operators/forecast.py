"""Collection-lag forecast: lag statistics, per-invoice projection, weekly schedule.

Plan shape (see ``explain``): one aggregation over the paid history computes the
customer, tier and overall statistics together (GROUPING SETS, one scan, map-side
partial aggregation: the median buffer holds distinct lag values, a small domain even for
a customer holding a third of all rows). Customers, customer lags and the tier table
(broadcast: one row per valid tier at most) join into one written row per customer, so that
unpaid invoices take a single join, whose hot customers AQE splits; the overall value is a
scalar subquery. The weekly schedule aggregates before any ordering, so its window runs
over one row per week only.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import add_days_floor, week_start
from arcash.functions.numbers import cents, ratio_half_up


class LagTables(NamedTuple):
    by_customer: DataFrame   # customer_id, value, n
    by_tier: DataFrame       # member_tier, value, n
    overall: DataFrame       # one row: value (none without history)


def _stat(cfg: C.RunConfig):
    """The statistic over a (lag, n) histogram: weighted median or weighted mean."""
    if cfg.lag_stat == "median":
        return F.percentile(F.col("lag"), F.lit(0.5), F.col("n"))
    if cfg.lag_stat == "mean":
        return F.sum(F.col("lag") * F.col("n")) / F.sum("n")
    raise ValueError(f"lag_stat must be 'median' or 'mean', not {cfg.lag_stat!r}")


def lag_statistics(fact: DataFrame, customers: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """Customer, tier and overall statistics in one GROUPING SETS aggregation.

    The paid history is first reduced to a histogram (customer, lag days) -> n by a
    partial aggregation: a customer holding a third of all invoices becomes a few hundred
    rows before any shuffle, and only that histogram is joined to the customers for the
    tier. The median of a histogram (``percentile`` with a frequency) equals the median of
    the rows. Output: one row per customer with history, one per tier, one overall.
    """
    hist = (fact.filter((F.col("status") == "Paid") & F.col("payment_date").isNotNull())
            .select("customer_id", F.datediff("payment_date", "due_date").alias("lag"))
            .filter(F.col("lag").isNotNull())
            .groupBy("customer_id", "lag").agg(F.count(F.lit(1)).alias("n"))
            .join(customers.select("customer_id", "member_tier"), on="customer_id", how="left"))
    return (hist.groupingSets([["customer_id"], ["member_tier"], []], "customer_id", "member_tier")
            .agg(_stat(cfg).cast("double").alias("value"), F.sum("n").alias("n"),
                 F.grouping_id().alias("_gid")))


def lag_tables(g: DataFrame) -> LagTables:
    """The statistics by level. Written once by a caller with several readers."""
    by_customer = g.filter((F.col("_gid") == 1) & F.col("customer_id").isNotNull()) \
        .select("customer_id", "value", "n")
    by_tier = g.filter((F.col("_gid") == 2) & F.col("member_tier").isNotNull()) \
        .select("member_tier", "value", "n")
    # No paid history at all -> no () row; the scalar below defaults it to 0.
    overall = g.filter(F.col("_gid") == 3).select("value", "n")
    return LagTables(by_customer, by_tier, overall)


def paid_lag_days(fact: DataFrame) -> DataFrame:
    """Lag in days of every paid invoice (no customer attributes needed)."""
    return (fact.filter((F.col("status") == "Paid") & F.col("payment_date").isNotNull())
            .select(F.datediff("payment_date", "due_date").alias("lag"))
            .filter(F.col("lag").isNotNull()))


def lag_divergence(fact: DataFrame) -> DataFrame:
    """Mean vs median of the paid lag, overall: a large gap means a skewed history (the
    reason the median is the default statistic). Mean rounded half-up exactly."""
    return (paid_lag_days(fact)
            .agg(F.count("lag").alias("n_paid"), F.sum("lag").alias("_sum"), F.median("lag").alias("_med"))
            .select("n_paid", ratio_half_up(F.col("_sum"), F.col("n_paid"), 2, factor=1).alias("mean_lag"),
                    F.round("_med", 2).alias("median_lag")))


def customer_lags(customers: DataFrame, lags: LagTables, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """One row per customer: name, tier, and the lag it uses: its own statistic with at least
    ``min_customer_history`` paid invoices, else its tier's (null without one)."""
    rows = (customers.select("customer_id", "customer_name", "member_tier")
            .join(lags.by_customer.select("customer_id", F.col("value").alias("_c_val"),
                                          F.col("n").alias("_c_n")), on="customer_id", how="left")
            # at most one row per valid tier
            .join(F.broadcast(lags.by_tier.select("member_tier", F.col("value").alias("_t_val"))),
                  on="member_tier", how="left"))
    own = F.col("_c_n") >= cfg.min_customer_history
    return rows.select("customer_id", "customer_name", "member_tier",
                       F.round(F.when(own, F.col("_c_val")).otherwise(F.col("_t_val")), 2).alias("_lag"),
                       F.when(own, F.lit("member")).when(F.col("_t_val").isNotNull(), F.lit("tier")).alias("_source"))


def pick_lags(fact: DataFrame, profile: DataFrame, lags: LagTables) -> DataFrame:
    """Unpaid invoices with the lag they use, by one join to the written customer table (its
    skewed side can be split); without a customer's or tier's lag, the overall one."""
    overall = F.round(F.coalesce(lags.overall.select("value").scalar(), F.lit(0.0)), 2)
    return (fact.filter(F.col("status") != "Paid").join(profile, on="customer_id", how="left")
            .withColumn("lag_used", F.coalesce("_lag", overall))
            .withColumn("lag_source", F.coalesce("_source", F.lit("overall")))
            .drop("_lag", "_source"))


FBI_COLUMNS = ("invoice_id", "customer_id", "customer_name", "member_tier", "category",
               "status", "issue_date", "due_date", "amount_incl_gst", "lag_used", "lag_source",
               "expected_collection", "already_overdue")


def landing_day(projected, cfg: C.RunConfig) -> tuple:
    """Whether a projected day lies on or before the snapshot, and the day it counts for (the
    first day after the snapshot, if so)."""
    nxt = F.lit(cfg.forecast_start).cast("date")
    overdue = F.col(projected) < nxt
    return overdue.alias("already_overdue"), F.when(overdue, nxt).otherwise(F.col(projected)) \
        .alias("expected_collection")


def forecast_by_invoice(fact: DataFrame, profile: DataFrame, lags: LagTables,
                        cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """One row per unpaid invoice: expected collection = floor(due + lag) (unordered)."""
    picked = pick_lags(fact, profile, lags).withColumn("_day", add_days_floor("due_date", F.col("lag_used")))
    return picked.select("*", *landing_day("_day", cfg)).select(*FBI_COLUMNS)


def lag_source_mix(fbi: DataFrame) -> DataFrame:
    """Share of forecast rows per lag source, percent to 1 dp."""
    per = fbi.groupBy("lag_source").agg(F.count(F.lit(1)).alias("n_invoices"))
    total = F.sum("n_invoices").over(Window.partitionBy())
    return per.withColumn("pct", ratio_half_up(F.col("n_invoices"), total, 1))


def forecast_weekly(fbi: DataFrame) -> DataFrame:
    """Monday-anchored weekly schedule: count, amount, normal flow vs clamped backlog,
    empty weeks filled with zeros, running total and percent of book (1 dp)."""
    return weekly_schedule(fbi.select("expected_collection", "already_overdue",
                                      F.lit(1).cast("bigint").alias("n"), F.col("amount_incl_gst").alias("value")))


def weekly_schedule(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The schedule of rows (expected_collection, already_overdue, n, value); ``keys``
    computes independent schedules side by side."""
    keys = list(keys)
    value, overdue = F.col("value"), F.col("already_overdue")
    zero = F.lit(0).cast("decimal(18,2)")
    agg = (rows.withColumn("week_start", week_start("expected_collection"))
           .groupBy(*keys, "week_start")
           .agg(F.sum("n").alias("n_invoices"),
                F.sum(F.when(~overdue, value).otherwise(zero)).alias("normal_flow"),
                F.sum(F.when(overdue, value).otherwise(zero)).alias("overdue_backlog"),
                F.sum(value).alias("amount")))
    span = agg.groupBy(*keys).agg(F.min("week_start").alias("lo"), F.max("week_start").alias("hi"))
    weeks = span.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 week"))).alias("week_start"))
    full = (weeks.join(agg, on=keys + ["week_start"], how="left")
            .select(*keys, "week_start",
                    F.coalesce("n_invoices", F.lit(0)).cast("bigint").alias("n_invoices"),
                    F.coalesce("normal_flow", zero).alias("normal_flow"),
                    F.coalesce("overdue_backlog", zero).alias("overdue_backlog"),
                    F.coalesce("amount", zero).alias("amount")))
    # One row per week here, so an un-partitioned running window is cheap.
    w = Window.partitionBy(*keys).orderBy("week_start")
    cum = F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("amount").over(Window.partitionBy(*keys))
    return (full.withColumn("cumulative", cum)
            .withColumn("pct_of_book", ratio_half_up(cents("cumulative"), cents(total), 1, zero=0.0))
            .select(*keys, "week_start", "n_invoices", "normal_flow", "overdue_backlog",
                    "amount", "cumulative", "pct_of_book"))


def stress_forecast(fact: DataFrame, profile: DataFrame, lags: LagTables, cfg: C.RunConfig = C.DEFAULT,
                    shifts: Sequence[int] = None) -> DataFrame:
    """Weekly schedules with every lag pushed later by k days, one per k.

    Shifts are whole days, so floor(due + lag + k) = floor(due + lag) + k: the invoices are
    summed by projected day once, and only those days are repeated per scenario.
    """
    shifts = list(shifts if shifts is not None else cfg.stress_shifts)
    days = (pick_lags(fact, profile, lags)
            .groupBy(add_days_floor("due_date", F.col("lag_used")).alias("_day"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_incl_gst").alias("value")))
    shifted = (days.withColumn("shift_days", F.explode(F.array(*[F.lit(int(s)) for s in shifts])))
               .withColumn("_day", F.date_add("_day", F.col("shift_days"))))
    return weekly_schedule(shifted.select("shift_days", "n", "value", *landing_day("_day", cfg)), ["shift_days"])
