"""Finance measures over the published star (collection, aging, concentration, credit,
trends, cash milestones, period roll-ups).

All are grouped aggregations with map-side partial aggregation; shares use exact
half-up rounding (``ratio_half_up``) so results do not depend on float formatting.
Un-partitioned windows appear only after aggregation to a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions.numbers import cents, ratio_half_up
from arcash.operators.ranking import running_total
from arcash.session import RunFolder


def _paid():
    return F.col("status") == "Paid"


def _zero():
    return F.lit(0).cast("decimal(18,2)")


def book_totals(fact: DataFrame) -> DataFrame:
    """Invoiced, collected (paid invoices' value) and open AR, one row."""
    incl = F.col("amount_incl_gst")
    return fact.agg(F.count(F.lit(1)).alias("n_invoices"),
                    F.coalesce(F.sum(incl), _zero()).alias("total_invoiced"),
                    F.coalesce(F.sum(F.when(_paid(), incl)), _zero()).alias("collected"),
                    F.coalesce(F.sum(F.when(~_paid(), incl)), _zero()).alias("open_ar"))


def collection_rate(fact: DataFrame) -> DataFrame:
    """Paid value / invoiced value, percent to 1 dp."""
    t = book_totals(fact)
    return t.select("total_invoiced", "collected",
                    ratio_half_up(cents("collected"), cents("total_invoiced"), 1).alias("collection_rate_pct"))


def ar_position(fact: DataFrame) -> DataFrame:
    """Per derived status: invoices, value, and shares of all invoices / of open AR."""
    per = fact.groupBy("status").agg(F.count(F.lit(1)).alias("n_invoices"),
                                     F.sum("amount_incl_gst").alias("amount"))
    all_w = Window.partitionBy()
    n_all = F.sum("n_invoices").over(all_w)
    open_all = F.sum(F.when(F.col("status") != "Paid", F.col("amount")).otherwise(_zero())).over(all_w)
    return per.select(
        "status", "n_invoices", "amount",
        ratio_half_up(F.col("n_invoices"), n_all, 1).alias("pct_of_invoices"),
        F.when(F.col("status") != "Paid", ratio_half_up(cents("amount"), cents(open_all), 1))
        .alias("pct_of_open_ar"))


AGING_EDGES = ((None, 0, "Current"), (1, 30, "1-30"), (31, 60, "31-60"), (61, 90, "61-90"),
               (91, None, "90+"))


def aging_bucket(days_past_due) -> F.Column:
    expr = None
    for lo, hi, label in AGING_EDGES:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (days_past_due >= lo)
        if hi is not None:
            cond = cond & (days_past_due <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def aging_buckets(fact: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> DataFrame:
    """Unpaid value by days past due at the snapshot."""
    dpd = F.datediff(F.lit(cfg.snapshot).cast("date"), F.col("due_date"))
    return (fact.filter(~_paid()).withColumn("aging_bucket", aging_bucket(dpd))
            .groupBy("aging_bucket")
            .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum("amount_incl_gst").alias("amount")))


def ar_concentration_group(fact: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Open AR by revenue group and its share of all open AR."""
    groups = dim_category.select("category", "revenue_group")
    # Aggregate per category first (a handful of rows), then join the dimension.
    per_cat = (fact.filter(~_paid()).groupBy("category")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_incl_gst").alias("amt")))
    per = (per_cat.join(groups, on="category", how="left")
           .withColumn("revenue_group", F.coalesce("revenue_group", F.lit("Unknown")))
           .groupBy("revenue_group")
           .agg(F.sum("n").alias("n_invoices"), F.sum("amt").alias("open_ar")))
    total = F.sum("open_ar").over(Window.partitionBy())
    return per.withColumn("pct_of_open_ar", ratio_half_up(cents("open_ar"), cents(total), 1))


def ar_concentration_debtor(fact: DataFrame, customers: DataFrame, folder: RunFolder) -> DataFrame:
    """Every debtor by open AR, with rank and share of all open AR.

    Per-customer sums are a distributed aggregation; ranks are partition-wise row numbers of
    the range-partitioned debtors plus the rows of the earlier partitions.
    """
    per = (fact.filter(~_paid()).groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum("amount_incl_gst").alias("open_ar"),
                F.lit(1).alias("_one")))
    ranked = running_total(per, [F.col("open_ar").desc(), F.col("customer_id").asc()], "_one", folder, "debtors")
    total = folder.spark.read.parquet(f"{folder.root}/debtors").agg(F.sum("open_ar")).scalar()
    return (ranked.join(customers.select("customer_id", "customer_name"), on="customer_id", how="left")
            .select(F.col("_upto").cast("int").alias("debtor_rank"), "customer_id", "customer_name",
                    "n_invoices", "open_ar",
                    ratio_half_up(cents("open_ar"), cents(total), 1).alias("pct_of_open_ar")))


def credit_utilisation(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Open AR against each customer's credit limit (customers with open AR)."""
    per = fact.filter(~_paid()).groupBy("customer_id").agg(F.sum("amount_incl_gst").alias("open_ar"))
    c = customers.select("customer_id", "customer_name", "member_tier", "credit_limit")
    limit = F.col("credit_limit")
    return (per.join(c, on="customer_id", how="left")
            .select("customer_id", "customer_name", "member_tier", "credit_limit", "open_ar",
                    F.when(limit > 0, ratio_half_up(cents("open_ar"), limit * 100, 1)).alias("utilisation_pct"),
                    F.coalesce(F.col("open_ar") > limit, F.lit(False)).alias("over_limit")))


def cohort_collection(fact: DataFrame) -> DataFrame:
    """Collection rate by issue month."""
    incl = F.col("amount_incl_gst")
    per = (fact.groupBy(F.date_format("issue_date", "yyyy-MM").alias("issue_month"))
           .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum(incl).alias("invoiced"),
                F.coalesce(F.sum(F.when(_paid(), incl)), _zero()).alias("collected")))
    return per.withColumn("collection_rate_pct", ratio_half_up(cents("collected"), cents("invoiced"), 1))


def on_time_by_month(fact: DataFrame) -> DataFrame:
    """Share of paid invoices paid on or before the due date, by payment month."""
    paid = fact.filter(_paid() & F.col("payment_date").isNotNull())
    per = (paid.groupBy(F.date_format("payment_date", "yyyy-MM").alias("payment_month"))
           .agg(F.count(F.lit(1)).alias("n_paid"),
                F.count_if(F.col("payment_date") <= F.col("due_date")).alias("n_on_time")))
    return per.withColumn("on_time_pct", ratio_half_up(F.col("n_on_time"), F.col("n_paid"), 1))


def days_late_by_tier(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Average days from due date to payment, per member tier (paid invoices)."""
    # Sums per customer first (partial aggregation absorbs a hot customer), then the tier.
    per_cust = (fact.filter(_paid() & F.col("payment_date").isNotNull()).groupBy("customer_id")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.datediff("payment_date", "due_date")).alias("d")))
    per = (per_cust.join(customers.select("customer_id", "member_tier"), on="customer_id", how="left")
           .groupBy("member_tier").agg(F.sum("n").alias("n_paid"), F.sum("d").alias("total_days_late")))
    return per.withColumn("avg_days_late", ratio_half_up(F.col("total_days_late"), F.col("n_paid"), 2, factor=1))


def receipts_by_method(fact: DataFrame, dim_method: DataFrame) -> DataFrame:
    """Cash received per payment method and method type."""
    per = (fact.filter(_paid()).groupBy("payment_method")
           .agg(F.count(F.lit(1)).alias("n_paid"), F.sum("amount_paid").alias("amount_received")))
    return (per.join(dim_method.select("payment_method", "method_type"), on="payment_method", how="left")
            .select("payment_method", "method_type", "n_paid", "amount_received"))


def cash_milestones(weekly: DataFrame, thresholds=(80, 98)) -> DataFrame:
    """First week whose cumulative share of the book reaches each threshold."""
    row = weekly.agg(*[F.min(F.when(F.col("pct_of_book") >= t, F.col("week_start"))).alias(f"w{t}")
                       for t in thresholds])
    stacked = F.inline(F.array(*[F.struct(F.lit(t).alias("milestone_pct"), F.col(f"w{t}").alias("week_start"))
                                 for t in thresholds]))
    return row.select(stacked)


def invoiced_by_month(fact: DataFrame) -> DataFrame:
    """Issue-date roll-up by year / quarter / month (the calendar attributes are a pure
    function of the date, so no join to the date dimension is needed)."""
    d = F.col("issue_date")
    incl = F.col("amount_incl_gst")
    return (fact.groupBy(F.year(d).alias("year"),
                         F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
                         F.month(d).alias("month_no"), F.date_format(d, "MMM").alias("month_name"))
            .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum(incl).alias("invoiced"),
                 F.coalesce(F.sum(F.when(_paid(), incl)), _zero()).alias("collected"),
                 F.coalesce(F.sum(F.when(~_paid(), incl)), _zero()).alias("outstanding")))
