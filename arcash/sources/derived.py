"""Raw receivables exports derived from the given TPC-H-style tables.

The driver's tables hold no invoices, so the five raw inputs of a run are derived from
``customer`` and ``orders`` with SQL text that runs unchanged in Spark and DuckDB (the
customer and fact texts are the ones in ``FIXTURES.md`` section 4). Every derived table
grows with its source table, so all registered queries scale with the data.

Each text has ``{customer}`` / ``{orders}`` placeholders: Spark binds DataFrames to them
(``spark.sql(text, orders=df)``); the DuckDB oracle substitutes the view names.
"""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.session import compile_wide_stages
from arcash.sources.raw import scrub_nulls

RAW_CUSTOMER_SQL = """
with r as (select concat('CUST',lpad(cast(c_custkey+1 as string),6,'0')) customer_id,
 case when c_custkey%97=0 then null when c_custkey%97=1 then 'test' else c_name end customer_name,
 case c_mktsegment when 'HOUSEHOLD' then 'nfp' when 'MACHINERY' then 'Tech' when 'FURNITURE' then ' retail ' when 'BUILDING' then 'CONSTRUCTION' else 'Automotive' end industry,
 case c_custkey%8 when 0 then 'std' when 1 then 'Premium' when 2 then 'ASSOC' when 3 then 'corp ' when 4 then null when 5 then 'Gold' when 6 then 'standard' else 'null' end member_tier,
 case c_custkey%5 when 0 then '14' when 1 then '30 days' when 2 then '14 Days' when 3 then '45' else null end payment_terms_days,
 case c_custkey%4 when 0 then '2000' when 1 then '$5,000' when 2 then '10000' else '20000' end credit_limit,
 concat(cast(1998+c_custkey%25 as string),'-',lpad(cast(1+c_custkey%12 as string),2,'0'),'-15') member_since,
 case c_nationkey%4 when 0 then 'ACT' when 1 then 'A.C.T.' when 2 then 'Australian Capital Territory' else 'NSW' end state, c_custkey _seq
from {customer})
 select * from r union all select customer_id, customer_name || ' (copy)', industry, member_tier, payment_terms_days, credit_limit, member_since, state, _seq+1000000000 from r where _seq%300=2
"""

RAW_FACT_SQL = """
with a as (select *, date '2026-01-01' + cast(o_orderkey%90 as int) d0, cast(case when o_orderkey%2003=11 then o_totalprice*10 else o_totalprice end as decimal(12,2)) amt from {orders}),
 b as (select *, d0 + cast(case when o_custkey%2=0 then 14 else 30 end as int) due0 from a),
 c as (select *, due0 + cast(o_orderkey*7919%21-7 as int) p0 from b),
 e as (select *, case when o_orderstatus<>'O' and p0<=date '2026-03-31' and p0>=d0 then p0 end pay0 from c),
 r as (select concat('INV-',cast(o_orderkey+1 as string)) invoice_id,
  case when o_orderkey%1009=7 then 'CUST999999' else concat('CUST',lpad(cast(o_custkey+1 as string),6,'0')) end customer_id,
  case o_orderkey%9 when 0 then 'membership income' when 1 then 'EVENTS INCOME' when 2 then 'Event Sponsorship' when 3 then ' major sponsorship' when 4 then 'Sponsorship & Advertising' when 5 then 'Document Signing Revenue' when 6 then null when 7 then 'Mystery' else 'Major Sponsorship' end category,
  case when pay0 is null then null else case o_orderkey%5 when 0 then 'eft ' when 1 then 'CC' when 2 then 'direct-debit' when 3 then 'B-Pay' else 'cheque' end end payment_method,
  case when o_orderkey%7=0 then null when pay0 is not null then 'PAID' when o_orderkey%3=0 then 'overdue' else 'Open' end status,
  case o_orderkey%6 when 0 then concat(cast(year(d0) as string),'-',lpad(cast(month(d0) as string),2,'0'),'-',lpad(cast(day(d0) as string),2,'0')) when 1 then concat(lpad(cast(day(d0) as string),2,'0'),'/',lpad(cast(month(d0) as string),2,'0'),'/',cast(year(d0) as string)) when 2 then concat(lpad(cast(month(d0) as string),2,'0'),'/',lpad(cast(day(d0) as string),2,'0'),'/',cast(year(d0) as string)) when 3 then concat(cast(year(d0) as string),'/',lpad(cast(month(d0) as string),2,'0'),'/',lpad(cast(day(d0) as string),2,'0')) when 4 then concat(lpad(cast(day(d0) as string),2,'0'),'-',substr('JanFebMarAprMayJunJulAugSepOctNovDec',cast(3*month(d0)-2 as int),3),'-',cast(year(d0) as string)) else concat(lpad(cast(day(d0) as string),2,'0'),'-',lpad(cast(month(d0) as string),2,'0'),'-',cast(year(d0) as string)) end issue_date, case when o_orderkey%11=0 then null else case (o_orderkey+1)%6 when 0 then concat(cast(year(due0) as string),'-',lpad(cast(month(due0) as string),2,'0'),'-',lpad(cast(day(due0) as string),2,'0')) when 1 then concat(lpad(cast(day(due0) as string),2,'0'),'/',lpad(cast(month(due0) as string),2,'0'),'/',cast(year(due0) as string)) when 2 then concat(lpad(cast(month(due0) as string),2,'0'),'/',lpad(cast(day(due0) as string),2,'0'),'/',cast(year(due0) as string)) when 3 then concat(cast(year(due0) as string),'/',lpad(cast(month(due0) as string),2,'0'),'/',lpad(cast(day(due0) as string),2,'0')) when 4 then concat(lpad(cast(day(due0) as string),2,'0'),'-',substr('JanFebMarAprMayJunJulAugSepOctNovDec',cast(3*month(due0)-2 as int),3),'-',cast(year(due0) as string)) else concat(lpad(cast(day(due0) as string),2,'0'),'-',lpad(cast(month(due0) as string),2,'0'),'-',cast(year(due0) as string)) end end due_date,
  case when pay0 is null then null else case (o_orderkey+3)%6 when 0 then concat(cast(year(pay0) as string),'-',lpad(cast(month(pay0) as string),2,'0'),'-',lpad(cast(day(pay0) as string),2,'0')) when 1 then concat(lpad(cast(day(pay0) as string),2,'0'),'/',lpad(cast(month(pay0) as string),2,'0'),'/',cast(year(pay0) as string)) when 2 then concat(lpad(cast(month(pay0) as string),2,'0'),'/',lpad(cast(day(pay0) as string),2,'0'),'/',cast(year(pay0) as string)) when 3 then concat(cast(year(pay0) as string),'/',lpad(cast(month(pay0) as string),2,'0'),'/',lpad(cast(day(pay0) as string),2,'0')) when 4 then concat(lpad(cast(day(pay0) as string),2,'0'),'-',substr('JanFebMarAprMayJunJulAugSepOctNovDec',cast(3*month(pay0)-2 as int),3),'-',cast(year(pay0) as string)) else concat(lpad(cast(day(pay0) as string),2,'0'),'-',lpad(cast(month(pay0) as string),2,'0'),'-',cast(year(pay0) as string)) end end payment_date,
  case when o_orderkey%13=0 then null when o_orderkey%701=5 then cast(cast(amt*0.15 as decimal(12,2)) as string) else cast(cast(amt/11 as decimal(12,2)) as string) end gst,
  case when o_orderkey%401=9 then '0' when o_orderkey%4=1 then concat('$',cast(amt as string)) else cast(amt as string) end amount_incl_gst,
  case when pay0 is null then null else cast(amt as string) end amount_paid, o_orderkey _seq from e)
 select * from r union all select * from r where _seq%500=3
"""

# Dimension exports: one line per order, so the first-wins de-duplication runs over a
# table that grows with the data. Spellings vary (case, padding, synonyms, blanks) and
# one name is unmapped, so every branch of the dimension clean is exercised.
RAW_CATEGORY_SQL = """
select concat('CAT', lpad(cast(o_orderkey%9+1 as string), 2, '0')) category_id,
 case o_orderkey%9 when 0 then 'Membership Income' when 1 then 'EVENTS INCOME' when 2 then 'Event Sponsorship' when 3 then 'Major Sponsorship' when 4 then 'Sponsorship & Advertising' when 5 then 'Document Signing Revenue' when 6 then ' major sponsorship' when 7 then 'mystery-income' else 'Events Income' end category,
 case when o_orderkey%4=0 then null else case o_orderkey%9 when 0 then 'Membership' when 1 then 'Events' when 5 then 'Other' when 7 then 'Other' when 8 then 'Events' else 'Sponsorship' end end revenue_group,
 o_orderkey _seq
from {orders}
"""

RAW_METHOD_SQL = """
select concat('PM', lpad(cast(o_orderkey%6+1 as string), 2, '0')) method_id,
 case o_orderkey%6 when 0 then 'eft ' when 1 then 'Direct Debit' when 2 then 'BPAY' when 3 then 'credit card' when 4 then 'Cheque' else null end payment_method,
 case when o_orderkey%5=0 then null else case o_orderkey%6 when 3 then 'Card' when 4 then 'Paper' else 'Electronic' end end method_type,
 o_orderkey _seq
from {orders}
"""

RAW_STATUS_SQL = """
select concat('ST', lpad(cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as string), 2, '0')) status_id,
 case when o_orderkey%10=0 then null else case o_orderstatus when 'F' then 'Paid' when 'O' then 'open' else 'OVERDUE' end end status,
 case o_orderstatus when 'F' then 'Invoice settled in full' when 'O' then 'Unpaid, not yet due at snapshot' else 'Unpaid and past due at snapshot' end description,
 o_orderkey _seq
from {orders}
"""

# Untidy cells of spreadsheet exports: no-break spaces, full month names, wide amounts.
UNTIDY_SQL = """
with a as (select o_orderkey k, date '2026-01-01' + cast(o_orderkey%365 as int) d, cast(o_totalprice as decimal(12,2)) amt from {orders}),
 b as (select *, cast(day(d) as string) dd, cast(year(d) as string) yy, case month(d) when 1 then 'January' when 2 then 'February' when 3 then 'March' when 4 then 'April' when 5 then 'May' when 6 then 'June' when 7 then 'July' when 8 then 'August' when 9 then 'September' when 10 then 'October' when 11 then 'November' else 'December' end mm from a)
select k _seq,
 case k%4 when 0 then concat(dd,' ',mm,' ',yy) when 1 then concat(mm,' ',dd,', ',yy) when 2 then concat(dd,'-',mm,'-',yy) else concat(chr(160),dd,'/',lpad(cast(month(d) as string),2,'0'),'/',yy,chr(160)) end date_text,
 case k%3 when 0 then concat(chr(160),cast(amt as string),chr(160)) when 1 then concat('$ 1',lpad(cast(k as string),13,'0'),'.25') else chr(160) end amount_text,
 case k%3 when 0 then concat('EFT',chr(160)) when 1 then concat(chr(160),' b-pay') else chr(160) end method_text
from b
"""

RAW_SQL = {
    "DimCustomer": RAW_CUSTOMER_SQL,
    "FactInvoice": RAW_FACT_SQL,
    "DimCategory": RAW_CATEGORY_SQL,
    "DimPaymentMethod": RAW_METHOD_SQL,
    "DimInvoiceStatus": RAW_STATUS_SQL,
}


class RawInputs(NamedTuple):
    """The five raw exports of one run, all text (plus ``_seq``), nulls scrubbed."""

    fact: DataFrame
    customer: DataFrame
    category: DataFrame
    method: DataFrame
    status: DataFrame


def _table(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    # Only the columns the derivation uses are read (pruned at the parquet scan).
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
_CUSTOMER_COLS = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def derived_raw(spark: SparkSession, sf_dir: str, table: str, scrub: bool = True,
                sources: dict = None) -> DataFrame:
    """One raw export derived from the given tables, as text with ``_seq``."""
    compile_wide_stages(spark)
    sources = sources or {}
    orders = sources.get("orders") or _table(spark, sf_dir, "orders", _ORDER_COLS)
    customer = sources.get("customer") or _table(spark, sf_dir, "customer", _CUSTOMER_COLS)
    text = RAW_SQL[table]
    args = {}
    if "{orders}" in text:
        args["orders"] = orders
    if "{customer}" in text:
        args["customer"] = customer
    df = spark.sql(text, **args)
    if table == "FactInvoice":
        # The clean step recomputes amount_excl_gst, so the derived export leaves it blank.
        df = df.withColumn("amount_excl_gst", F.lit(None).cast("string"))
    df = df.select(*[F.col(c).cast("string") if c != "_seq" else F.col(c) for c in df.columns])
    return scrub_nulls(df) if scrub else df


class DerivedInputs:
    """The five raw exports derived from the given tables, each built when it is first read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    @cached_property
    def _sources(self) -> dict:
        return {"orders": _table(self._spark, self._sf_dir, "orders", _ORDER_COLS),
                "customer": _table(self._spark, self._sf_dir, "customer", _CUSTOMER_COLS)}

    def _export(self, table: str) -> DataFrame:
        return derived_raw(self._spark, self._sf_dir, table, sources=self._sources)

    @cached_property
    def fact(self) -> DataFrame:
        return self._export("FactInvoice")

    @cached_property
    def customer(self) -> DataFrame:
        return self._export("DimCustomer")

    @cached_property
    def category(self) -> DataFrame:
        return self._export("DimCategory")

    @cached_property
    def method(self) -> DataFrame:
        return self._export("DimPaymentMethod")

    @cached_property
    def status(self) -> DataFrame:
        return self._export("DimInvoiceStatus")


def load_inputs(spark: SparkSession, sf_dir: str) -> DerivedInputs:
    return DerivedInputs(spark, sf_dir)
