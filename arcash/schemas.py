"""Columns of the raw exports, all text."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: the column names of the exports.
RAW_COLUMNS = {
    "FactInvoice": ("invoice_id", "customer_id", "category", "payment_method", "status",
                    "issue_date", "due_date", "payment_date", "amount_excl_gst", "gst",
                    "amount_incl_gst", "amount_paid"),
    "DimCustomer": ("customer_id", "customer_name", "industry", "member_tier",
                    "payment_terms_days", "credit_limit", "member_since", "state"),
    "DimCategory": ("category_id", "category", "revenue_group"),
    "DimPaymentMethod": ("method_id", "payment_method", "method_type"),
    "DimInvoiceStatus": ("status_id", "status", "description"),
}


def raw_schema(table: str) -> T.StructType:
    """Every raw column is text; nothing is inferred."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table]])
