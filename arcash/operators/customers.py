"""DimCustomer: ids, first-wins de-duplication, tier / terms / industry / state rules and
the customer review sets (duplicates, suspicious names, tier vs credit-limit)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import (canon_known, is_blank, lookup, normalise_state, strip, suspicious_name, to_int_id, to_number, to_terms)
from arcash.functions.dates import with_date
from arcash.operators.dedup import all_copies, first_per_key
from arcash.sources.raw import SEQ

DIM_CUSTOMER_COLUMNS = ("customer_id", "customer_name", "industry", "member_tier",
                        "payment_terms_days", "credit_limit", "member_since", "state")


class CustomerClean(NamedTuple):
    clean: DataFrame          # DimCustomer
    duplicates: DataFrame     # every row of a repeated customer_id
    name_warnings: DataFrame  # blank / suspicious names
    tier_mismatch: DataFrame  # credit limit differs from the tier's expected limit
    raw_rows: DataFrame       # raw input (for row conservation counts)
    unusable_ids: DataFrame   # rows without an id, or with one that does not fit


def with_customer_ids(raw: DataFrame) -> DataFrame:
    """Digits-only integer ids; rows without a usable id go to a review set."""
    return raw.withColumn("customer_id", to_int_id("customer_id")).filter(F.col("customer_id").isNotNull())


def derive_member_tier(tier, credit) -> F.Column:
    """Canonical tier; a blank tier is read off the credit limit; anything else Standard."""
    by_credit = lookup(C.CREDIT_LIMIT_TO_TIER, credit.try_cast("bigint"))
    canon = lookup(C.TIER_CANON, F.lower(strip(tier)))
    return (F.when(is_blank(tier), F.coalesce(by_credit, F.lit("Standard")))
            .otherwise(F.coalesce(canon, F.lit("Standard"))))


def derive_payment_terms(terms, tier) -> F.Column:
    """Keep 14 or 30 (truncated to whole days); otherwise the tier's standard terms."""
    whole = terms.try_cast("int")
    return (F.when(whole.isin(*C.VALID_TERMS), whole)
            .otherwise(lookup(C.TERMS_BY_TIER, tier)).cast("int"))


def fill_customer_name(name, cid) -> F.Column:
    return F.when(is_blank(name), F.concat(F.lit("Unknown Customer "), cid.cast("string"))) \
        .otherwise(strip(name))


def clean_customers(raw: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> CustomerClean:
    ided = with_customer_ids(raw)
    duplicates = all_copies(ided, "customer_id")
    first = first_per_key(ided, "customer_id")

    typed = (first
             .withColumns({"_credit": to_number("credit_limit"),
                           "_terms": to_terms("payment_terms_days"),
                           "industry": canon_known("industry", cfg.industry_canon,
                                                   sorted(set(cfg.industry_canon.values()))),
                           "state": normalise_state("state"),
                           "_raw_name": F.col("customer_name"),
                           "customer_name": fill_customer_name(F.col("customer_name"), F.col("customer_id"))})
             .withColumn("member_tier", derive_member_tier(F.col("member_tier"), F.col("_credit")))
             .withColumns({"payment_terms_days": derive_payment_terms(F.col("_terms"), F.col("member_tier")),
                           "_expected_limit": lookup({v: k for k, v in C.CREDIT_LIMIT_TO_TIER.items()},
                                                     F.col("member_tier"))}))
    typed = with_date(typed, "member_since", "member_since")

    name_warnings = (typed.filter(suspicious_name("_raw_name"))
                     .select("customer_id", F.col("_raw_name").alias("customer_name"),
                             F.when(is_blank("_raw_name"), F.lit("blank_customer_name"))
                             .otherwise(F.lit("suspicious_customer_name")).alias("warning_reason")))

    tier_mismatch = (typed.filter(F.col("_credit").isNotNull() & F.col("_expected_limit").isNotNull()
                                  & (F.col("_credit") != F.col("_expected_limit")))
                     .select("customer_id", "customer_name", "member_tier",
                             F.col("_credit").alias("credit_limit"),
                             F.col("_expected_limit").cast("bigint").alias("expected_credit_limit")))

    clean = typed.select(
        F.col("customer_id").cast("bigint").alias("customer_id"), "customer_name", "industry",
        "member_tier", "payment_terms_days",
        F.col("_credit").try_cast("bigint").alias("credit_limit"),
        "member_since", "state")
    unusable = raw.filter(to_int_id("customer_id").isNull()).drop(SEQ)
    return CustomerClean(clean, duplicates.drop(SEQ), name_warnings, tier_mismatch, raw, unusable)
