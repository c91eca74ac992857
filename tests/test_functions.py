"""Unit tables for the scalar rules and the traps listed in SURVEY section 1.6."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions import (canon, canon_known, canon_or_null, format_id, normalise_state,
                              is_blank, repair_issue_date, repair_payment_date, round_money,
                              scrub_cell, suspicious_name, title_case,
                              to_int_id, to_number, to_terms, add_days_floor, week_start)
from arcash.functions.dates import with_date
from arcash.functions.numbers import ratio_half_up


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


D = dt.date

# Parse table from FIXTURES.md section 3, plus the closed fallback list.
DATE_CASES = [
    ("2026-1-5", D(2026, 1, 5)), ("2026-01-05", D(2026, 1, 5)),
    ("05/01/2026", D(2026, 1, 5)),          # day-first wins, never 1 May
    ("01/31/2026", D(2026, 1, 31)),         # only month-first fits
    ("2026/01/05", D(2026, 1, 5)), ("05-JAN-2026", D(2026, 1, 5)), ("05-jan-26", D(2026, 1, 5)),
    ("05-01-2026", D(2026, 1, 5)), ("05-Jan-98", D(1998, 1, 5)),   # 2-digit year 98 -> 1998
    ("5/1/26", D(2026, 1, 5)), ("2026-01-05 10:00:00", D(2026, 1, 5)),
    ("5 Jan 2026", D(2026, 1, 5)), ("20260105", D(2026, 1, 5)), ("5.1.2026", D(2026, 1, 5)),
    ("Jan 5, 2026", D(2026, 1, 5)), (" 2026-01-05 ", D(2026, 1, 5)),
    ("5 January 2026", D(2026, 1, 5)), ("January 5, 2026", D(2026, 1, 5)), ("05-january-2026", D(2026, 1, 5)),
    ("2026-01-05\u00a0", D(2026, 1, 5)), ("\u2003\x1f5/1/2026\u3000", D(2026, 1, 5)), ("\u00a0", None),
    ("garbage", None), ("2026-02-30", None), ("", None), (None, None),
]


def test_unicode_white_space(spark):
    assert one_col(spark, ["\u00a0EFT\u2009", "\u00a0", " null\u00a0"], lambda c: canon_or_null(c, C.METHOD_CANON)) == ["EFT", None, None]
    assert one_col(spark, ["$1,000.00\u00a0", "\u00a0"], to_number) == [Decimal("1000.000000"), None]
    assert one_col(spark, ["\u00a0", "\x85", "x"], is_blank) == [True, True, False]


def test_wide_numbers(spark):
    assert one_col(spark, ["12345678901234567890.5", "1" * 21], to_number) == [Decimal("12345678901234567890.500000"), None]


def test_parse_date_table(spark):
    df = spark.createDataFrame([(v,) for v, _ in DATE_CASES], "s string")
    out = with_date(df, "s", "d").select("d").collect()
    assert [r[0] for r in out] == [e for _, e in DATE_CASES]


def test_swap_into_window(spark):
    cfg = C.DEFAULT
    vals = [D(2026, 5, 1), D(2026, 2, 15), D(2026, 12, 13), D(2025, 7, 3), None]
    # 1 May -> 5 Jan; inside stays; day 13 cannot be a month; swapped outside stays put.
    got = one_col(spark, vals, lambda c: repair_issue_date(c, cfg), "date")
    assert got == [D(2026, 1, 5), D(2026, 2, 15), D(2026, 12, 13), D(2025, 7, 3), None]


def test_payment_swap_only_after_snapshot(spark):
    cfg = C.DEFAULT
    vals = [D(2026, 5, 3), D(2025, 12, 20), D(2026, 3, 31), D(2026, 4, 13)]
    got = one_col(spark, vals, lambda c: repair_payment_date(c, cfg), "date")
    assert got == [D(2026, 3, 5), D(2025, 12, 20), D(2026, 3, 31), D(2026, 4, 13)]


def test_null_tokens(spark):
    vals = ["NA", "N/A", "n/a", "#N/A", "None", "null", " NULL ", "nan", "NaN ", "", "   ",
            "na", " n/a", "value", None]
    got = one_col(spark, vals, lambda c: scrub_cell("v"))
    # exact CSV tokens and padded null words go; 'na' and ' n/a' stay (not tokens)
    assert got == [None] * 11 + ["na", " n/a", "value", None]


def test_money_parse(spark):
    vals = ["$4,235.00", " 12.5 ", "1e3", "1.0d", "inf", "abc", "-5", None]
    got = one_col(spark, vals, to_number)
    assert got == [Decimal("4235"), Decimal("12.5"), Decimal("1000"), None, None, None,
                   Decimal("-5"), None]


def test_ids_keep_digits_only(spark):
    vals = ["CUST001", "INV-1001", "4", "1.0", "-5", "abc", None]
    assert one_col(spark, vals, to_int_id) == [1, 1001, 4, 10, 5, None, None]


def test_legacy_label_widens(spark):
    vals = ["CUST7", "CUST000012", "12345", "none-digit"]
    assert one_col(spark, vals, lambda c: format_id(c)) == ["CUST007", "CUST012", "CUST12345", None]


def test_title_case_after_any_non_letter(spark):
    vals = ["not-for-profit", "o'neil", "MYSTERY income", "1st place", ""]
    assert one_col(spark, vals, title_case) == ["Not-For-Profit", "O'Neil", "Mystery Income", "1St Place", ""]


def test_canon_variants(spark):
    m = C.STATUS_CANON
    assert one_col(spark, [" PAID", "overdue", "weird one", None], lambda c: canon(c, m, "Open")) == \
        ["Paid", "Overdue", "Weird One", "Open"]
    assert one_col(spark, ["Tech", " retail ", "Automotive", None],
                   lambda c: canon_known(c, C.INDUSTRY_CANON, set(C.INDUSTRY_CANON.values()))) == \
        ["Technology", "Retail", "Unknown", "Unknown"]
    assert one_col(spark, ["eft ", "B-Pay", "cheque", None], lambda c: canon_or_null(c, C.METHOD_CANON)) == \
        ["EFT", "BPAY", "Unknown", None]


def test_state_substring_rule(spark):
    vals = ["A.C.T.", "Australian Capital Territory", "NSW", " vic ", "Intact Ltd", None]
    assert one_col(spark, vals, normalise_state) == ["ACT", "ACT", "NSW", "vic", "ACT", None]


def test_suspicious_names(spark):
    vals = ["test", " N/A", "x", "12345", "Acme Pty", None, "Dummy"]
    assert one_col(spark, vals, suspicious_name) == [True, True, True, True, False, True, True]


def test_terms_text(spark):
    vals = ["30 days", "14 Days", "45", "14.9", None]
    assert one_col(spark, vals, to_terms) == [Decimal(30), Decimal(14), Decimal(45), Decimal("14.9"), None]


def test_floor_for_negative_lags(spark):
    df = spark.createDataFrame([(D(2026, 4, 10), -1.5), (D(2026, 4, 10), 1.5), (D(2026, 4, 10), 0.0)],
                               "d date, lag double")
    got = [r[0] for r in df.select(add_days_floor("d", "lag")).collect()]
    assert got == [D(2026, 4, 8), D(2026, 4, 11), D(2026, 4, 10)]


def test_weeks_start_monday(spark):
    vals = [D(2026, 4, 1), D(2026, 4, 5), D(2026, 4, 6)]
    assert one_col(spark, vals, week_start, "date") == [D(2026, 3, 30), D(2026, 3, 30), D(2026, 4, 6)]


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(Decimal("1.005"),), (Decimal("8.345"),), (Decimal("2.344"),)], "x decimal(18,6)")
    assert [r[0] for r in df.select(round_money("x")).collect()] == [Decimal("1.01"), Decimal("8.35"), Decimal("2.34")]


@pytest.mark.parametrize("num,den,scale,factor,expect", [
    (1, 8, 1, 100, 12.5), (1, 3, 1, 100, 33.3), (2, 3, 1, 100, 66.7), (1, 16, 1, 100, 6.3),
    (17, 8, 2, 1, 2.13), (-17, 8, 2, 1, -2.12), (0, 5, 1, 100, 0.0), (5, 0, 1, 100, None)])
def test_ratio_half_up_exact(spark, num, den, scale, factor, expect):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    assert df.select(ratio_half_up(F.col("n"), F.col("d"), scale, factor)).first()[0] == expect
