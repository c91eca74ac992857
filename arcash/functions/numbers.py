"""Number and id parsing as native expressions.

Money is parsed to ``DECIMAL(26,6)`` (20 whole digits, exact; no float error at tolerance
boundaries) and later rounded to the 2-dp output scale. Other text and ``inf`` -> null; a
number that does not fit is null too and is listed with its raw text in a review set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arcash.functions.text import col_, is_blank, strip

MONEY_PARSE = "decimal(26,6)"
MONEY = "decimal(22,2)"


def to_number(c) -> Column:
    """``'$1,080.5'`` -> 1080.500000; blank or unparseable -> null."""
    cleaned = strip(F.replace(F.replace(col_(c), F.lit("$"), F.lit("")), F.lit(","), F.lit("")))
    return F.when(is_blank(c), F.lit(None).cast(MONEY_PARSE)).otherwise(cleaned.try_cast(MONEY_PARSE))


def to_terms(c) -> Column:
    """Payment terms text: lower-case, drop the word ``days``, then parse as a number."""
    return F.when(is_blank(c), F.lit(None).cast(MONEY_PARSE)).otherwise(
        to_number(F.replace(F.lower(col_(c)), F.lit("days"), F.lit(""))))


def id_digits(c) -> Column:
    """Every non-digit removed; '' when nothing is left."""
    return F.regexp_replace(F.coalesce(col_(c), F.lit("")), r"[^0-9]+", "")


def to_int_id(c) -> Column:
    """``'A-0042'`` / ``'no. 9'`` / ``'17'`` -> integer; no digits, or over 19 of them -> null.

    Every non-digit is dropped (``'1.0'`` -> 10, ``'-5'`` -> 5), matching the source.
    """
    return id_digits(c).try_cast("bigint")


def format_id(c, prefix: str = "CUST", width: int = 3) -> Column:
    """Legacy label: prefix + number zero-padded to at least ``width`` digits.

    Wider numbers are kept whole (``lpad`` alone would cut ``12345`` to ``123``).
    """
    n = to_int_id(c).cast("string")
    padded = F.when(F.char_length(n) >= width, n).otherwise(F.lpad(n, width, "0"))
    return F.when(n.isNotNull(), F.concat(F.lit(prefix), padded))


def round_money(c) -> Column:
    """Round half-up to cents, typed ``DECIMAL(22,2)`` (wide enough that ANSI casts never overflow)."""
    return F.round(col_(c), 2).cast(MONEY)


def _floor_div(n: Column, d: Column) -> Column:
    """Exact floor division of integer-valued decimals (``d`` > 0)."""
    return ((n - F.pmod(n, d)) / d).cast("decimal(38,0)")


def ratio_half_up(num, den, scale: int = 1, factor: int = 100, zero=None) -> Column:
    """``round(factor * num / den, scale)`` rounded half-up, computed exactly.

    ``num`` and ``den`` must be integer-valued (counts, or money already in cents). The
    quotient is formed with 38-digit integer arithmetic, so the result does not depend
    on floating-point representation. ``den == 0`` -> ``zero`` (default null).
    """
    n = col_(num).cast("decimal(38,0)")
    d = col_(den).cast("decimal(38,0)")
    d_safe = F.when(d == 0, F.lit(1).cast("decimal(38,0)")).otherwise(d)  # never divide by 0
    unit = 10 ** scale
    top = n * F.lit(2 * factor * unit).cast("decimal(38,0)") + d_safe
    bottom = d_safe * F.lit(2).cast("decimal(38,0)")
    q = _floor_div(top, bottom)
    value = (q.cast("double") / F.lit(float(unit)))
    zero_col = F.lit(zero).cast("double") if zero is not None else F.lit(None).cast("double")
    return F.when(d == 0, zero_col).otherwise(value)


def cents(c) -> Column:
    """Money -> integer cents (exact for 2-dp decimals)."""
    return (col_(c) * F.lit(100)).cast("decimal(38,0)")
