"""Date parsing and repair as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions.text import col_, quote, sql_str, strip


def staged(df, **columns):
    """``df`` with computed columns, each evaluated once per row.

    Later filters and projections that use a column several times would otherwise be merged
    into this projection, repeating its whole expression at each use (the date parse alone
    has 18 branches). A one-row generator is a boundary the optimizer does not merge across. The
    columns are computed by a projection below it: a generator outside whole-stage generation
    interprets its expressions, a projection compiles them.
    """
    rest = [c for c in df.columns if c not in columns]
    computed = df.select(*rest, F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_staged"))
    return computed.select(*rest, F.inline(F.array("_staged")))


def with_date(df, src: str, dst: str):
    """Add ``dst`` = parsed ``src`` in two projections (strip, then parse).

    Staging matters: the repair rules reference a date many times inside CASE branches,
    where common-subexpression elimination does not apply. Referencing a column instead
    of the 15-pattern parse keeps generated code small (Catalyst's CollapseProject does
    not inline a non-trivial expression that is consumed more than once).
    """
    tmp = f"_{dst}_text"
    return (df.withColumn(tmp, strip(src))
            .withColumn(dst, parse_date_sql(tmp))
            .drop(tmp))


_MONTHS = ", ".join(f"'{m}', '{i}'" for i, m in enumerate(
    ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1))


def plain_date_sql(q: str) -> str:
    """The date of a cell in one of the main shapes with a four-digit year, by one shape test and a
    cast; null if it has another shape or is no date. A pattern parse that fails costs an exception
    and a second parser, which every month-first cell would pay.

    A day-first reading needs a month up to 12; where it has one but no such day, the month-first
    reading has no month, so the two never compete."""
    def iso_form(shape: str, form: str) -> str:
        return f"try_cast(regexp_replace({q}, {sql_str(shape)}, {sql_str(form)}) AS DATE)"
    year_first, day_first = r"^\d{4}([-/])\d{1,2}\1\d{1,2}$", r"^\d{1,2}([-/])(0?[1-9]|1[0-2])\1\d{4}$"
    return (f"CASE WHEN {q} RLIKE {sql_str(year_first)} THEN try_cast(replace({q}, '/', '-') AS DATE) "
            f"WHEN {q} RLIKE {sql_str(day_first)} THEN " + iso_form(r"^(\d+).(\d+).(\d+)$", "$3-$2-$1") +
            f" WHEN {q} RLIKE {sql_str(C.DATE_SHAPES['d-MMM-yyyy'])} THEN try_cast(concat(right({q}, 4), '-', "
            f"map({_MONTHS})[lower(substr({q}, -8, 3))], '-', split_part({q}, '-', 1)) AS DATE) "
            f"WHEN {q} RLIKE {sql_str(C.DATE_SHAPES['M/d/yyyy'])} THEN " + iso_form(r"^(\d+)/(\d+)/(\d+)$", "$3-$1-$2") +
            " END")


def parse_date_sql(name: str, patterns=C.DATE_PATTERNS, fallback=C.DATE_FALLBACK_PATTERNS) -> Column:
    """Try each pattern in order (day-first wins); first match -> ``DateType``. One SQL
    expression over a stripped text column. Blank or unmatched -> null; two-digit years from
    the pivot on belong to the 1900s."""
    q = quote(name)
    tries = [plain_date_sql(q)] if tuple(patterns) == C.DATE_PATTERNS else []
    for p in tuple(patterns) + tuple(fallback):
        t = f"try_to_date({q}, {sql_str(p)})"
        if "yy" in p and "yyyy" not in p:
            t = (f"add_months({t}, CASE WHEN year({t}) % 100 >= {C.TWO_DIGIT_YEAR_PIVOT} "
                 f"THEN -1200 ELSE 0 END)")
        if p in C.DATE_SHAPES:
            t = f"CASE WHEN {q} RLIKE {sql_str(C.DATE_SHAPES[p])} THEN {t} END"
        tries.append(t)
    return F.expr(f"CASE WHEN {q} IS NULL OR {q} = '' THEN CAST(NULL AS DATE) "
                  f"ELSE coalesce({', '.join(tries)}) END")


def swap_day_month(d) -> Column:
    """The date with day and month exchanged; null when the day cannot be a month."""
    d = col_(d)
    # least(...) keeps make_date valid under ANSI even on the branch that is not taken.
    swapped = F.make_date(F.year(d), F.least(F.dayofmonth(d), F.lit(12)), F.month(d))
    return F.when(F.dayofmonth(d) <= 12, swapped)


def swap_into_window(d, start: str, end: str) -> Column:
    """Undo a day/month misread: outside [start, end] and the swap lands inside -> swap."""
    d = col_(d)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    sw = swap_day_month(d)
    return (F.when(d.isNull() | d.between(lo, hi), d)
            .when(sw.isNotNull() & sw.between(lo, hi), sw)
            .otherwise(d))


def swap_unconditional(d) -> Column:
    """Legacy repair: swap day and month whenever the result is a valid date."""
    d = col_(d)
    return F.coalesce(swap_day_month(d), d)


def repair_issue_date(d, cfg) -> Column:
    return swap_into_window(d, cfg.period_start, cfg.period_end)


def repair_payment_date(d, cfg) -> Column:
    """A payment after the snapshot is assumed misread and swapped into [start, snapshot]."""
    d = col_(d)
    snap = F.lit(cfg.snapshot).cast("date")
    return F.when(d > snap, swap_into_window(d, cfg.period_start, cfg.snapshot)).otherwise(d)


def iso(d) -> Column:
    """``DateType`` -> ``'YYYY-MM-DD'`` text (null stays null). Used only at sinks."""
    return F.date_format(col_(d), "yyyy-MM-dd")


def add_days_floor(d, days) -> Column:
    """``d + floor(days)``: a fractional lag of -1.5 lands two days earlier."""
    return F.date_add(col_(d), F.floor(col_(days)).cast("int"))


def week_start(d) -> Column:
    """Monday of the calendar week containing ``d``."""
    return F.to_date(F.date_trunc("week", col_(d)))
