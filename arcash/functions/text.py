"""Text helpers: null tokens, blanks, stripping, title case and canonical-map lookups.

All helpers build native Catalyst expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from arcash import config as C

# A cell that is empty, only whitespace, or a null word in any case, with padding.
# White space is any Unicode space or separator, as spreadsheets export it.
SPACE = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]"
_NULL_WORD = rf"(?i)^{SPACE}*(null|none|nan)?{SPACE}*$"
# The characters of SPACE, for a trim that looks at a cell's ends only.
SPACES = "".join(map(chr, (32, *range(9, 14), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(v: str) -> str:
    """A SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return sql_str(v)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strip(c) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark ``trim`` only drops spaces)."""
    return F.btrim(col_(c), F.lit(SPACES))


def scrub_cell(c, csv_tokens: bool = True) -> Column:
    """Null out missing-value placeholders in one text cell (``c`` is a column name).

    ``csv_tokens`` adds the exact (unpadded) tokens a CSV reader treats as missing,
    e.g. ``N/A`` and ``#N/A``; then any padded ``null``/``none``/``nan`` or blank cell.
    Built as one SQL expression (a single call into the JVM).
    """
    q = quote(c)
    cond = f"{q} IS NULL OR {q} RLIKE {sql_str(_NULL_WORD)}"
    if csv_tokens:
        cond += f" OR {q} IN ({', '.join(sql_str(t) for t in C.CSV_NULL_TOKENS)})"
    return F.expr(f"CASE WHEN {cond} THEN CAST(NULL AS STRING) ELSE {q} END")


def is_blank(c) -> Column:
    """True for null and for the text placeholders that mean 'missing' (null-safe)."""
    c = col_(c)
    return c.isNull() | c.rlike(_NULL_WORD)


def title_case(c) -> Column:
    """Upper-case a letter that follows a non-letter, lower-case the rest.

    Unlike ``initcap`` (which only starts words after spaces) this starts a word after
    any non-letter: ``not-for-profit`` -> ``Not-For-Profit``, ``o'neil`` -> ``O'Neil``.
    """
    c = col_(c)
    n = F.char_length(c)
    one = F.lit(1)
    chars = F.transform(
        F.sequence(one, F.greatest(n, one)),
        lambda i: F.when((i == 1) | ~F.substr(c, i - 1, one).rlike(r"\p{L}"),
                         F.upper(F.substr(c, i, one)))
        .otherwise(F.lower(F.substr(c, i, one))),
    )
    return F.when(n > 0, F.array_join(chars, "")).otherwise(c)


def map_literal(mapping: Mapping) -> Column:
    """A literal MAP column; Catalyst folds it into the plan (no join, no broadcast)."""
    return F.expr("map(" + ", ".join(f"{sql_lit(k)}, {sql_lit(v)}" for k, v in mapping.items()) + ")")


def lookup(mapping: Mapping, key) -> Column:
    """``mapping[key]``; null when the key is absent or null."""
    return map_literal(mapping)[col_(key)]


def canon(c, mapping: Mapping, missing="Unknown") -> Column:
    """Map a raw value to its canonical form; unmapped non-blanks are title-cased."""
    s = strip(c)
    miss = F.lit(missing).cast("string") if missing is not None else F.lit(None).cast("string")
    return (F.when(is_blank(c), miss)
            .otherwise(F.coalesce(lookup(mapping, F.lower(s)), title_case(s))))


def canon_known(c, mapping: Mapping, valid: Iterable[str], missing="Unknown") -> Column:
    """Canonicalise into a closed set; non-blank values outside it become ``Unknown``."""
    closed = {k: v for k, v in mapping.items() if v in set(valid)}
    mapped = lookup(closed, F.lower(strip(c))) if closed else F.lit(None).cast("string")
    return F.when(is_blank(c), F.lit(missing)).otherwise(F.coalesce(mapped, F.lit("Unknown")))


def canon_or_null(c, mapping: Mapping, unmapped="Unknown") -> Column:
    """Blank stays null; mapped -> canonical; anything else -> ``unmapped``."""
    mapped = lookup(mapping, F.lower(strip(c)))
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(F.coalesce(mapped, F.lit(unmapped)))


def suspicious_name(c) -> Column:
    """Blank, shorter than 2 characters, a placeholder word, or only digits."""
    s = strip(c)
    return (is_blank(c) | (F.char_length(s) < 2) | F.lower(s).isin(*C.SUSPICIOUS_NAMES)
            | s.rlike(r"^\p{Nd}+$"))


def normalise_state(c) -> Column:
    """Any spelling of the capital territory -> ``ACT``; blank -> null; else stripped.

    The test is a substring test after dropping dots, as in the source (so a value that
    merely contains the letters ``act`` also becomes ``ACT``).
    """
    low = F.lower(col_(c))
    act = F.replace(low, F.lit("."), F.lit("")).contains("act") | low.contains("capital territory")
    return (F.when(is_blank(c), F.lit(None).cast("string"))
            .when(act, F.lit("ACT"))
            .otherwise(strip(c)))
