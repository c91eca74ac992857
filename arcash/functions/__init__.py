"""Column -> Column expression helpers (parse, canonicalise, repair, derive)."""

from arcash.functions.dates import (add_days_floor, iso, repair_issue_date,
                                    repair_payment_date, swap_into_window, swap_unconditional,
                                    week_start)
from arcash.functions.numbers import format_id, round_money, to_int_id, to_number, to_terms
from arcash.functions.text import (canon, canon_known, canon_or_null, is_blank, lookup,
                                   normalise_state, scrub_cell, strip, suspicious_name,
                                   title_case)

__all__ = [
    "add_days_floor", "canon", "canon_known", "canon_or_null", "format_id", "is_blank", "iso",
    "lookup", "normalise_state", "repair_issue_date", "repair_payment_date",
    "round_money", "scrub_cell", "strip", "suspicious_name", "swap_into_window",
    "swap_unconditional", "title_case", "to_int_id", "to_number", "to_terms", "week_start",
]
