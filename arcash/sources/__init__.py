"""Sources: raw CSV scans and raw exports derived from the given tables."""

from arcash.sources.derived import RawInputs, derived_raw, load_inputs
from arcash.sources.raw import SEQ, read_raw_csv, scrub_nulls

__all__ = ["RawInputs", "SEQ", "derived_raw", "load_inputs", "read_raw_csv", "scrub_nulls"]
