"""Column expressions (all JVM-side built-ins; no Python per row)."""

from starloom.functions.text import clean_name, collated, fold_accents, plain, py_strip, try_int
from starloom.functions.timefmt import (
    add_minutes, at_time_of_day, parse_date, parse_timestamp, spread_between, valid_hms,
)
from starloom.functions.pick import hash_bucket, hash_between, hash_pick, safe_percentage

__all__ = [
    "clean_name", "collated", "fold_accents", "plain", "py_strip", "try_int", "add_minutes", "at_time_of_day",
    "parse_date", "parse_timestamp", "spread_between", "valid_hms", "hash_bucket",
    "hash_between", "hash_pick", "safe_percentage",
]
