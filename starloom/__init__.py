"""starloom: a PySpark toolkit that turns wide, repeating snapshot feeds into a
dimensional warehouse (profiles, quality rules, normalised tables, star schema
with dense surrogate keys, SCD2 history and fact tables).

Every operator is a plain DataFrame function; nothing runs on the driver but
plan construction and tiny scalars.
"""

from starloom.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
