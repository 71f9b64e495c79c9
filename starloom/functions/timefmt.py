"""Time parsing and arithmetic on TIMESTAMP_NTZ columns.

Parsing never raises (ANSI mode is on in Spark 4): bad text becomes null and
can be counted with ``quality.parse_failures``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted time-of-day text, hours 0-23, minutes/seconds 0-59.
HMS_PATTERN = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Tolerant text → TIMESTAMP_NTZ (null when the text does not fit)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_date(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse the full timestamp text, then keep the calendar date."""
    return parse_timestamp(c, fmt).cast("date")


def valid_hms(c) -> Column:
    """Valid time-of-day text as ``HH:MM:SS``, each part padded to two digits;
    null when it is not valid."""
    col = _c(c)
    parts = F.transform(F.split(col, ":"), lambda x: F.lpad(x, 2, "0"))
    return F.when(col.rlike(HMS_PATTERN), F.array_join(parts, ":"))


def at_time_of_day(date_col, hours: int, minutes: int = 0, seconds: int = 0) -> Column:
    """Date (or timestamp truncated to its date) + a time of day."""
    d = _c(date_col).cast("date").cast("timestamp_ntz")
    return d + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes), F.lit(seconds))


def add_minutes(ts, n, step_minutes: int) -> Column:
    """``ts + n * step`` minutes, n a column (64-bit minute count, split into
    whole days and remaining minutes)."""
    total = _c(n).cast("bigint") * F.lit(step_minutes).cast("bigint")
    days = ((total - F.pmod(total, F.lit(1440))) / 1440).cast("int")
    mins = F.pmod(total, F.lit(1440)).cast("int")
    return _c(ts) + F.make_dt_interval(days, F.lit(0), mins)


def spread_between(date_col, rn, n, start_hour: int = 18, end_hour: int = 23) -> Column:
    """Place member ``rn`` (1-based) of a group of ``n`` evenly between two
    hours of the same day; a lone member goes to the start.  Integer
    microseconds keep the rounding identical in every engine."""
    span_us = (end_hour - start_hour) * 3600 * 1_000_000
    # the product has up to 38 digits, so a group may have any number of members
    num = F.lit(span_us).cast("decimal(11,0)") * (_c(rn).cast("bigint") - 1).cast("decimal(19,0)")
    den = F.greatest(_c(n).cast("bigint") - 1, F.lit(1).cast("bigint")).cast("decimal(19,0)")
    micros = ((num - F.pmod(num, den)) / den).cast("bigint")
    secs = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return at_time_of_day(date_col, start_hour) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
