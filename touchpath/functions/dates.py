"""Time helpers. Timestamps are UTC wall-clock TIMESTAMP_NTZ values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_to_ts(c) -> Column:
    """Epoch microseconds (LONG) -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(c), F.expr(_EPOCH_NTZ))


def ts_to_micros(c) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch microseconds, by calendar arithmetic.

    ``timestampdiff`` would cast to a zoned TIMESTAMP first and pick up DST
    offsets of the session time zone; day number + time of day does not.
    """
    t = _c(c)
    seconds = F.date_part(F.lit("SECOND"), t)  # decimal(8,6): seconds with fraction
    return (F.unix_date(F.to_date(t)).cast("bigint") * MICROS_PER_DAY
            + (F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * 1_000_000
            + (seconds * 1_000_000).cast("bigint"))


def minus_days(ts, days: int) -> Column:
    """Exact ``ts - days * 24h`` (TIMESTAMP_SUB ... INTERVAL n DAY)."""
    return F.timestamp_add("MICROSECOND", F.lit(-days * MICROS_PER_DAY), _c(ts))


def utc_date(ts) -> Column:
    """Calendar date of a UTC wall-clock TIMESTAMP_NTZ."""
    return F.to_date(_c(ts))


def months_and_days_between(first, last) -> Column:
    """Day remainder after whole months (``relativedelta(last, first).days``).

    Months are counted calendar-wise with end-of-month clamping, the way
    ``first + n months`` clamps 01-31 + 1 month to 02-29.
    """
    f, p = _c(first), _c(last)
    m = (F.year(p) - F.year(f)) * 12 + (F.month(p) - F.month(f))
    k = m - F.when(F.add_months(f, m) > p, 1).otherwise(0)
    return F.datediff(p, F.add_months(f, k))
