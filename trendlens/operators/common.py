"""Small helpers shared by the serving operators."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameter bounds of the public query surface (eagerly validated, before
# any plan is built).
LIMIT_RANGE = (1, 100)
HOURS_RANGE = (1, 72)

def check_limit(limit: int) -> int:
    lo, hi = LIMIT_RANGE
    if isinstance(limit, bool) or not isinstance(limit, int) or not lo <= limit <= hi:
        raise ValueError(f"limit must be an integer in [{lo}, {hi}], got {limit!r}")
    return limit


def check_hours(hours: int) -> int:
    lo, hi = HOURS_RANGE
    if isinstance(hours, bool) or not isinstance(hours, int) or not lo <= hours <= hi:
        raise ValueError(f"hours must be an integer in [{lo}, {hi}], got {hours!r}")
    return hours


def as_of_col(as_of: Column | str | _dt.datetime | None) -> Column:
    """The query's notion of "now": explicit for reproducible runs, the
    session clock otherwise."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.to_timestamp(F.lit(as_of))


_INTERVAL = re.compile(r"^\s*(\d+)\s+(second|minute|hour|day)s?\s*$", re.IGNORECASE)


def interval(text: str) -> Column:
    """A day-time interval literal such as ``"30 minutes"`` (validated: a
    count and a unit, nothing else reaches the SQL parser)."""
    m = _INTERVAL.match(text)
    if not m:
        raise ValueError(f"interval must look like '30 minutes', got {text!r}")
    return F.expr(f"INTERVAL {int(m.group(1))} {m.group(2).upper()}S")


def interval_seconds(text: str) -> int:
    """Seconds of an interval text such as ``"1 hour"``."""
    m = _INTERVAL.match(text)
    if not m:
        raise ValueError(f"interval must look like '30 minutes', got {text!r}")
    return int(m.group(1)) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[m.group(2).lower()]


def since_filter(tw: DataFrame, since: Column, until: Column | None = None, width_days: int = 1) -> DataFrame:
    """``since <= window_end <= until``, plus, on a fact table partitioned by
    ``window_date`` (= date of window_start), the implied partition bounds:
    windows are at most ``width_days`` wide, so other date partitions are
    skipped without being listed or read.  ``until=None`` has no upper bound
    (a live table holds nothing later than now)."""
    cond = F.col("window_end") >= since
    dated = "window_date" in tw.columns
    if dated:
        cond = cond & (F.col("window_date") >= F.to_date(since - F.expr(f"INTERVAL {int(width_days)} DAYS")))
    if until is not None:
        cond = cond & (F.col("window_end") <= until)
        if dated:
            cond = cond & (F.col("window_date") <= F.to_date(until))
    return tw.filter(cond)


# A double is summed as two longs, its multiple of 2^-20 and what is left in
# multiples of 2^-50: sums do not depend on the order of the rows, and a row
# can be taken out of a sum again exactly.  Holds sums below 2^43 (8.8e12)
# over fewer than 2^33 rows; beyond that Spark's overflow check raises.
_COARSE, _FINE = float(1 << 20), float(1 << 30)


def exact_parts(value: Column | str) -> tuple[Column, Column]:
    """The two longs that stand for a double in a sum."""
    scaled = (F.col(value) if isinstance(value, str) else value) * F.lit(_COARSE)
    coarse = F.floor(scaled)
    # Not F.round, which goes through the decimal text of every double.
    return coarse, F.floor((scaled - coarse) * F.lit(_FINE) + F.lit(0.5))


def exact_value(coarse: Column, fine: Column) -> Column:
    """The double that summed parts stand for."""
    return coarse / F.lit(_COARSE) + fine / F.lit(_COARSE * _FINE)


def exact_sum(value: Column | str) -> Column:
    """``sum`` of doubles that is the same for any order of the rows."""
    coarse, fine = exact_parts(value)
    return exact_value(F.sum(coarse), F.sum(fine))


def exact_avg(value: Column | str) -> Column:
    """``avg`` of doubles that is the same for any order of the rows."""
    return exact_sum(value) / F.count(F.col(value) if isinstance(value, str) else value)
