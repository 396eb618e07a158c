"""Timestamp parsing and formatting expressions.

Spark 4 runs with ANSI mode on, where ``to_timestamp`` raises on malformed
input; every parse here uses ``try_to_timestamp`` so a bad string becomes NULL
and takes the documented fallback instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.operators.common import as_of_col

SECONDS_PER_DAY = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_utc_col(ts: Column | str) -> Column:
    """ISO-8601 text of a UTC timestamp with an explicit ``+00:00`` offset,
    microseconds only when non-zero (``2024-01-01T00:00:10+00:00``)."""
    t = _col(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, ".SSSSSS")
    has_frac = (F.unix_micros(t) % F.lit(1_000_000)) != 0
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(whole, F.when(has_frac, frac).otherwise(F.lit("")), F.lit("+00:00"))
    )


def zulu_to_offset_col(text: Column | str) -> Column:
    """A trailing ``Z`` becomes ``+00:00``."""
    return F.regexp_replace(_col(text), "Z$", "+00:00")


def parse_ts_col(text: Column | str) -> Column:
    """ISO-8601 text (``Z`` or ``±hh:mm`` offset, or none = UTC) to a
    timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(zulu_to_offset_col(text))


def event_time_col(created_at: Column | str, fallback=None) -> Column:
    """Event time of a post: parsed ``created_at``, else ``fallback``
    (processing time when not given)."""
    return F.coalesce(parse_ts_col(created_at), as_of_col(fallback))


def gdelt_date_col(raw: Column | str, as_of=None) -> Column:
    """Provider date text to ISO-8601.

    NULL or empty -> ``as_of`` as ISO text; text containing both ``-`` and
    ``:`` is kept (trimmed); anything else is read positionally as
    ``YYYYMMDDTHHMMSSZ`` and rebuilt as ``YYYY-MM-DDTHH:MM:SSZ`` (short or
    garbled text gives garbled output, which later fails to parse and
    falls back to processing time).
    """
    r = _col(raw)
    t = F.trim(r)

    def part(pos: int, n: int) -> Column:
        return F.substring(t, pos, n)

    rebuilt = F.concat(
        part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"),
        part(10, 2), F.lit(":"), part(12, 2), F.lit(":"), part(14, 2), F.lit("Z"),
    )
    return (
        F.when(r.isNull() | (r == F.lit("")), iso_utc_col(as_of_col(as_of)))
        .when(t.contains("-") & t.contains(":"), t)
        .otherwise(rebuilt)
    )


def sanitize_ts_col(raw: Column | str, as_of=None, max_age_days: int = 365) -> Column:
    """Keep a provider timestamp only when it parses and lies within
    ``max_age_days`` of ``as_of``; otherwise use ``as_of`` (ISO text).

    Text with ``-`` and ``:`` is read as ISO-8601 (no offset = UTC); other
    text is first rebuilt by :func:`gdelt_date_col`.  The kept value is the
    trimmed original text, not the parsed form.
    """
    r = _col(raw)
    t = F.trim(r)
    now = as_of_col(as_of)
    iso_like = t.contains("-") & t.contains(":")
    parsed = F.when(iso_like, parse_ts_col(t)).otherwise(parse_ts_col(gdelt_date_col(t, as_of)))
    age = F.abs(F.unix_micros(now) - F.unix_micros(parsed)) / F.lit(1_000_000)
    ok = r.isNotNull() & (r != F.lit("")) & parsed.isNotNull() & (age <= F.lit(max_age_days * SECONDS_PER_DAY))
    return F.when(ok, t).otherwise(iso_utc_col(now))
