"""Keyword history: a time-bucketed series for one keyword."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.operators.common import as_of_col, check_hours, exact_avg, exact_sum, since_filter
from trendlens.operators.revisions import dedup_revisions, own_method


def time_bucket_col(ts: str, width: str = "10 seconds"):
    """Start of the epoch-aligned ``width`` bucket holding ``ts``."""
    return F.window(ts, width).start


def trend_history(tw: DataFrame, keyword: str, hours: int = 2, as_of=None,
                  bucket: str = "10 seconds") -> DataFrame:
    """Latest revisions of ``keyword`` whose window ended within ``hours`` of
    ``as_of`` (and, when it is given, not after it), summed per (bucket of window_end, keyword, source), oldest
    bucket first.

    Both predicates are on revision-key columns, so applying them before the
    dedup gives the same rows; they reach the parquet scan as pushed filters
    and dedup only sees the one keyword.
    """
    check_hours(hours)
    now = as_of_col(as_of)
    recent = since_filter(tw, now - F.make_dt_interval(hours=F.lit(hours)), None if as_of is None else now)
    selected = recent.filter(F.col("keyword") == F.lit(keyword))
    if "window_date" in selected.columns:
        selected = selected.drop("window_date")
    latest = dedup_revisions(selected, own_method(tw))
    out = latest.groupBy(time_bucket_col("window_end", bucket).alias("bucket"), "keyword", "source").agg(
        F.sum("mention_count").cast("long").alias("mention_count"),
        exact_avg("avg_sentiment").alias("avg_sentiment"),
        exact_sum("trend_score").alias("trend_score"),
    )
    return out.orderBy("bucket", "source")
