"""Daily rollup of the trend fact table and its upsert into the summary table.

``daily_summary`` rolls up the latest revisions of one UTC day (or, with
``day=None``, of every day at once: a backfill).  ``merge_daily_summary`` is
the upsert as a pure DataFrame operation; ``write_daily_summary`` applies it
to a parquet table partitioned by ``summary_date``, touching only the
partitions the new rows fall in.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators.common import as_of_col, exact_avg
from trendlens.operators.revisions import dedup_revisions, own_method
from trendlens.schemas import DAILY_SUMMARY_SCHEMA
from trendlens.session import delete_path, path_exists, scratch_path

SUMMARY_KEY = ("summary_date", "keyword", "source")
SUMMARY_COLUMNS = (
    "summary_date", "keyword", "source", "total_mentions", "avg_sentiment", "max_trend_score", "created_at",
)


def _date_lit(day) -> Column:
    if isinstance(day, Column):
        return day
    if isinstance(day, _dt.date):
        day = day.isoformat()
    return F.to_date(F.lit(day))


def daily_summary(tw: DataFrame, day=None, created_at=None) -> DataFrame:
    """Summary rows for windows ending in ``[day, day + 1)`` (UTC).

    ``day=None`` summarizes every day in the table (``summary_date`` =
    date of ``window_end``).  Per (keyword, source): summed mentions, mean of
    the window sentiment means, best window score.
    """
    if day is not None:
        start = _date_lit(day)
        lo, hi = start.cast("timestamp"), F.date_add(start, 1).cast("timestamp")
        cond = (F.col("window_end") >= lo) & (F.col("window_end") < hi)
        if "window_date" in tw.columns:
            # Fact table partitioned by date(window_start): a window ending in
            # the day started that day or the day before.
            cond = cond & F.col("window_date").between(F.date_sub(start, 1), start)
        tw = tw.filter(cond)
        summary_date = start
    else:
        summary_date = F.to_date("window_end")
    latest = dedup_revisions(tw.drop("window_date"), own_method(tw))
    out = latest.groupBy(summary_date.alias("summary_date"), "keyword", "source").agg(
        F.sum("mention_count").cast("long").alias("total_mentions"),
        exact_avg("avg_sentiment").alias("avg_sentiment"),
        F.max("trend_score").alias("max_trend_score"),
    )
    return out.withColumn("created_at", as_of_col(created_at)).select(*SUMMARY_COLUMNS)


def summary_for_run(tw: DataFrame, run_date, created_at=None) -> DataFrame:
    """What the nightly run on ``run_date`` produces: yesterday's summary."""
    return daily_summary(tw, F.date_sub(_date_lit(run_date), 1), created_at)


def merge_daily_summary(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert: rows of ``new`` replace rows of ``existing`` with the same
    (summary_date, keyword, source); existing keys absent from ``new`` stay."""
    kept = existing.join(new.select(*SUMMARY_KEY), list(SUMMARY_KEY), "left_anti")
    return kept.select(*SUMMARY_COLUMNS).unionByName(new.select(*SUMMARY_COLUMNS))


def write_daily_summary(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Apply ``new`` to the summary table at ``path`` (parquet, partitioned by
    ``summary_date``).

    ``new`` is computed once and written to the shared checkpoint folder (it
    is read three times below, and the written copy also cuts its lineage).
    Only the partitions of the dates present in ``new`` are read and
    rewritten: the merged rows are staged next to it first (a path being
    read is never overwritten), then swapped in with a dynamic partition
    overwrite.  Re-running with the same input is idempotent.  The table
    counts as new only if its path does not exist; any error in reading it
    is raised.  The staged copies are removed at the end.
    """
    new_path, staging = scratch_path(spark, "daily-summary-new"), scratch_path(spark, "daily-summary-staging")
    try:
        new.select(*SUMMARY_COLUMNS).write.mode("overwrite").parquet(new_path)
        new = spark.read.schema(DAILY_SUMMARY_SCHEMA).parquet(new_path)
        merged = new
        if path_exists(spark, path):
            existing = spark.read.schema(DAILY_SUMMARY_SCHEMA).parquet(path)
            # Semi-join on the partition column: the written dates are small
            # enough to be broadcast, and partition pruning then reads only the
            # affected partitions.
            dates = new.select("summary_date").distinct()
            merged = merge_daily_summary(existing.join(dates, "summary_date", "left_semi"), new)
        merged.write.mode("overwrite").partitionBy("summary_date").parquet(staging)
        staged = spark.read.schema(DAILY_SUMMARY_SCHEMA).parquet(staging)
        (staged.select(*SUMMARY_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("summary_date").parquet(path))
    finally:
        delete_path(spark, staging)
        delete_path(spark, new_path)


def run_daily_summary(spark: SparkSession, fact_path: str, summary_path: str, run_date,
                      created_at=None) -> DataFrame:
    """Nightly job: summarize the day before ``run_date`` from the fact table
    and upsert it into the summary table.  Safe to retry (idempotent)."""
    from trendlens.sources.tables import read_trend_windows

    new = summary_for_run(read_trend_windows(spark, fact_path), run_date, created_at)
    write_daily_summary(spark, new, summary_path)
    return spark.read.parquet(summary_path)
