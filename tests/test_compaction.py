"""Compaction next to a writing stream, and what a keyword lookup reads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from trendlens.operators import compaction
from trendlens.operators.compaction import check_closed, compact_day
from trendlens.operators.history import trend_history
from trendlens.sources.sinks import ParquetTrendSink
from trendlens.sources.tables import read_trend_windows

DAY, START = "2024-01-01", 1704067200


def _rows(spark, batch_id, n, words=300):
    i = F.col("id")
    start = F.timestamp_seconds(F.lit(START) + 10 * (i % 1000))
    return spark.range(n).select(
        F.lit(batch_id).cast("long").alias("batch_id"), start.alias("window_start"),
        (start + F.expr("INTERVAL 10 SECONDS")).alias("window_end"),
        F.concat(F.lit("word"), F.format_string("%05d", (i * 7919) % words)).alias("keyword"), F.lit("gdelt").alias("source"),
        (i % 5 + 1 + batch_id).alias("mention_count"), F.lit(0.25).alias("avg_sentiment"), F.lit(1.25).alias("trend_score"),
        F.timestamp_seconds(F.lit(START)).alias("created_at"))


def _later(spark, path):
    """A newer day, so that the horizon of the served leaderboard is past."""
    ParquetTrendSink(path)(_rows(spark, 0, 1).withColumns(
        {c: F.col(c) + F.expr("INTERVAL 2 DAYS") for c in ("window_start", "window_end")}), 0)


def test_open_days_are_refused(spark, workdir):
    at = lambda text: dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    with pytest.raises(ValueError):
        check_closed(DAY, "1 minute", "2 seconds", at("2024-01-02 00:01:01"))
    check_closed(DAY, "1 minute", "2 seconds", at("2024-01-02 00:01:02"))
    ParquetTrendSink(f"{workdir}/fact")(_rows(spark, 0, 10), 0)
    with pytest.raises(ValueError):
        compact_day(spark, f"{workdir}/fact", DAY, now=at("2024-01-01 12:00:00"))
    assert spark.read.parquet(f"{workdir}/fact").count() == 10


@pytest.mark.parametrize("moment", ["read", "swap"])
def test_a_batch_written_meanwhile_is_kept(spark, workdir, monkeypatch, moment):
    """A stream writes batch 1 after the day was read, or after the last look
    at it: its rows are there after the compaction and win as revisions."""
    path = f"{workdir}/fact"
    ParquetTrendSink(path)(_rows(spark, 0, 1000), 0)
    _later(spark, path)
    done = []

    def late():
        if not done:
            done.append(1)
            ParquetTrendSink(path)(_rows(spark, 1, 50), 1)

    if moment == "read":
        write = compaction._write_compacted
        monkeypatch.setattr(compaction, "_write_compacted", lambda *a: (write(*a), late())[0])
    else:
        rename = compaction.rename_path
        monkeypatch.setattr(compaction, "rename_path", lambda *a: (late(), rename(*a)))
    compact_day(spark, path, DAY)
    after = read_trend_windows(spark, path).filter(f"window_date = '{DAY}'")
    assert done and {r[0] for r in after.select("batch_id").distinct().collect()} == ({-1} if moment == "read" else {-1, 1})
    from trendlens.operators.revisions import dedup_revisions

    latest = dedup_revisions(after.drop("window_date"))
    assert latest.count() == 1000
    assert latest.agg(F.sum("mention_count")).first()[0] == 1000 * 3 + 50  # batch 1 counts one more each
    assert [f for f in os.listdir(path) if f.startswith(("_old", "_ready"))] == []


def _scanned(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _scanned(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _scanned(plan.plan())
    children = [plan.children().apply(k) for k in range(plan.children().size())]
    if not children:
        return plan.metrics().apply("numOutputRows").value() if plan.metrics().contains("numOutputRows") else 0
    return sum(map(_scanned, children))


def _rows_read(df):
    """Rows that the scan of an executed plan put out (its own metric)."""
    df.collect()
    return _scanned(df._jdf.queryExecution().executedPlan())


def test_a_keyword_lookup_reads_few_row_groups(spark, workdir):
    """A compacted day of many row groups: a present keyword is found in a
    small part of them, an absent one inside their range in none (their Bloom
    filters say so)."""
    path = f"{workdir}/fact"
    ParquetTrendSink(path)(_rows(spark, 0, 60_000, words=20_000), 0)
    _later(spark, path)
    before = _rows_read(trend_history(read_trend_windows(spark, path), "word00777", 72, as_of="2024-01-02 00:00:00"))
    compact_day(spark, path, DAY, files=2, row_group_bytes=64 << 10)
    look = lambda word: trend_history(read_trend_windows(spark, path), word, 72, as_of="2024-01-02 00:00:00")
    assert look("word00777").count() == 1
    kept = spark.read.parquet(f"{path}/window_date={DAY}").count()
    assert before >= kept == 20_000 and 0 < _rows_read(look("word00777")) <= kept * 0.2
    assert _rows_read(look("word00777x")) == 0
