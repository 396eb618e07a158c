"""Incremental leaderboard: equal to the leaderboard over all revisions."""

import random

import pytest
from pyspark.sql import functions as F

from trendlens.operators.leaderboard import latest_trends
from trendlens.sources.sinks import ParquetTrendSink, read_leaderboard_snapshot
from trendlens.sources.tables import read_trend_windows
from trendlens.streaming.live import MAXIMA_SCHEMA, WINDOWS_SCHEMA, IncrementalLeaderboardSink

START = 1704067200


def _batches(n, seed):
    """Revisions as update mode emits them: a window once per batch, later
    batches revise it (up or down) or move on; source c falls silent early."""
    rnd = random.Random(seed)
    out, now = [], 0
    for b in range(n):
        now += rnd.choice([5, 20, 20, 90])  # in 10-second windows
        rows = {}
        for _ in range(30):
            source = rnd.choice("ab" if b > 2 else "abc")
            start = START + 10 * max(0, now - rnd.choice([0, 0, 1, 2, 60, 170, 190, 400]))
            rows[(start, rnd.choice(["alpha", "beta", "gamma", "delta"]), source)] = (
                rnd.randint(1, 9), rnd.choice([0.1, -0.3, 1 / 3, 0.0, -1.0]))
        out.append([(b, *k, m, s, m * (1 + abs(s))) for k, (m, s) in rows.items()])
    return out


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "batch_id long, s long, keyword string, source string, mention_count long, "
                                     "avg_sentiment double, trend_score double")
    return df.select("batch_id", F.timestamp_seconds("s").alias("window_start"),
                     F.timestamp_seconds(F.col("s") + 10).alias("window_end"), "keyword", "source", "mention_count",
                     "avg_sentiment", "trend_score", F.timestamp_seconds(F.lit(START)).alias("created_at"))


@pytest.mark.parametrize("dedup", [False, True])
def test_equals_the_leaderboard_after_every_batch(spark, workdir, dedup):
    fact = ParquetTrendSink(f"{workdir}/fact")
    live = IncrementalLeaderboardSink(f"{workdir}/live", 3, dedup=dedup)
    for b, rows in enumerate(_batches(7, seed=5)):
        frame = _frame(spark, rows)
        fact(frame, b)
        live(frame, b)
        if b == 4:
            live(frame, b)  # a replayed batch
        got = read_leaderboard_snapshot(spark, f"{workdir}/live").drop("batch_id").collect()
        want = latest_trends(read_trend_windows(spark, f"{workdir}/fact"), 3, dedup=dedup).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)), b
    assert {r.source for r in got} == {"a", "b", "c"}


def test_seeded_from_a_fact_table(spark, workdir):
    fact = ParquetTrendSink(f"{workdir}/fact")
    live = IncrementalLeaderboardSink(f"{workdir}/live", 3, fact_path=f"{workdir}/fact")
    for b, rows in enumerate(_batches(4, seed=9)):
        fact(_frame(spark, rows), b)
        if b >= 2:
            live(_frame(spark, rows), b)
    got = read_leaderboard_snapshot(spark, f"{workdir}/live").drop("batch_id").collect()
    want = latest_trends(read_trend_windows(spark, f"{workdir}/fact"), 3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert live.next_epoch(spark) == 1


def test_only_the_leaving_minutes_are_read(spark, workdir):
    """No trigger reads the fact table, and what leaves the horizon is found
    by the minutes between the old and the new bound (partition filters)."""
    live = IncrementalLeaderboardSink(f"{workdir}/live", 3)
    for b, rows in enumerate(_batches(3, seed=1)):
        live(_frame(spark, rows), b)
    log = spark.read.schema(WINDOWS_SCHEMA).parquet(f"{workdir}/live/windows")
    maxima = live._before(spark, "maxima", MAXIMA_SCHEMA, 3)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "20k")  # the log is no small table
    try:
        plan = live.leaving(log, maxima)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "dynamicpruning" in plan.lower() and "slot" in plan
    assert "fact" not in plan
