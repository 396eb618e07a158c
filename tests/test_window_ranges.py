"""Revisions and their table at size: what is shuffled and what is held."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trendlens.operators.revisions import dedup_revisions
from trendlens.operators.trends import by_window, enrich, mentions
from trendlens.plans import catalog
from trendlens.sources import fixtures
from trendlens.sources.tables import posts_docs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_sorts_once_and_after_the_shuffle(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i % 3, i % 5, t, t + dt.timedelta(seconds=10), f"k{i % 40}", None if i % 7 == 0 else "s", i, i / 8, i / 4)
            for i in range(400)]
    rows += [(9, 9, t, t + dt.timedelta(days=1), "k1", "s", 1, None, 1.0)] * 2
    tw = spark.createDataFrame(rows, "id long, batch_id long, window_start timestamp, window_end timestamp, "
                                     "keyword string, source string, mention_count long, avg_sentiment double, "
                                     "trend_score double").repartition(5)
    out = dedup_revisions(tw)
    plan = _plan(out)
    best = {}
    for r in rows:  # the highest (batch_id, id), then the highest payload
        key = r[2:6]
        if key not in best or (r[1], r[0], r[6]) > (best[key][1], best[key][0], best[key][6]):
            best[key] = r
    assert out.columns == tw.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, best.values()))
    below = plan.split("Exchange hashpartitioning")[1]
    assert "SortAggregate" not in below and "Sort [" not in below  # whole splits are not sorted
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("query", ["dedup_revisions", "top20_count", "leaderboard_by_source", "latest_trends_dedup",
                                   "leaderboard_json", "trend_payload", "daily_backfill"])
def test_mention_groups_are_not_shuffled(spark, monkeypatch, query):
    seen, build = [], fixtures.simulate_revisions

    def spy(*args, **kwargs):
        seen.append(build(*args, **kwargs))
        return seen[-1]

    monkeypatch.setattr(fixtures, "simulate_revisions", spy)
    assert catalog.queries()[query](spark, SF_SMALL).count() > 0
    plan = _plan(seen[0])
    assert plan.count("Exchange") == 1 and "rangepartitioning(_start_10s" in plan


def test_window_ranges_give_the_same_revisions(spark):
    odd = spark.createDataFrame(
        [("n1", None, "alpha beta", None), ("n2", None, "alpha alpha crash", 3), ("n3", "src1", None, 4),
         ("n4", "src1", "", 5), ("n5", None, "alpha", 8)], "id string, source string, text string, s long")
    odd = odd.select("id", "source", "text", F.timestamp_seconds(F.col("s") + 1704067200).alias("event_time"))
    posts = posts_docs(spark, SF_SMALL).select(*odd.columns).unionByName(odd)
    plain = fixtures.simulate_revisions(mentions(enrich(posts)))
    dealt = fixtures.simulate_revisions(fixtures.window_mentions(posts))
    assert dealt.columns == plain.columns and dealt.count() == plain.count()
    assert dealt.exceptAll(plain).count() == 0
    wide = fixtures.simulate_revisions(fixtures.window_mentions(posts, 60), 60)
    assert wide.exceptAll(fixtures.simulate_revisions(mentions(enrich(posts)), 60)).count() == 0
    # ranges for windows of another width are not taken for these
    other = fixtures.simulate_revisions(fixtures.window_mentions(posts, 60), 10)
    assert other.exceptAll(plain).count() == 0
    assert fixtures.simulate_revisions(fixtures.window_mentions(posts.limit(0))).count() == 0


def test_ranges_grow_with_the_text(spark, monkeypatch):
    from trendlens.operators import trends

    posts = posts_docs(spark, SF_SMALL)
    few = by_window(posts).rdd.getNumPartitions()
    monkeypatch.setattr(trends, "TASK_BYTES", 10_000)
    assert few == spark.sparkContext.defaultParallelism < by_window(posts).rdd.getNumPartitions()
    # one window and source lies in one range
    spread = by_window(posts).select("_start_10s", "source", F.spark_partition_id().alias("p")).distinct()
    assert spread.count() == spread.select("_start_10s", "source").distinct().count()
