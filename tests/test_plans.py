"""Physical-plan properties that matter at scale."""

import os
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trendlens.operators.history import trend_history
from trendlens.operators.leaderboard import latest_trends
from trendlens.operators.trends import enrich, mentions
from trendlens.sources.fixtures import simulate_revisions, stored_revisions
from trendlens.sources.tables import posts_docs


def _plan(df):
    """Formatted explain text (full scan details, not truncated)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _fact_table(spark, workdir):
    tw = simulate_revisions(mentions(enrich(posts_docs(spark, SF_SMALL))))
    path = os.path.join(workdir, "tw")
    tw.withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(path)
    return spark.read.parquet(path)


def test_history_filters_reach_the_scan(spark, workdir):
    tw = _fact_table(spark, workdir)
    df = trend_history(tw, "alpha", hours=2, as_of="2024-01-01 01:00:00")
    plan = _plan(df)
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "EqualTo(keyword,alpha)" in pushed and "GreaterThanOrEqual(window_end," in pushed
    assert "PartitionFilters: [isnotnull(window_date" in plan  # date partitions pruned too


def test_latest_trends_broadcasts_maxima_and_limits_early(spark):
    facts, maxima = stored_revisions(mentions(enrich(posts_docs(spark, SF_SMALL))))
    df = latest_trends(facts, limit=5, per_source=maxima)
    df.collect()
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    assert "WindowGroupLimit" in plan  # top-N per source is cut before the shuffle by source
    # only the needed columns are read, and the text is not tokenized again
    assert "ReadSchema: struct<window_start:timestamp,window_end:timestamp,keyword:string,source:string," \
           "mention_count:bigint,avg_sentiment:double,trend_score:double>" in plan
    assert "regexp" not in plan


def _dated_facts(spark, workdir, rows):
    """Fact table of one revision per (source, day)."""
    tw = spark.createDataFrame(rows, "source string, day string").select(
        F.lit(1).cast("long").alias("id"), F.lit(0).cast("long").alias("batch_id"),
        F.to_timestamp("day").alias("window_start"),
        (F.to_timestamp("day") + F.expr("INTERVAL 10 SECONDS")).alias("window_end"),
        F.concat(F.lit("k"), "day").alias("keyword"), "source", F.lit(1).cast("long").alias("mention_count"),
        F.lit(0.0).alias("avg_sentiment"), F.lit(1.0).alias("trend_score"), F.to_date("day").alias("window_date"))
    tw.write.partitionBy("window_date").parquet(os.path.join(workdir, "dated"))
    return spark.read.parquet(os.path.join(workdir, "dated"))


def test_silent_source_leaves_the_live_one_pruned(spark, workdir):
    """A source that fell silent in January does not make a leaderboard in
    October read the months between, and no job runs to build the plan."""
    from trendlens.operators.leaderboard import per_source_max

    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 11) for d in (1, 11, 21)]
    facts = _dated_facts(spark, workdir, [("live", d) for d in days] + [("silent", "2024-01-11")])
    per_source_max(facts).write.parquet(os.path.join(workdir, "maxima"))
    maxima = spark.read.parquet(os.path.join(workdir, "maxima"))
    spark.sparkContext.setJobGroup("building", "")
    df = latest_trends(facts, 5, per_source=maxima)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    got = {(r.source, r.keyword) for r in df.collect()}
    assert got == {("live", "k2024-10-21"), ("silent", "k2024-01-11")}
    plan = df._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    assert _metric(plan, "numPartitions") <= 2 < len(days)  # the live source's last date and the silent one's
    assert latest_trends(facts, 5).collect() == df.collect()


def _metric(plan, name):
    """Largest value of a metric among the scans of an executed plan."""
    found, queue = [], [plan]
    while queue:
        node = queue.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            queue.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            queue.append(node.plan())
            continue
        if kind == "FileSourceScanExec" and node.metrics().contains(name):
            found.append(node.metrics().apply(name).value())
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_global_leaderboard_prunes_dates(spark, workdir):
    from trendlens.operators.leaderboard import latest_trends_global, per_source_max

    days = [f"2024-{m:02d}-01" for m in range(1, 11)]
    facts = _dated_facts(spark, workdir, [("live", d) for d in days])
    per_source_max(facts).write.parquet(os.path.join(workdir, "maxima"))
    df = latest_trends_global(facts, 5, per_source=spark.read.parquet(os.path.join(workdir, "maxima")))
    assert [r.keyword for r in df.collect()] == ["k2024-10-01"]
    assert _metric(df._jdf.queryExecution().executedPlan(), "numPartitions") == 1
    assert [r.keyword for r in latest_trends_global(facts, 5).collect()] == ["k2024-10-01"]


def test_as_of_bounds_both_sides(spark, workdir):
    from trendlens.operators.leaderboard import recent_top

    facts = _dated_facts(spark, workdir, [("live", d) for d in ("2024-01-02", "2024-01-03", "2024-10-27")])
    facts = facts.withColumn("keyword", F.lit("k"))
    hist = trend_history(facts, "k", hours=30, as_of="2024-01-03 00:01:00").collect()
    assert [r.bucket.day for r in hist] == [2, 3]
    top = recent_top(facts, as_of="2024-01-03 00:01:00").collect()
    assert [(r.keyword, r.mentions) for r in top] == [("k", 1)]


def test_daily_summary_prunes_partitions(spark, workdir):
    from trendlens.operators.rollup import daily_summary

    tw = _fact_table(spark, workdir)
    plan = _plan(daily_summary(tw, "2024-01-01", created_at="2024-01-02 00:00:00"))
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert "GreaterThanOrEqual(window_end," in plan and "LessThan(window_end," in plan


def test_hot_source_is_cut_before_the_shuffle(spark):
    """A third of all posts on one source: the per-source ranking still
    ships at most ``limit`` rows per task for it (partial WindowGroupLimit)
    and the rollups aggregate map-side."""
    from trendlens.operators.leaderboard import top_per_source

    posts = posts_docs(spark, SF_SMALL).withColumn(
        "source", F.when(F.col("id").cast("long") % 3 == 0, F.lit("hot")).otherwise(F.col("source")))
    tw = simulate_revisions(mentions(enrich(posts)))
    df = latest_trends(tw, limit=5)
    rows = df.collect()
    assert sum(1 for r in rows if r.source == "hot") == 5
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    assert "partial_sum(mention_count" in plan
    # the same ranking without the early limit agrees
    naive = top_per_source(tw.groupBy("keyword", "source").agg(
        F.sum("mention_count").cast("long").alias("mention_count"),
        F.sum("trend_score").alias("trend_score")), 5).filter(F.col("source") == "hot")
    assert sorted(r.keyword for r in naive.collect()) == sorted(r.keyword for r in rows if r.source == "hot")


def test_tokenizer_does_not_shuffle_by_default(spark):
    docs = posts_docs(spark, SF_SMALL)
    assert "Exchange" not in _plan(enrich(docs))
    assert "RoundRobinPartitioning(6)" in _plan(enrich(docs, partitions=6))


def test_stored_table_matches_in_memory(spark, workdir):
    """Serving queries over the date-partitioned stored table (pruned reads)
    give the same rows as over the in-memory revisions."""
    from trendlens.operators.history import trend_history
    from trendlens.operators.leaderboard import latest_trends_global
    from trendlens.operators.revisions import dedup_revisions

    mem = simulate_revisions(mentions(enrich(posts_docs(spark, SF_SMALL))))
    stored = _fact_table(spark, workdir)
    for dedup in (False, True):
        a = latest_trends(mem, 10, dedup=dedup).collect()
        b = latest_trends(stored, 10, dedup=dedup).collect()
        assert a == b
    assert sorted(latest_trends_global(mem, 10).collect()) == sorted(latest_trends_global(stored, 10).collect())
    kw = dedup_revisions(mem).orderBy(F.col("mention_count").desc(), "keyword").first().keyword
    h1 = trend_history(mem, kw, hours=2, as_of="2024-01-01 01:00:00").collect()
    h2 = trend_history(stored, kw, hours=2, as_of="2024-01-01 01:00:00").collect()
    assert h1 == h2 and len(h1) > 0
