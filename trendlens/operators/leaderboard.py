"""Leaderboard queries over the ``trend_windows`` fact table.

Plan shape of ``latest_trends`` (see ``explain``):

    per-source maxima (a small table the sink keeps, or an aggregate)
      -> one row per source and date within its horizon
      -> broadcast by size; prunes the fact table's dates (dynamic partition
         pruning), so a source that fell silent months ago adds its own last
         dates and not everything since
    scan(dates) -> join on (source, window_date) + range filter
      -> partial agg -> shuffle(keyword, source) -> final agg
      -> WindowGroupLimit(partial) -> shuffle(source)
      -> WindowGroupLimit(final) -> Window -> filter -> sort

No job runs while the plan is built.

Ranking is per source, and a source can hold a third of all groups.  The
partial WindowGroupLimit keeps at most ``limit`` rows per source in every map
task, so the shuffle by source carries ``limit x sources x tasks`` rows, never
the hot source's whole group list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.operators.common import as_of_col, check_limit, exact_avg, exact_sum, interval, since_filter
from trendlens.operators.revisions import dedup_revisions, own_method

LEADERBOARD_COLUMNS = (
    "keyword", "source", "mention_count", "avg_sentiment", "trend_score", "window_start", "window_end",
)

# Ranking order.  The reference ranks by score then mentions and leaves ties
# open; keyword is added so results are deterministic.
def rank_order() -> list[Column]:
    return [F.col("trend_score").desc(), F.col("mention_count").desc(), F.col("keyword").asc()]


def per_source_max(tw: DataFrame) -> DataFrame:
    """Latest ``window_end`` per source (one row per source)."""
    return tw.groupBy("source").agg(F.max("window_end").alias("max_window_end"))


def rollup_recent(recent: DataFrame) -> DataFrame:
    """Per (keyword, source): summed mentions and scores, the unweighted mean
    of window sentiment means, and the covered time span."""
    return recent.groupBy("keyword", "source").agg(
        F.sum("mention_count").cast("long").alias("mention_count"),
        exact_avg("avg_sentiment").alias("avg_sentiment"),
        exact_sum("trend_score").alias("trend_score"),
        F.min("window_start").alias("window_start"),
        F.max("window_end").alias("window_end"),
    )


def top_per_source(df: DataFrame, limit: int) -> DataFrame:
    """Keep the ``limit`` best rows of every source (ROW_NUMBER <= limit)."""
    w = Window.partitionBy("source").orderBy(*rank_order())
    return df.withColumn("_srn", F.row_number().over(w)).filter(F.col("_srn") <= limit).drop("_srn")


def latest_trends(tw: DataFrame, limit: int = 20, horizon: str = "30 minutes",
                  dedup: bool = False, per_source: DataFrame | None = None) -> DataFrame:
    """Top ``limit`` keywords per source over the last ``horizon`` of each
    source's own timeline, best first.

    ``dedup=False`` reproduces the served leaderboard, which sums every
    stored revision of a window; ``dedup=True`` first keeps only the latest
    revision (the corrected form).

    ``per_source`` (source, max_window_end) is the table of maxima that
    ``LeaderboardSnapshotSink`` keeps; without it the maxima are an aggregate
    over ``tw`` inside the same plan.  Whether it is broadcast is left to the
    planner, which knows the table's size in bytes.
    """
    check_limit(limit)
    newest = per_source if per_source is not None else per_source_max(tw)
    # Always true; Spark prunes partitions by a join only if the other side is
    # filtered by a comparison.
    newest = newest.filter(F.col("max_window_end") >= F.timestamp_seconds(F.lit(0)))
    bounds = newest.select("source", (F.col("max_window_end") - interval(horizon)).alias("_since"),
                           F.col("max_window_end").alias("_until"))
    if "window_date" in tw.columns:
        # Dates on which a window that ends within the horizon can start
        # (windows are at most a day wide).
        dates = F.sequence(F.to_date(F.col("_since") - F.expr("INTERVAL 1 DAY")), F.to_date("_until"))
        bounds = bounds.select("source", "_since", F.explode(dates).alias("window_date"))
        joined = tw.join(bounds, ["source", "window_date"]).drop("window_date")
    else:
        joined = tw.join(bounds.drop("_until"), "source")
    recent = joined.filter(F.col("window_end") >= F.col("_since")).drop("_since")
    if dedup:
        recent = dedup_revisions(recent, own_method(tw))
    ranked = top_per_source(rollup_recent(recent.select(*LEADERBOARD_COLUMNS)), limit)
    return ranked.select(*LEADERBOARD_COLUMNS).orderBy(*rank_order(), F.col("source").asc())


def latest_trends_global(tw: DataFrame, limit: int = 20, horizon: str = "10 minutes",
                         as_of=None, per_source: DataFrame | None = None) -> DataFrame:
    """Manual test-query form: latest revisions only, horizon measured from
    the newest window of the whole table (from ``as_of`` when the table is
    empty), top ``limit`` per source.

    The newest window is a scalar subquery over ``per_source`` (else over
    ``tw``); it is evaluated before files are listed, so it prunes dates.
    """
    check_limit(limit)
    maxima = per_source if per_source is not None else per_source_max(tw)
    newest = maxima.agg(F.max("max_window_end")).scalar()
    recent = since_filter(tw, F.coalesce(newest, as_of_col(as_of)) - interval(horizon)).drop("window_date")
    ranked = top_per_source(rollup_recent(dedup_revisions(recent, own_method(tw)).select(*LEADERBOARD_COLUMNS)), limit)
    return ranked.select(*LEADERBOARD_COLUMNS)


def top_count_per_source(leaderboard: DataFrame) -> DataFrame:
    """Rows per source in a leaderboard (the manual test query's output)."""
    return leaderboard.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def recent_top(tw: DataFrame, as_of=None, horizon: str = "10 minutes", limit: int = 20) -> DataFrame:
    """Simple leaderboard: summed mentions and score per (keyword, source)
    for windows ending within ``horizon`` of ``as_of`` (and, when it is given,
    not after it); global top ``limit`` by score (ties: mentions, keyword,
    source)."""
    check_limit(limit)
    now = as_of_col(as_of)
    recent = since_filter(tw, now - interval(horizon), None if as_of is None else now)
    agg = recent.groupBy("keyword", "source").agg(
        F.sum("mention_count").cast("long").alias("mentions"),
        exact_sum("trend_score").alias("score"),
    )
    return agg.orderBy(F.col("score").desc(), F.col("mentions").desc(), "keyword", "source").limit(limit)
