"""Dashboard views over a leaderboard (the output of ``latest_trends``).

A leaderboard holds at most ``limit x sources`` rows, so these views are
cheap; they are still DataFrame operations so the same code serves a batch
snapshot and a leaderboard table refreshed by the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions.text import sentiment_label_col

TABLE_ROWS = 20
CHART_ROWS = 15


def _display_order():
    # Leaderboard order plus deterministic tie-breaks.
    return [F.col("trend_score").desc(), F.col("mention_count").desc(), F.col("keyword").asc(),
            F.col("source").asc()]


def filter_source(lb: DataFrame, source: str = "all") -> DataFrame:
    """``all`` keeps every row; any other value keeps that source only."""
    return lb if source == "all" else lb.filter(F.col("source") == F.lit(source))


def with_sentiment_label(lb: DataFrame, threshold: float = 0.04) -> DataFrame:
    return lb.withColumn("sentiment_label", sentiment_label_col("avg_sentiment", threshold))


def leaderboard_view(lb: DataFrame, source: str = "all", rows: int = TABLE_ROWS) -> DataFrame:
    """The table: first ``rows`` rows of the (filtered) leaderboard."""
    return filter_source(lb, source).orderBy(*_display_order()).limit(rows)


def chart_top(lb: DataFrame, source: str = "all", rows: int = CHART_ROWS) -> DataFrame:
    """The bar chart: first ``rows`` keywords with the score at one decimal.

    The raw score is kept next to the rounded one: the browser rounds the
    binary value (``toFixed``) while Spark rounds half-up on the decimal
    expansion, so a tie like 1.45 can round differently.
    """
    ranked = filter_source(lb, source).orderBy(*_display_order()).limit(rows)
    # At most ``rows`` rows reach this un-partitioned window.
    w = F.row_number().over(Window.orderBy(*_display_order()))
    return ranked.select(
        w.cast("long").alias("rank"),
        F.col("keyword").alias("name"),
        "source",
        F.round("trend_score", 1).alias("score"),
        "trend_score",
    )


def kpis(lb: DataFrame, source: str = "all") -> DataFrame:
    """One row: total mentions shown, top keyword and its source
    (``---`` when nothing is shown)."""
    first = F.struct(-F.col("trend_score"), -F.col("mention_count"), F.col("keyword"), F.col("source"))
    return filter_source(lb, source).agg(
        F.coalesce(F.sum("mention_count"), F.lit(0)).cast("long").alias("total_volume"),
        F.coalesce(F.min_by("keyword", first), F.lit("---")).alias("top_keyword"),
        F.coalesce(F.min_by("source", first), F.lit("---")).alias("top_source"),
    )
