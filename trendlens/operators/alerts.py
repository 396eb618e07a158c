"""Sentiment alerts over windowed trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERT_TOPIC = "sentiment-alerts"


def sentiment_alerts(trends: DataFrame, threshold: float = 0.5, min_mentions: int = 2) -> DataFrame:
    """Flattened windows whose mean sentiment is at least ``threshold`` away
    from neutral over ``min_mentions`` mentions or more, with ``level``
    ``positive`` or ``negative``.  A projection, on tables and streams alike."""
    strong = (F.abs("avg_sentiment") >= threshold) & (F.col("mention_count") >= min_mentions)
    return trends.filter(strong).withColumn(
        "level", F.when(F.col("avg_sentiment") > 0, "positive").otherwise("negative"))
