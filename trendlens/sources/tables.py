"""Batch readers for the parquet test tables and the post fixtures built on
them.

The fixtures turn generic tables into the post schema the trend operators
consume; they are projections only (no shuffle), so the scan keeps column
pruning and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.schemas import TREND_WINDOWS_SCHEMA

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# 2024-01-01T00:00:00Z: origin of the document fixture's event time.
FIXTURE_EPOCH = 1704067200

EVENT_SOURCES = ("bluesky", "gdelt", "hackernews")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document; ``event_time`` = 2024-01-01 + doc_id seconds,
    so each 10-second window holds ten posts."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("author"),
        F.col("text"),
        F.col("lang"),
        F.timestamp_seconds(F.lit(FIXTURE_EPOCH) + F.col("doc_id")).alias("event_time"),
    )


def posts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-word post per event (the event type), spread over the
    three provider names by ``user_id``; 30 days of event time."""
    e = read_table(spark, sf_dir, "events")
    uid = F.col("user_id")
    src = (
        F.when(uid % 3 == 0, F.lit(EVENT_SOURCES[0]))
        .when(uid % 3 == 1, F.lit(EVENT_SOURCES[1]))
        .otherwise(F.lit(EVENT_SOURCES[2]))
    )
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        src.alias("source"),
        F.concat(F.lit("u"), uid.cast("string")).alias("author"),
        F.col("event_type").alias("text"),
        F.lit("en").alias("lang"),
        # ts is TIMESTAMP_NTZ on disk; watermarks need a zoned timestamp.
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def read_trend_windows(spark: SparkSession, path: str) -> DataFrame:
    """The ``trend_windows`` fact table written by ``ParquetTrendSink``
    (partition columns ``window_date`` and ``batch_id`` included).

    Filters on ``window_date`` prune partitions; the serving operators add
    such filters themselves where a time bound is known.
    """
    fields = [f for f in TREND_WINDOWS_SCHEMA.fields if f.name != "batch_id"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return spark.read.schema(f"{schema}, window_date date, batch_id bigint").parquet(path)


def read_trend_windows_jdbc(spark: SparkSession, url: str, table: str = "trend_windows",
                            properties: dict[str, str] | None = None, num_partitions: int | None = None,
                            id_bounds: tuple[int, int] | None = None) -> DataFrame:
    """The fact table from a database (the original deployment's store).

    With ``num_partitions`` and ``id_bounds`` the read is split into range
    queries on the numeric ``id`` column, one per task; filters of the
    serving queries (time bounds, keyword) are pushed into those queries.
    """
    props = dict(properties or {})
    if num_partitions and id_bounds:
        lo, hi = id_bounds
        return spark.read.jdbc(url, table, column="id", lowerBound=lo, upperBound=hi,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)
