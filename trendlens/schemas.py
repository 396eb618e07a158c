"""Declared schemas.  Nothing in trendlens infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Post event as it travels on the wire (JSON).  ``metadata`` differs per
# provider; the struct is the superset of the provider fields.
METADATA_SCHEMA = T.StructType([
    T.StructField("collection", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("source_country", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("descendants", T.LongType()),
])

# The seven fields the trend job parses; ``metadata`` is ignored on parse.
POST_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("url", T.StringType()),
])

POST_WIRE_SCHEMA = T.StructType(POST_SCHEMA.fields + [T.StructField("metadata", METADATA_SCHEMA)])

# Fact table written by the trend stream (one row per emitted revision).
TREND_WINDOWS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("mention_count", T.LongType(), False),
    T.StructField("avg_sentiment", T.DoubleType(), False),
    T.StructField("trend_score", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

DAILY_SUMMARY_SCHEMA = T.StructType([
    T.StructField("summary_date", T.DateType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("total_mentions", T.LongType(), False),
    T.StructField("avg_sentiment", T.DoubleType(), False),
    T.StructField("max_trend_score", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

# Provider payloads.
BLUESKY_SCHEMA = T.StructType([
    T.StructField("did", T.StringType()),
    T.StructField("commit", T.StructType([
        T.StructField("operation", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("record", T.StructType([
            T.StructField("text", T.StringType()),
            T.StructField("createdAt", T.StringType()),
        ])),
    ])),
])

GDELT_ARTICLE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("seendate", T.StringType()),
    T.StructField("sourcecountry", T.StringType()),
])

GDELT_SCHEMA = T.StructType([T.StructField("articles", T.ArrayType(GDELT_ARTICLE_SCHEMA))])

HN_ITEM_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("by", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("descendants", T.LongType()),
])

# Columns of a parsed, enriched post (output of ``parse_posts`` + enrichment).
ENRICHED_COLUMNS = (
    "id", "source", "author", "text", "lang", "created_at", "url",
    "event_time", "sentiment", "keywords",
)
