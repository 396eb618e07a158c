"""The post stream: raw records -> parsed posts with event time.

``parse_posts`` accepts any DataFrame with a ``value`` column (binary from
Kafka, string from a text/JSON file source) so tests exercise the exact
parsing path a Kafka job uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.timefns import event_time_col, zulu_to_offset_col
from trendlens.schemas import POST_SCHEMA, POST_WIRE_SCHEMA
from trendlens.sources.normalize import NEWS_TOPIC, SOCIAL_TOPIC

ERROR_TOPIC = "pipeline-errors"
RAW_TOPICS = (SOCIAL_TOPIC, NEWS_TOPIC)


def parse_posts(raw: DataFrame, value_col: str = "value", event_time_fallback=None) -> DataFrame:
    """Cast ``value`` to text, parse it against the fixed post schema (a
    malformed record becomes an all-NULL row), flatten, default the source
    to ``unknown`` and derive ``created_at_utc`` / ``event_time``."""
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), POST_SCHEMA).alias("event")) \
        .select("event.*")
    return parsed.select(
        "id",
        F.coalesce(F.col("source"), F.lit("unknown")).alias("source"),
        "author", "text", "lang", "created_at", "url",
        zulu_to_offset_col("created_at").alias("created_at_utc"),
        event_time_col("created_at", event_time_fallback).alias("event_time"),
    )


def with_parsed(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Records (``value`` as text, other columns kept) with the fields of the
    post and ``_corrupt``, the record itself if it is no JSON object."""
    text = F.col(value_col).cast("string")
    schema = T.StructType([*POST_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    kept = [c for c in raw.columns if c != value_col]
    return raw.select(*kept, text.alias("value"), F.inline(F.array(
        F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"}))))


def post_error_col() -> Column:
    """Why a record of :func:`with_parsed` gives no usable post, or NULL:
    ``empty`` (NULL or blank record), ``malformed`` (no JSON object), ``no
    id`` and ``no text`` (absent or empty field)."""
    return (F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty")
            .when(F.col("_corrupt").isNotNull(), "malformed")
            .when(F.coalesce("id", F.lit("")) == "", "no id")
            .when(F.coalesce("text", F.lit("")) == "", "no text"))


def post_errors(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Records that give no usable post (:func:`post_error_col`), as ``(topic,
    value, reason)`` for the ``pipeline-errors`` topic.  Every other record is
    a post (:func:`parse_posts`).
    """
    parsed = with_parsed(raw.select(value_col), value_col)
    return (parsed.select(F.lit(ERROR_TOPIC).alias("topic"), "value", post_error_col().alias("reason"))
            .filter(F.col("reason").isNotNull()))


def post_value_col(columns) -> Column:
    """UTF-8 JSON of the wire fields present in ``columns`` (non-ASCII kept
    as is; NULL fields kept as JSON null, e.g. ``"url": null``)."""
    fields = [c for c in (f.name for f in POST_WIRE_SCHEMA.fields) if c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def post_payload(posts: DataFrame) -> DataFrame:
    """Posts -> (key, value) records: key = post id, value = JSON."""
    return posts.select(F.col("id").alias("key"), post_value_col(posts.columns).alias("value"))


def kafka_options(bootstrap: str, topics=RAW_TOPICS, starting_offsets: str = "earliest") -> dict[str, str]:
    """Reader options of the Kafka post source."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }


def kafka_post_stream(spark: SparkSession, bootstrap: str, topics=RAW_TOPICS,
                      max_offsets_per_trigger: int | None = None,
                      min_partitions: int | None = None) -> DataFrame:
    """Streaming post records from Kafka (needs the spark-sql-kafka package
    on the classpath).

    Tokenization is CPU-heavy and a topic has few partitions, so
    ``min_partitions`` lets the source split each topic partition's offset
    range over several tasks (no shuffle); ``max_offsets_per_trigger`` caps
    a micro-batch after downtime.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topics))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def file_post_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming post records from a folder of JSON-lines files; one line =
    one record in a ``value`` column, as Kafka would deliver it."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
