"""Dead letters: malformed records split off the stream, mended, sent back.

    raw (value) -> every micro-batch in one write, by route
        <path>/route=accepted/batch_id=N   records that give a post
        <path>/route=errors/batch_id=N     the others, with the reason

Both routes of a batch are partitions of one dynamic overwrite, so a replayed
batch replaces both and no record is on two routes.  ``replay_errors`` mends
records of the error route; those that give a post now are written to the
accepted route as a batch of their own, each with the place it came from,
which is what keeps a later replay from sending it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.session import default_checkpoint, path_exists
from trendlens.sources.posts import post_error_col, with_parsed

ACCEPTED, ERRORS = "accepted", "errors"
# ``from_batch`` and ``place`` name a record; they stay with it when it is mended.
RECORD_SCHEMA = "value string, reason string, from_batch bigint, place bigint"


def routed(records: DataFrame) -> DataFrame:
    """Records with ``reason`` (NULL for a post) and ``route``."""
    keep = [c for c in records.columns if c not in ("reason", "route")]
    return with_parsed(records.select(*keep), "value").select(*keep, post_error_col().alias("reason")).withColumn(
        "route", F.when(F.col("reason").isNull(), ACCEPTED).otherwise(ERRORS))


def _write(records: DataFrame, path: str) -> None:
    (records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("route", "batch_id").parquet(path))


def split_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch of raw records to its two routes.  A record is
    named by its batch and its place in it; sources deliver a replayed batch
    in the same order."""
    named = batch.select(F.col("value").cast("string").alias("value"),
                         F.lit(batch_id).cast("long").alias("from_batch"),
                         F.monotonically_increasing_id().alias("place"))
    _write(routed(named).withColumn("batch_id", F.col("from_batch")), path)


def run_split_stream(spark: SparkSession, raw: DataFrame, path: str, checkpoint: str | None = None,
                     available_now: bool = False, trigger: str | None = "2 seconds") -> StreamingQuery:
    """Start the stream that splits ``raw`` into the two routes under ``path``."""
    writer = (raw.writeStream.option("checkpointLocation", checkpoint or default_checkpoint(spark, "split-stream", path))
              .foreachBatch(lambda batch, batch_id: split_batch(batch, batch_id, path)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_route(spark: SparkSession, path: str, route: str) -> DataFrame:
    """Records of a route with their ``batch_id``; none before any was written."""
    folder = f"{path.rstrip('/')}/route={route}"
    schema = f"{RECORD_SCHEMA}, batch_id bigint"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def accepted_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming records (``value``) of the accepted route, mended ones too,
    as input of the trend stream."""
    return spark.readStream.schema(f"{RECORD_SCHEMA}, batch_id bigint").parquet(
        f"{path.rstrip('/')}/route={ACCEPTED}").select("value")


def open_errors(spark: SparkSession, path: str) -> DataFrame:
    """Records of the error route that no replay has sent back yet."""
    sent = read_route(spark, path, ACCEPTED).filter("batch_id < 0").select("from_batch", "place")
    return read_route(spark, path, ERRORS).join(sent, ["from_batch", "place"], "left_anti")


def replay_errors(spark: SparkSession, path: str, mend: Callable[[DataFrame], DataFrame]) -> int:
    """Send open errors back: ``mend`` changes their ``value`` (or drops rows)
    and keeps ``from_batch`` and ``place``; those that give a post now are
    accepted.  Returns how many.  Each is sent once, however often this runs;
    a run that fails has written nothing.  Run one replay at a time.
    """
    mended = routed(mend(open_errors(spark, path)).select("value", "from_batch", "place"))
    ready = mended.filter(F.col("route") == ACCEPTED).dropDuplicates(["from_batch", "place"])
    last = read_route(spark, path, ACCEPTED).agg(F.min("batch_id")).first()[0]
    run = min(-1, (last if last is not None and last < 0 else 0) - 1)
    _write(ready.withColumn("batch_id", F.lit(run).cast("long")), path)
    return read_route(spark, path, ACCEPTED).filter(F.col("batch_id") == run).count()


def route_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, accepted, errors, sent_back)`` per micro-batch: the first
    two add up to its records, ``sent_back`` are those of its errors that a
    replay has returned."""
    accepted = read_route(spark, path, ACCEPTED).select(
        F.col("from_batch").alias("batch_id"), F.when(F.col("batch_id") < 0, "sent_back").otherwise(ACCEPTED).alias("k"))
    errors = read_route(spark, path, ERRORS).select(F.col("from_batch").alias("batch_id"), F.lit(ERRORS).alias("k"))
    return accepted.unionAll(errors).groupBy("batch_id").agg(
        *[F.count_if(F.col("k") == k).alias(k) for k in (ACCEPTED, ERRORS, "sent_back")])
