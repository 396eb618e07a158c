"""Sinks of the trend stream and JSON payload builders.

A micro-batch of windowed trends is flattened once (``trend_rows``), persisted,
and handed to each configured sink in order (``TrendBatchWriter``).  Sinks:

* ``ParquetTrendSink``    the ``trend_windows`` fact table as parquet,
  partitioned by ``window_date`` / ``batch_id``; a replayed batch overwrites
  its own partitions, so at-least-once delivery leaves no duplicates.
* ``JdbcTrendSink``       append to a JDBC table (at-least-once: a replay
  appends again; readers keep the latest revision, see ``dedup_revisions``).
  ``sources.jdbc.LedgerJdbcTrendSink`` writes every batch exactly once.
* ``AlertSink``           windows with strong sentiment, as files or to Kafka.
* ``KafkaTrendSink``      key = keyword, value = JSON of the nine row fields.
* ``LeaderboardSnapshotSink``  recompute the served leaderboard from the fact
  table and overwrite a snapshot table (the live push, without a socket);
  ``streaming.live.IncrementalLeaderboardSink`` keeps it as state instead.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.timefns import iso_utc_col
from trendlens.operators.alerts import ALERT_TOPIC, sentiment_alerts
from trendlens.operators.common import as_of_col, interval_seconds
from trendlens.operators.trends import flatten_windows
from trendlens.schemas import TREND_WINDOWS_SCHEMA
from trendlens.session import delete_path, path_exists

TREND_TOPIC = "trend-windows-1m"

# Bits of ``batch_id`` below the run's epoch.
EPOCH_BITS = 32
TREND_ROW_FIELDS = tuple(f.name for f in TREND_WINDOWS_SCHEMA.fields if f.name != "id")


def trend_rows(batch_df: DataFrame, batch_id: int, created_at=None) -> DataFrame:
    """Windowed-trend batch -> fact-table rows: window bounds as columns,
    the micro-batch id, a write time; rows without keyword dropped."""
    flat = flatten_windows(batch_df).withColumns(
        {"batch_id": F.lit(batch_id).cast("long"), "created_at": as_of_col(created_at)})
    return flat.select(*TREND_ROW_FIELDS)


def _json(*cols: Column | str) -> Column:
    # Keep NULL fields as JSON null, like a dict serializer would.
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def trend_payload(rows: DataFrame) -> DataFrame:
    """Fact rows -> Kafka records (key = keyword, value = JSON)."""
    return rows.select(F.col("keyword").cast("string").alias("key"), _json(*TREND_ROW_FIELDS).alias("value"))


def leaderboard_json(lb: DataFrame) -> DataFrame:
    """Leaderboard rows -> one JSON object each, ISO-8601 window bounds."""
    return lb.select(_json(
        "keyword", "source",
        F.col("mention_count").cast("long").alias("mention_count"),
        F.col("avg_sentiment").cast("double").alias("avg_sentiment"),
        F.col("trend_score").cast("double").alias("trend_score"),
        iso_utc_col("window_start").alias("window_start"),
        iso_utc_col("window_end").alias("window_end"),
    ).alias("json"))


def history_json(hist: DataFrame) -> DataFrame:
    """Keyword-history rows -> one JSON object each."""
    return hist.select(_json(
        iso_utc_col("bucket").alias("bucket"),
        "keyword", "source", "mention_count", "avg_sentiment", "trend_score",
    ).alias("json"))


class ParquetTrendSink:
    """Fact table as parquet under ``path``, partitioned by the UTC date of
    ``window_start`` and by ``batch_id``.

    ``files_per_batch`` deals a micro-batch's rows over that many tasks, and
    so files per date, by date and keyword; the stateful stage before it
    keeps all of its own tasks.  Closed days are compacted later
    (``operators.compaction``).
    """

    def __init__(self, path: str, files_per_batch: int | None = None):
        self.path = path
        self.files_per_batch = files_per_batch
        self.target = path

    def next_epoch(self, spark) -> int:
        """Epoch of a run that starts over: one more than the table holds."""
        if not path_exists(spark, self.path):
            return 0
        last = spark.read.parquet(self.path).agg(F.max("batch_id")).first()[0]
        return 0 if last is None or last < 0 else (last >> EPOCH_BITS) + 1

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        out = rows.withColumn("window_date", F.to_date("window_start"))
        if self.files_per_batch:
            n = self.files_per_batch
            out = out.repartition(n, "window_date", F.pmod(F.hash("keyword"), F.lit(n)))
        out = out.withColumn("id", F.monotonically_increasing_id())
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_date", "batch_id").parquet(self.path))


class JdbcTrendSink:
    """Append to a database table, ``batch_rows`` rows per statement over at
    most ``connections`` connections."""

    def __init__(self, url: str, table: str = "trend_windows", properties: dict[str, str] | None = None,
                 batch_rows: int = 5000, connections: int = 8):
        self.url, self.table, self.properties = url, table, dict(properties or {})
        self.properties.setdefault("batchsize", str(batch_rows))
        self.properties.setdefault("numPartitions", str(connections))
        self.target = f"{url} {table}"

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.jdbc(self.url, self.table, mode="append", properties=self.properties)

    def next_epoch(self, spark) -> int:
        """Epoch of a run that starts over: one more than the table holds."""
        from trendlens.sources.jdbc import scalar, table_exists, transaction

        with transaction(spark, self.url, self.properties) as conn:
            if not table_exists(conn, self.table):
                return 0
            last = scalar(conn, f'SELECT MAX("batch_id") FROM {self.table}')
        return 0 if last is None or last < 0 else (last >> EPOCH_BITS) + 1


class KafkaTrendSink:
    def __init__(self, bootstrap: str, topic: str = TREND_TOPIC):
        self.bootstrap, self.topic = bootstrap, topic
        self.target = f"{bootstrap} {topic}"

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        (trend_payload(rows).write.format("kafka")
            .option("kafka.bootstrap.servers", self.bootstrap).option("topic", self.topic).save())


class AlertSink:
    """Sentiment alerts of each micro-batch (``operators.alerts``).

    ``fmt="files"``: parquet under ``output``, one ``batch_id`` folder per
    batch, which a replay overwrites.  ``fmt="kafka"``: ``output`` is the
    bootstrap server list; key = keyword, value = JSON of the alert.
    """

    def __init__(self, output: str, fmt: str = "files", threshold: float = 0.5, min_mentions: int = 2,
                 topic: str = ALERT_TOPIC):
        if fmt not in ("files", "kafka"):
            raise ValueError(f"unknown output format {fmt!r}")
        self.output, self.fmt, self.topic = output, fmt, topic
        self.threshold, self.min_mentions = threshold, min_mentions
        self.target = f"{output} {topic}"

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        alerts = sentiment_alerts(rows, self.threshold, self.min_mentions)
        if self.fmt == "files":
            (alerts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.output))
            return
        records = alerts.select(F.col("keyword").alias("key"), _json(*TREND_ROW_FIELDS, "level").alias("value"))
        (records.write.format("kafka").option("kafka.bootstrap.servers", self.output)
         .option("topic", self.topic).save())


class LeaderboardSnapshotSink:
    """After the fact table is written, rewrite the served leaderboard.

    The leaderboard needs each source's latest ``window_end``.  They live in a
    small table next to the leaderboard (``maxima/batch_id=N``): every
    micro-batch merges its own maxima into the newest committed version; only
    the first batch ever reads them from the fact table.  Nothing passes
    through the driver, and the leaderboard reads just the recent dates.

    A version stays readable for ``keep_for`` after a newer one is committed.
    """

    def __init__(self, fact_path: str, snapshot_path: str, limit: int = 20, dedup: bool = False,
                 keep_for: str = "1 hour"):
        self.fact_path, self.snapshot_path = fact_path, snapshot_path
        self.limit, self.dedup = limit, dedup
        self.keep_seconds = interval_seconds(keep_for)
        self.target = snapshot_path

    def next_epoch(self, spark) -> int:
        known = _versions(spark, self.snapshot_path)
        return (known[-1][0] >> EPOCH_BITS) + 1 if known else 0

    def _maxima(self, spark, tw: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
        from trendlens.operators.leaderboard import per_source_max

        folder = f"{self.snapshot_path.rstrip('/')}/maxima"
        before = [p for n, p in _versions(spark, folder) if n < batch_id]
        if before:
            known = spark.read.schema(MAXIMA_SCHEMA).parquet(before[-1]).unionByName(per_source_max(rows))
            newest = known.groupBy("source").agg(F.max("max_window_end").alias("max_window_end"))
        else:
            newest = per_source_max(tw)
        path = f"{folder}/batch_id={batch_id}"
        newest.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return spark.read.schema(MAXIMA_SCHEMA).parquet(path)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        from trendlens.operators.leaderboard import latest_trends
        from trendlens.sources.tables import read_trend_windows

        spark = rows.sparkSession
        tw = read_trend_windows(spark, self.fact_path)
        maxima = self._maxima(spark, tw, rows, batch_id)
        lb = latest_trends(tw, self.limit, dedup=self.dedup, per_source=maxima)
        # Each trigger writes a new version folder (a replay rewrites its
        # own); readers take the newest committed one, so they never see a
        # half-written leaderboard.
        path = self.snapshot_path.rstrip("/")
        lb.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch_id={batch_id}")
        for folder in (path, f"{path}/maxima"):
            _drop_old_versions(spark, folder, self.keep_seconds)


MAXIMA_SCHEMA = "source string, max_window_end timestamp"


def _versions(spark, path: str) -> list[tuple[int, str]]:
    """Committed ``batch_id=N`` version folders under ``path`` (those with a
    ``_SUCCESS`` marker), oldest first, via the Hadoop file-system API."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append((int(name.split("=", 1)[1]), st.getPath().toString()))
    return sorted(out)


def _drop_old_versions(spark, path: str, keep_seconds: int) -> None:
    """Delete the versions that a newer one replaced ``keep_seconds`` ago."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    versions = _versions(spark, path)
    for (_, old), (_, newer) in zip(versions, versions[1:]):
        mark = jvm.org.apache.hadoop.fs.Path(f"{newer}/_SUCCESS")
        done = mark.getFileSystem(conf).getFileStatus(mark).getModificationTime() / 1000
        if time.time() - done > keep_seconds:
            delete_path(spark, old)


def read_leaderboard_snapshot(spark, path: str) -> DataFrame:
    """The newest committed leaderboard written by ``LeaderboardSnapshotSink``
    (with its ``batch_id``)."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed leaderboard snapshot under {path}")
    batch_id, folder = versions[-1]
    return spark.read.parquet(folder).withColumn("batch_id", F.lit(batch_id).cast("long"))


class TrendBatchWriter:
    """``foreachBatch`` body: flatten once; with several sinks persist, skip
    an empty batch, fan out to the sinks in order, release.

    Spark counts batches from 0 again after a checkpoint was removed, so the
    stored ``batch_id`` is led by the run's ``epoch``: later runs have larger
    ids, never overwrite earlier ones' partitions and win as revisions.
    """

    def __init__(self, sinks: Sequence, created_at=None, epoch: int = 0):
        self.sinks = list(sinks)
        self.created_at = created_at
        self.epoch = epoch

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_id += self.epoch << EPOCH_BITS
        rows = trend_rows(batch_df, batch_id, self.created_at)
        if len(self.sinks) == 1:
            # One sink: its own write is the only pass over the batch (an
            # empty batch writes nothing).
            self.sinks[0](rows, batch_id)
            return
        # Several sinks: materialize the batch once (the count fills the
        # cache); each sink then reads the cached rows instead of re-running
        # the stateful plan.
        rows = rows.persist()
        try:
            if rows.count() == 0:
                return
            for sink in self.sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()
