"""The trend stream: raw post records -> windowed keyword trends -> sinks.

    raw (value) -> parse_posts -> enrich (keywords, sentiment) -> explode
      -> watermark(event_time, 1 minute)
      -> groupBy(window(event_time, 10 seconds), keyword, source)  [state: RocksDB]
      -> update mode, foreachBatch(TrendBatchWriter(sinks))

Scale notes: the aggregation state is keyed by (window, keyword, source) and
is dropped once a window falls behind the watermark, so state size follows
the number of distinct keywords per minute, not the stream length.  The
number of state partitions equals ``spark.sql.shuffle.partitions`` at the
first start and is fixed by the checkpoint afterwards; size it for the peak
keyword rate before the first run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.functions.wordlists import Lexicon
from trendlens.operators.trends import DEFAULT_WATERMARK, DEFAULT_WIDTH, enrich, mentions, windowed_trends
from trendlens.session import checkpoint_dir, default_checkpoint, path_exists
from trendlens.sources.posts import parse_posts
from trendlens.sources.sinks import TrendBatchWriter

DEFAULT_TRIGGER = "2 seconds"


def trend_stream(raw: DataFrame | Mapping[str, DataFrame], width: str = DEFAULT_WIDTH,
                 watermark: str | Mapping[str, str] = DEFAULT_WATERMARK, lexicon: Lexicon | None = None,
                 event_time_fallback=None, engine: str = "native", max_keywords: int | None = None) -> DataFrame:
    """Streaming (or batch) windowed trends from raw post records.

    ``raw`` may map provider names to streams of their own.  Each then has its
    own watermark (``watermark`` may map the same names to delays), and what
    the query takes as the time of all of them is the session's
    ``spark.sql.streaming.multipleWatermarkPolicy``: with ``min`` the slowest
    provider's, so a provider that lags loses no row, with ``max`` the fastest
    one's.
    """
    if not isinstance(raw, Mapping):
        raw, watermark = {"": raw}, {"": watermark}
    elif isinstance(watermark, str):
        watermark = dict.fromkeys(raw, watermark)
    if set(watermark) != set(raw) or not raw:
        raise ValueError(f"watermarks for {sorted(watermark)}, streams for {sorted(raw)}")
    said = None
    for name, stream in raw.items():
        posts = parse_posts(stream, event_time_fallback=event_time_fallback)
        rows = mentions(enrich(posts, lexicon, engine=engine, max_keywords=max_keywords))
        rows = rows.withWatermark("event_time", watermark[name])
        said = rows if said is None else said.unionByName(rows)
    return windowed_trends(said, width=width)


def _epoch_folder(spark: SparkSession, target: str) -> str:
    key = hashlib.sha256(target.encode()).hexdigest()[:24]
    return f"{checkpoint_dir(spark).rstrip('/')}/trend-epochs/{key}"


def _note_epoch(spark: SparkSession, path: str, epoch: int) -> None:
    spark.createDataFrame([(str(epoch),)], "epoch string").coalesce(1).write.mode("overwrite").text(path)


def _noted_epoch(spark: SparkSession, path: str) -> int | None:
    return int(spark.read.text(path).first()[0]) if path_exists(spark, f"{path}/_SUCCESS") else None


def run_epoch(spark: SparkSession, checkpoint: str, sinks) -> int:
    """Epoch of the run that ``checkpoint`` belongs to.

    It is kept in the checkpoint folder.  A checkpoint that starts over gets
    the next epoch after every one that any of its targets has seen: those
    noted per target in the shared folder (the only trace of a Kafka run) and
    those that a sink finds in its target (``next_epoch``).  One that was
    begun without an epoch has 0.
    """
    path = f"{checkpoint.rstrip('/')}/run-epoch"
    known = _noted_epoch(spark, path)
    if known is not None:
        return known
    epoch, notes = 0, [_epoch_folder(spark, sink_target(s)) for s in sinks]
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        seen = [e + 1 for e in (_noted_epoch(spark, n) for n in notes) if e is not None]
        epoch = max([0, *seen, *(s.next_epoch(spark) for s in sinks if hasattr(s, "next_epoch"))])
    for note in notes:
        _note_epoch(spark, note, epoch)
    _note_epoch(spark, path, epoch)
    return epoch


def sink_target(sink) -> str:
    return getattr(sink, "target", type(sink).__name__)


def run_trend_stream(
    spark: SparkSession,
    raw: DataFrame | Mapping[str, DataFrame],
    sinks,
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    width: str = DEFAULT_WIDTH,
    watermark: str | Mapping[str, str] = DEFAULT_WATERMARK,
    query_name: str | None = None,
    event_time_fallback=None,
    parallelism: int | None = None,
    state_partitions: int | None = None,
    engine: str = "native",
    lexicon: Lexicon | None = None,
    max_keywords: int | None = None,
    watermark_policy: str = "min",
) -> StreamingQuery:
    """Start the trend stream in update mode with a micro-batch fan-out to
    ``sinks``.  ``checkpoint`` defaults to a folder under the shared
    ``spark.checkpoint.dir``; restarting with the same folder resumes from
    the committed offsets and state.

    ``parallelism`` spreads each micro-batch's raw records round-robin over
    that many tasks before tokenization, for sources that arrive in fewer
    partitions than the cluster has cores (small landed files).  For Kafka
    prefer the source's ``minPartitions``, which needs no shuffle.

    ``state_partitions`` is the number of state-store partitions of the
    windowed aggregation.  Every partition costs a fixed state-store commit
    per trigger, so it should follow the group volume per trigger (one task
    wave for a small stream, thousands for a large one).  It is frozen into
    the checkpoint at the first start; later values are ignored by Spark.

    ``lexicon`` defaults to :meth:`Lexicon.load` (the file that
    ``$TRENDLENS_WORDLIST`` names, else the built-in lists).  After a
    checkpoint was removed, the run gets a new epoch (:func:`run_epoch`), so
    its revisions win over those of earlier runs.

    ``raw`` and ``watermark`` may be mappings, one entry per provider (see
    :func:`trend_stream`); ``watermark_policy`` (``min`` or ``max``) then says
    whose time closes windows.  It is frozen into the checkpoint as well.
    """
    sinks = list(sinks)
    if watermark_policy not in ("min", "max"):
        raise ValueError(f"watermark policy must be min or max, got {watermark_policy!r}")
    if parallelism:
        raw = ({k: r.repartition(parallelism) for k, r in raw.items()} if isinstance(raw, Mapping)
               else raw.repartition(parallelism))
    trends = trend_stream(raw, width, watermark, lexicon or Lexicon.load(), event_time_fallback=event_time_fallback,
                          engine=engine, max_keywords=max_keywords)
    targets = [sink_target(s) for s in sinks]
    ckpt = checkpoint or default_checkpoint(spark, "trend-stream", query_name or "", *targets)
    writer = (trends.writeStream.outputMode("update")
              .option("checkpointLocation", ckpt)
              .foreachBatch(TrendBatchWriter(sinks, epoch=run_epoch(spark, ckpt, sinks))))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    # Both are read once, when the query starts.
    settings = {"spark.sql.streaming.multipleWatermarkPolicy": watermark_policy}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def run_archive_stream(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    checkpoint: str | None = None,
    available_now: bool = False,
    trigger: str | None = DEFAULT_TRIGGER,
    event_time_fallback=None,
    lexicon: Lexicon | None = None,
) -> StreamingQuery:
    """Archive of processed posts: every parsed post with its keywords and
    sentiment, appended as parquet partitioned by event date and source.

    Documented for the reference pipeline but never implemented there; a
    stateless projection, so append mode needs no watermark.
    """
    posts = enrich(parse_posts(raw, event_time_fallback=event_time_fallback), lexicon or Lexicon.load())
    out = posts.withColumn("event_date", F.to_date("event_time"))
    ckpt = checkpoint or default_checkpoint(spark, "archive-stream", path)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).option("path", path)
              .partitionBy("event_date", "source"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
