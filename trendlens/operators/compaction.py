"""Compaction of closed days of the ``trend_windows`` fact table.

The stream's sink writes one ``(window_date, batch_id)`` partition per
micro-batch, i.e. thousands of small folders per day, and every window
keeps all of its revisions.  Once a day can no longer receive revisions
(the watermark is far past it), ``compact_day`` rewrites it as the latest
revision of each window, in a few files sorted by keyword (tight min/max
statistics for keyword lookups), under ``batch_id = -1``.

Results are unchanged for everything that reads the table.  Queries that
read latest revisions are indifferent to compaction; the served leaderboard
sums all revisions of the last minutes of each source, so revisions within
that horizon of their source's newest window keep their rows.  A revision
that still arrives later carries a real (larger) batch id and wins over the
compacted row.

Only closed days are taken: one whose windows can still be revised by the
clock (the day, the watermark and a trigger are not over) is refused.  A
stream that replays old events may write to it all the same; so the files are
listed before they are read and again before the swap, a day that changed is
read anew, and what was written between that look and the swap is moved into
the new folder.  Until then such a batch, and for the moment between the two
renames of the swap the whole day, is not there for a reader that lists the
table just then (a catalog with snapshots would have no such moment).  A run
that was cut off in between is put right by the next.  A DataFrame that
listed the day before the compaction must be read again.

Rows are sorted by keyword and their row groups carry Bloom filters of the
keywords, so that a lookup of one keyword reads few of them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trendlens.operators.common import interval, interval_seconds
from trendlens.operators.leaderboard import per_source_max
from trendlens.operators.revisions import dedup_revisions
from trendlens.session import delete_path, list_files, path_exists, rename_path

COMPACTED_BATCH = -1
ATTEMPTS = 5
ROW_GROUP_BYTES = 8 << 20


def check_closed(day: str, watermark: str, trigger: str, now: _dt.datetime | None = None) -> None:
    """Raise ``ValueError`` if windows of ``day`` (UTC) can still be revised."""
    end = _dt.datetime.fromisoformat(day).replace(tzinfo=_dt.timezone.utc) + _dt.timedelta(days=1)
    closed = end + _dt.timedelta(seconds=interval_seconds(watermark) + interval_seconds(trigger))
    now = now or _dt.datetime.now(_dt.timezone.utc)
    if now < closed:
        raise ValueError(f"{day} is open until {closed.isoformat()}")


def compact_day(spark: SparkSession, path: str, day, files: int | None = None, horizon: str = "30 minutes",
                watermark: str = "1 minute", trigger: str = "2 seconds", now: _dt.datetime | None = None,
                row_group_bytes: int = ROW_GROUP_BYTES) -> int:
    """Rewrite ``window_date = day`` of the fact table at ``path``; returns
    the number of rows kept.  ``horizon`` is the longest that a query which
    sums all revisions looks back; ``watermark`` and ``trigger`` are those of
    the stream, ``now`` (UTC) defaults to the clock."""
    if isinstance(day, _dt.date):
        day = day.isoformat()
    check_closed(day, watermark, trigger, now)
    root = path.rstrip("/")
    part, ready, old = f"{root}/window_date={day}", f"{root}/_ready-{day}", f"{root}/_old-{day}"
    if path_exists(spark, old):  # an earlier run was cut off between its renames
        if not path_exists(spark, part):
            rename_path(spark, old, part)
        delete_path(spark, old)
    for _ in range(ATTEMPTS):
        seen = list_files(spark, part)
        n = _write_compacted(spark, path, part, ready, files, horizon, row_group_bytes)
        if list_files(spark, part) == seen:
            break
    else:
        delete_path(spark, ready)
        raise RuntimeError(f"{part} was written to during each of {ATTEMPTS} compactions")
    rename_path(spark, part, old)
    rename_path(spark, ready, part)
    # Batches that came after the last look at the day.
    late = sorted({name.split("/")[0] for name in list_files(spark, old).keys() - seen.keys()})
    for folder in late:
        delete_path(spark, f"{part}/{folder}")  # an earlier write of the batch, of which this one is the replay
        rename_path(spark, f"{old}/{folder}", f"{part}/{folder}")
    delete_path(spark, old)
    return n


def _write_compacted(spark: SparkSession, path: str, part: str, ready: str, files: int | None, horizon: str,
                     row_group_bytes: int) -> int:
    whole = spark.read.option("basePath", path).parquet(part)
    columns = [c for c in whole.columns if c != "window_date"]
    newest = per_source_max(spark.read.parquet(path)).select(
        "source", (F.col("max_window_end") - interval(horizon)).alias("_since"))
    marked = whole.select(*columns).join(newest, "source")
    closed = dedup_revisions(marked.filter("window_end < _since").select(*columns))
    kept = closed.withColumn("batch_id", F.lit(COMPACTED_BATCH).cast("long")).unionByName(
        marked.filter("window_end >= _since").select(*columns))
    if files:
        kept = kept.repartitionByRange(files, "keyword")
    (kept.sortWithinPartitions("batch_id", "keyword", "window_start").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("parquet.block.size", str(row_group_bytes))
     .option("parquet.bloom.filter.enabled#keyword", "true").partitionBy("batch_id").parquet(ready))
    return spark.read.parquet(ready).count()
