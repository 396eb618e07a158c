"""Live leaderboard kept as state: every micro-batch adds and takes back.

``LeaderboardSnapshotSink`` ranks the whole horizon of the fact table on
every trigger.  ``IncrementalLeaderboardSink`` never reads the fact table.
It keeps, in versions next to the leaderboard:

* ``maxima``   the latest ``window_end`` per source;
* ``windows``  the revisions within the horizon, by the minute in which their
  windows end;
* ``totals``   per (keyword, source) the sums over the horizon, as pairs of
  longs (``operators.common.exact_parts``), and its windows.

A micro-batch adds its own rows to the totals and takes back the rows of
windows that left a source's horizon (only the minutes between the old and
the new bound are read) and, with ``dedup``, the earlier revisions of the
windows it brings again.  Sums of longs are exact, so after any number of
batches the result equals ``latest_trends`` over the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.operators.common import check_limit, exact_parts, exact_value, interval, interval_seconds
from trendlens.operators.leaderboard import LEADERBOARD_COLUMNS, per_source_max, rank_order, top_per_source
from trendlens.operators.revisions import REVISION_KEY, dedup_revisions
from trendlens.session import delete_path, list_folders, path_exists
from trendlens.sources.sinks import EPOCH_BITS, _drop_old_versions, _versions

MEASURES = ("mention_count", "sentiment_coarse", "sentiment_fine", "score_coarse", "score_fine")
WINDOWS_SCHEMA = ("keyword string, source string, window_start timestamp, window_end timestamp, "
                  + ", ".join(f"{m} bigint" for m in MEASURES) + ", slot bigint, batch_id bigint")
# Newest window of a source, and what it was in the version before.
MAXIMA_SCHEMA = "source string, max_window_end timestamp, was_window_end timestamp"
TOTALS_SCHEMA = ("keyword string, source string, revisions bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
                 + ", spans array<struct<until: timestamp, since: timestamp>>")


def _slot(ts: Column | str) -> Column:
    return F.floor(F.unix_timestamp(ts) / 60)


def _signed(rows: DataFrame, sign: int, spans: Column) -> DataFrame:
    """Per (keyword, source) the change that ``rows`` make to the totals."""
    return rows.groupBy("keyword", "source").agg(
        (F.lit(sign) * F.count("*")).alias("revisions"), *[(F.lit(sign) * F.sum(m)).alias(m) for m in MEASURES],
        spans.alias("spans"))


class IncrementalLeaderboardSink:
    """Sink that maintains the served leaderboard under ``path`` (read it with
    ``read_leaderboard_snapshot``).

    ``horizon`` and ``dedup`` as in ``latest_trends``.  ``fact_path`` seeds the
    state at the first batch if the fact table has rows already (that one
    batch must be in it then: put the fact sink first).  A replayed batch
    starts from the version before its own and rewrites its own.  Versions
    stay readable for ``keep_for`` after a newer one.
    """

    def __init__(self, path: str, limit: int = 20, dedup: bool = False, horizon: str = "30 minutes",
                 fact_path: str | None = None, keep_for: str = "1 hour"):
        self.path, self.limit, self.dedup = path.rstrip("/"), check_limit(limit), dedup
        self.horizon, self.fact_path = horizon, fact_path
        self.keep_seconds = interval_seconds(keep_for)
        self.target = path

    def next_epoch(self, spark) -> int:
        known = _versions(spark, self.path)
        return (known[-1][0] >> EPOCH_BITS) + 1 if known else 0

    def _before(self, spark, name: str, schema: str, batch_id: int) -> DataFrame | None:
        older = [p for n, p in _versions(spark, f"{self.path}/{name}") if n < batch_id]
        return spark.read.schema(schema).parquet(older[-1]) if older else None

    def _write(self, df: DataFrame, name: str, batch_id: int, schema: str) -> DataFrame:
        path = f"{self.path}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return df.sparkSession.read.schema(schema).parquet(path)

    def bounds(self, maxima: DataFrame) -> DataFrame:
        """(source, since, was_since, was_until): a source's horizon, and the
        one before (NULL for a new source)."""
        back = interval(self.horizon)
        return maxima.select("source", (F.col("max_window_end") - back).alias("since"),
                             (F.col("was_window_end") - back).alias("was_since"),
                             F.col("was_window_end").alias("was_until"), "max_window_end")

    def leaving(self, log: DataFrame, maxima: DataFrame) -> DataFrame:
        """Rows of the log that were within the old bounds and are not within
        the new ones; reads the minutes in between alone."""
        # A filter on the small side is what lets its join prune partitions.
        gone = self.bounds(maxima.filter(F.col("max_window_end") > F.col("was_window_end")))
        slots = F.sequence(_slot("was_since"), F.least(_slot("since"), _slot("was_until")))
        gone = gone.select("source", "was_since", "since", F.explode(slots).alias("slot"))
        rows = log.join(gone, ["source", "slot"]).filter("window_end >= was_since AND window_end < since")
        return self._latest(rows) if self.dedup else rows

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        newest = F.max(F.struct("batch_id", *MEASURES)).alias("m")
        return rows.groupBy(*REVISION_KEY).agg(newest).select(*REVISION_KEY, "m.*")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = self._before(spark, "maxima", MAXIMA_SCHEMA, batch_id)
        if before is None and self.fact_path and path_exists(spark, self.fact_path):
            from trendlens.sources.tables import read_trend_windows

            rows = read_trend_windows(spark, self.fact_path).filter(F.col("batch_id") <= batch_id)
            rows = dedup_revisions(rows.drop("window_date")) if self.dedup else rows
        known = per_source_max(rows).withColumn("was_window_end", F.lit(None).cast("timestamp"))
        if before is not None:
            known = known.unionByName(before.select("source", "max_window_end",
                                                    F.col("max_window_end").alias("was_window_end")))
            known = known.groupBy("source").agg(F.max("max_window_end").alias("max_window_end"),
                                                F.max("was_window_end").alias("was_window_end"))
        maxima = self._write(known.coalesce(1), "maxima", batch_id, MAXIMA_SCHEMA)
        bounds = self.bounds(maxima)

        sentiment, score = exact_parts("avg_sentiment"), exact_parts("trend_score")
        added = (rows.select(*REVISION_KEY, "mention_count", sentiment[0].alias("sentiment_coarse"),
                             sentiment[1].alias("sentiment_fine"), score[0].alias("score_coarse"),
                             score[1].alias("score_fine"), _slot("window_end").alias("slot"))
                 .join(bounds.select("source", "since"), "source").filter("window_end >= since").drop("since"))
        folder = f"{self.path}/windows"
        (added.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch_id").parquet(folder))
        log = spark.read.schema(WINDOWS_SCHEMA).parquet(folder)
        added = log.filter(F.col("batch_id") == batch_id)
        older = log.filter(F.col("batch_id") < batch_id)

        changes = [_signed(added, 1, F.collect_set(F.struct(F.col("window_end").alias("until"),
                                                            F.col("window_start").alias("since"))))]
        totals = self._before(spark, "totals", TOTALS_SCHEMA, batch_id)
        if totals is not None:
            none = F.expr("CAST(array() AS array<struct<until: timestamp, since: timestamp>>)")
            changes += [totals, _signed(self.leaving(older, maxima), -1, F.first(none))]
            if self.dedup:
                again = added.select("slot", *REVISION_KEY).distinct()
                held = older.join(again, ["slot", *REVISION_KEY], "left_semi")
                changes.append(_signed(self._latest(held), -1, F.first(none)))
        merged = changes[0]
        for change in changes[1:]:
            merged = merged.unionByName(change)
        merged = merged.groupBy("keyword", "source").agg(
            *[F.sum(m).alias(m) for m in ("revisions", *MEASURES)],
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")).filter("revisions > 0")
        held = merged.join(bounds.select("source", "since"), "source").withColumn(
            "spans", F.expr("filter(spans, s -> s.until >= since)")).select("keyword", "source", "revisions", *MEASURES,
                                                                             "spans")
        totals = self._write(held, "totals", batch_id, TOTALS_SCHEMA)

        board = totals.select(
            "keyword", "source", "mention_count",
            (exact_value(F.col("sentiment_coarse"), F.col("sentiment_fine")) / F.col("revisions")).alias("avg_sentiment"),
            exact_value(F.col("score_coarse"), F.col("score_fine")).alias("trend_score"),
            F.array_min(F.transform("spans", lambda s: s["since"])).alias("window_start"),
            F.array_max(F.transform("spans", lambda s: s["until"])).alias("window_end"))
        ranked = top_per_source(board, self.limit).select(*LEADERBOARD_COLUMNS)
        (ranked.orderBy(*rank_order(), F.col("source").asc()).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{self.path}/batch_id={batch_id}"))
        for name in ("", "/maxima", "/totals"):
            _drop_old_versions(spark, self.path + name, self.keep_seconds)
        self._drop_left_slots(spark, maxima)

    def _drop_left_slots(self, spark, maxima: DataFrame) -> None:
        """Delete the minutes that every source's horizon has left."""
        first = maxima.agg(F.min(_slot(F.col("max_window_end") - interval(self.horizon)))).first()[0]
        for folder in list_folders(spark, f"{self.path}/windows"):
            name = folder.rsplit("/", 1)[1]
            if first is not None and name.startswith("slot=") and int(name[5:]) < first:
                delete_path(spark, folder)
