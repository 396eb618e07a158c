"""Revision handling for the ``trend_windows`` fact table.

The trend stream runs in update mode and its sink appends, so every trigger
re-emits each window group that changed: the table keeps several revisions
per (window_start, window_end, keyword, source).  The latest revision is the
one with the highest ``(batch_id, id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REVISION_KEY = ("window_start", "window_end", "keyword", "source")
_ORDER = ("batch_id", "id")
# The keywords of a window are spread over so many tasks.
KEYWORD_PARTS = 16


def own_method(tw: DataFrame) -> str:
    """``by_batch`` for the parquet sink's table (it has ``window_date``),
    ``aggregate`` for any other."""
    return "by_batch" if "window_date" in tw.columns else "aggregate"


def dedup_revisions(tw: DataFrame, method: str = "aggregate") -> DataFrame:
    """Keep the latest revision of every window group.

    ``aggregate`` (default): ``max`` of a struct led by (batch_id, id), grouped
    by the revision key.  A struct has no fixed width, so the aggregation
    sorts: it does so once, after the shuffle (a partial one before it sorts
    whole input splits, which spill).  Rows are shuffled by window, source and
    a part of the keywords, so that rows of one window lie side by side and
    compress, and a window with many keywords is not one task's.

    ``by_batch``: the same for tables in which a batch holds a window group
    once, as the parquet sink leaves them (update mode emits a group once per
    batch, a replay overwrites its partition).  ``batch_id`` alone orders the
    revisions then, all buffers have a fixed width, and the aggregation hashes
    where the struct form has to sort.

    ``row_number``: the SQL formulation (ROW_NUMBER ... = 1), kept as a test
    twin; it shuffles and sorts every revision row.
    """
    payload = [c for c in tw.columns if c not in REVISION_KEY and c not in _ORDER]
    if method == "row_number":
        w = Window.partitionBy(*REVISION_KEY).orderBy(F.col("batch_id").desc(), F.col("id").desc())
        return tw.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if method == "by_batch":
        kept = [c for c in tw.columns if c not in REVISION_KEY and c != "batch_id"]
        out = tw.groupBy(*REVISION_KEY).agg(F.max("batch_id").alias("batch_id"),
                                            *[F.max_by(c, "batch_id").alias(c) for c in kept])
        return out.select(*tw.columns)
    if method != "aggregate":
        raise ValueError(f"unknown dedup method {method!r}")
    latest = F.max(F.struct(*_ORDER, *payload)).alias("_latest")
    part = F.pmod(F.hash("keyword"), F.lit(KEYWORD_PARTS))
    dealt = tw.withColumn("_part", part).repartition("window_start", "window_end", "source", "_part")
    out = dealt.groupBy(*REVISION_KEY, "_part").agg(latest)
    return out.select(*REVISION_KEY, *[F.col(f"_latest.{c}").alias(c) for c in (*_ORDER, *payload)]).select(
        *tw.columns
    )
