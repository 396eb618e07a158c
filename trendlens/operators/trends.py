"""Post enrichment, keyword mentions and event-time windowed trend counts.

All functions work unchanged on batch and streaming DataFrames.

Scale notes
-----------
* ``enrich`` and ``mentions`` are narrow (no shuffle): regex, array
  higher-order functions and ``explode`` run inside the scan's stage.
* ``windowed_trends`` is one hash aggregation on (window, keyword, source).
  Spark aggregates partially before the shuffle, so a keyword that is hot in
  every input partition still sends at most one row per group per task; the
  shuffle carries distinct groups, not mentions.
* ``by_window`` before ``enrich`` is for tables in which a window says most of
  its keywords once, so that a partial aggregation merges little and holds a
  whole split's groups: the posts are shuffled instead of the groups.
* A tumbling window (width == slide) is a plain projection of the event
  time, not an ``Expand``, so rows are not duplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import keywords_col, keywords_pandas_udf, sentiment_col
from trendlens.functions.wordlists import Lexicon
from trendlens.operators.common import exact_avg

DEFAULT_WIDTH = "10 seconds"
DEFAULT_WATERMARK = "1 minute"


def enrich(posts: DataFrame, lexicon: Lexicon | None = None, partitions: int | None = None,
           engine: str = "native", max_keywords: int | None = None) -> DataFrame:
    """Add ``keywords`` (array<string>) and ``sentiment`` (double) from ``text``.

    Sentiment is computed over the keyword array itself, so the text is
    tokenized once per row.  ``engine="native"`` (default) tokenizes with
    built-in regex expressions inside the JVM; ``engine="arrow"`` runs the
    same rules in Python's ``re`` through an Arrow-batched pandas UDF.
    ``max_keywords`` counts only the first so many keywords of a post.

    ``partitions`` deals the posts round-robin over that many tasks first,
    for an input in fewer splits than the cluster has cores; by default the
    scan's own splits are used and nothing is shuffled.
    """
    if engine == "native":
        kw = keywords_col("text", lexicon, max_keywords)
    elif engine == "arrow":
        kw = keywords_pandas_udf(lexicon, max_keywords)(F.col("text"))
    else:
        raise ValueError(f"unknown engine {engine!r}")
    dealt = posts.repartition(partitions) if partitions else posts
    return dealt.withColumn("keywords", kw).withColumn("sentiment", sentiment_col("keywords", lexicon))


def mentions(enriched: DataFrame, keep: tuple[str, ...] = ("id", "source", "event_time")) -> DataFrame:
    """One row per keyword occurrence; a post without keywords disappears.

    A keyword said twice in a post gives two rows, both carrying the post's
    sentiment (so it weighs twice in the window average).

    ``explode_outer`` + a NULL filter instead of ``explode``: for a plain
    explode Catalyst infers ``size(keywords) > 0`` and pushes it below the
    projection, which copies the whole tokenizer into that filter and runs
    it twice per row.
    """
    cols = [F.col(c) for c in keep] + [F.col("sentiment"), F.explode_outer("keywords").alias("keyword")]
    return enriched.select(*cols).filter(F.col("keyword").isNotNull())


# Text (and a little for every post) that one task of ``by_window`` tokenizes
# and counts; its distinct keywords stay in memory.
TASK_BYTES, POST_BYTES = 8 << 20, 10


def start_column(width_seconds: int) -> str:
    """Name of the column in which ``by_window`` keeps a post's window."""
    return f"_start_{width_seconds}s"


def by_window(posts: DataFrame, width_seconds: int = 10) -> DataFrame:
    """``posts`` in ranges of (tumbling window, source), each in window order,
    with the window's start as a further column; posts without a time, which
    lie in no window, are left out.

    Mentions counted by that column need no shuffle of their own: the texts
    are moved before they fall apart into many wide rows, and every task holds
    the counts of about ``TASK_BYTES`` of text instead of a whole input
    split's.  Two scans of the posts find the number and bounds of the ranges.
    """
    spark = posts.sparkSession
    size = posts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(POST_BYTES)).alias("n")).first().n
    ranges = max(spark.sparkContext.defaultParallelism, -(-(size or 0) // TASK_BYTES))
    start = start_column(width_seconds)
    timed = posts.withColumn(start, F.window("event_time", f"{width_seconds} seconds").start)
    return timed.repartitionByRange(ranges, start, "source").sortWithinPartitions(start, "source")


def trend_score_col(mention_count: Column | str = "mention_count",
                    avg_sentiment: Column | str = "avg_sentiment") -> Column:
    m = F.col(mention_count) if isinstance(mention_count, str) else mention_count
    s = F.col(avg_sentiment) if isinstance(avg_sentiment, str) else avg_sentiment
    return m * (F.lit(1.0) + F.abs(s))


def windowed_trends(
    mention_rows: DataFrame,
    width: str = DEFAULT_WIDTH,
    watermark: str | None = None,
    time_col: str = "event_time",
) -> DataFrame:
    """Group mentions by (tumbling ``width`` window, keyword, source).

    Output: ``window`` struct, keyword, source, mention_count (bigint),
    avg_sentiment (double), trend_score (double).  ``watermark`` bounds the
    state of a streaming aggregation (ignored by batch queries).
    """
    df = mention_rows.withWatermark(time_col, watermark) if watermark else mention_rows
    agg = df.groupBy(F.window(time_col, width).alias("window"), "keyword", "source").agg(
        F.count(F.lit(1)).alias("mention_count"),
        exact_avg("sentiment").alias("avg_sentiment"),
    )
    return agg.withColumn("trend_score", trend_score_col())


def flatten_windows(trends: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start`` / ``window_end`` columns, keyword
    rows with a NULL keyword dropped."""
    return trends.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "keyword", "source", "mention_count", "avg_sentiment", "trend_score",
    ).filter(F.col("keyword").isNotNull())


def trends_from_posts(posts: DataFrame, width: str = DEFAULT_WIDTH, lexicon: Lexicon | None = None,
                      max_keywords: int | None = None) -> DataFrame:
    """posts -> enrich -> mentions -> windowed trends, flattened."""
    return flatten_windows(windowed_trends(mentions(enrich(posts, lexicon, max_keywords=max_keywords)), width))
