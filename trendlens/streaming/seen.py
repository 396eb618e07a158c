"""URL dedup with state of its own: a bounded set of seen URLs.

``dedup_by_url_stream`` leaves the state to ``dropDuplicatesWithinWatermark``.
Here each URL is a keyed state holding the time it was first seen and a
timer that evicts it ``remember`` later, so evictions are counted, a URL that
comes back after them is new, and a late sighting is judged by its own
arrival instead of by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trendlens.operators.common import interval_seconds

WITH_URL, WITHOUT_URL = "u", "-"
_OUT = "post string"


def _first_sightings(remember_ms: int):
    """Per URL: the posts that come while it is not remembered."""

    def sift(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()  # an eviction
            return
        if not key[0].startswith(WITH_URL):
            for part in parts:
                yield part[["post"]]
            return
        # Posts of one URL in one micro-batch.
        rows = pd.concat(list(parts)).sort_values(["arrived_ms", "created_at", "id"], kind="stable", na_position="first")
        seen, passed = (state.get[0] if state.exists else None), []
        for arrived, post in zip(rows["arrived_ms"].tolist(), rows["post"].tolist()):
            if seen is None or arrived >= seen + remember_ms:
                seen = arrived
                passed.append(post)
        until = seen + remember_ms
        if until > state.getCurrentWatermarkMs():
            state.update((seen,))
            state.setTimeoutTimestamp(until)
        elif state.exists:
            state.remove()
        if passed:
            yield pd.DataFrame({"post": passed})

    return sift


def dedup_urls_stateful(posts: DataFrame, remember: str = "1 hour", arrived: Column | None = None) -> DataFrame:
    """Streaming posts without those whose URL was first seen less than
    ``remember`` before; later sightings do not prolong that.

    ``arrived`` is a post's time of arrival (default: the micro-batch's
    clock).  Within one batch the earliest arrival of a URL passes, ties go to
    the smaller ``created_at``, then ``id``, as in ``dedup_by_url``.  Posts
    without a URL all pass.  Arrivals may be out of order by ``remember``
    (that is the watermark; the clock never is), so a URL is evicted once the
    latest arrival is ``remember`` past its horizon, and state holds one time
    per URL of the last two.
    """
    columns = posts.columns
    timed = posts.withColumn("_arrived", F.current_timestamp() if arrived is None else arrived)
    timed = timed.withWatermark("_arrived", remember)
    # Posts without a URL are dealt by their ids and keep no state.
    key = F.coalesce(F.concat(F.lit(WITH_URL), F.nullif(F.col("url"), F.lit(""))),
                     F.concat(F.lit(WITHOUT_URL), F.coalesce("id", F.lit(""))))
    keyed = timed.select(key.alias("key"), F.unix_millis("_arrived").alias("arrived_ms"), "_arrived", "created_at", "id",
                         F.to_json(F.struct(*columns)).alias("post"))
    kept = keyed.groupBy("key").applyInPandasWithState(
        _first_sightings(interval_seconds(remember) * 1000), _OUT, "seen long", "append",
        GroupStateTimeout.EventTimeTimeout)
    schema = posts.schema
    return kept.select(F.from_json("post", schema).alias("post")).select("post.*").select(*columns)


def evictions(query: StreamingQuery) -> int:
    """URLs that a query has evicted, over its recent progress reports."""
    return sum(op["numRowsRemoved"] for p in query.recentProgress for op in p["stateOperators"]
               if op["operatorName"] == "applyInPandasWithState" or "GroupsInPandasWithState" in op["operatorName"])
