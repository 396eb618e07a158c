"""Registered queries: one Spark callable and (where SQL can express it) one
DuckDB oracle per operator of the inventory.

Every query reads the parquet tables under ``sf_dir`` (or data Spark derives
from them) in full.  Result columns are normalized the same way on both
sides so the verifier can hash them: timestamps as TIMESTAMP without zone,
doubles rounded to 6 places (summation order differs between engines).

Fixtures (see trendlens.sources.tables and FIXTURES.md):
* ``posts_docs``   one post per document, ten posts per 10-second window
* ``posts_events`` one single-word post per event, 30 days, three sources
* ``trend_windows`` a stored fact table with the per-source maxima, built
  from either by ``fixtures.stored_revisions`` (early + final revision of
  every window, as the stream appends them)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.text import FIRST_KEYWORDS
from trendlens.operators import alerts, dashboard, history, leaderboard, revisions, rollup, trends
from trendlens.plans import oracle_sql as O
from trendlens.sources import fixtures, tables

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters of the registered checks (data-relative, so every
# scale factor gives a non-trivial answer).
AS_OF_DOCS = "2024-01-01 00:15:00"       # posts_docs: 1000 s at sf0.01, 10000 s at sf0.1
HISTORY_KEYWORD = "error"                # a keyword of posts_events (and the negative lexicon)
HISTORY_AS_OF = "2024-01-10 00:00:00"    # the events run from 2024-01-01 to 2024-01-30
HISTORY_HOURS = 48
HORIZON = "2 minutes"                    # of the leaderboard: the documents span 200 s at the smallest scale
ALERT_THRESHOLD, ALERT_MENTIONS = 0.5, 2
SUMMARY_DAY = "2024-01-15"
SUMMARY_CREATED_AT = "2024-02-01 00:15:00"
UPSERT_FROM, UPSERT_TO = "2024-01-10", "2024-01-20"
UPSERT_ABSENT = ("click", "gdelt")       # a key that the new rows of the rewritten days lack


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- fixtures --

def _enriched_docs(spark, sf):
    return trends.enrich(tables.posts_docs(spark, sf))


def _facts_docs(spark, sf):
    return fixtures.stored_revisions(fixtures.window_mentions(tables.posts_docs(spark, sf)))


def _revisions_events(spark, sf):
    return fixtures.stored_revisions(fixtures.window_mentions(tables.posts_events(spark, sf)))[0]


def _leaderboard(spark, sf, dedup=False):
    facts, maxima = _facts_docs(spark, sf)
    return leaderboard.latest_trends(facts, limit=20, horizon=HORIZON, dedup=dedup, per_source=maxima)


def _global(spark, sf):
    facts, maxima = _facts_docs(spark, sf)
    return leaderboard.latest_trends_global(facts, limit=20, per_source=maxima)


# ----------------------------------------------------------------- queries --

def q_keywords(spark, sf):
    e = _enriched_docs(spark, sf)
    return e.select(
        "id",
        F.array_join("keywords", " ").alias("keywords"),
        F.size("keywords").cast("long").alias("n_keywords"),
    )


def q_keywords_first20(spark, sf):
    """The original pipeline's cut: the first 20 keywords of a post, and the
    sentiment over those."""
    e = trends.enrich(tables.posts_docs(spark, sf), max_keywords=FIRST_KEYWORDS)
    return e.select("id", F.array_join("keywords", " ").alias("keywords"), "sentiment")


def q_sentiment(spark, sf):
    return _enriched_docs(spark, sf).select("id", "sentiment")


def q_mentions(spark, sf):
    e = _enriched_docs(spark, sf)
    return e.select("id", "source", "sentiment", F.posexplode("keywords").alias("pos", "keyword")) \
        .withColumn("pos", F.col("pos").cast("long"))


def q_trends_10s(spark, sf):
    return trends.trends_from_posts(tables.posts_docs(spark, sf))


def q_trends_events_1h(spark, sf):
    return trends.trends_from_posts(tables.posts_events(spark, sf), width="1 hour")


def q_trends_5m(spark, sf):
    return trends.trends_from_posts(tables.posts_docs(spark, sf), width="5 minutes")


def q_sentiment_alerts(spark, sf):
    hourly = trends.trends_from_posts(tables.posts_events(spark, sf), width="1 hour")
    return alerts.sentiment_alerts(hourly, ALERT_THRESHOLD, ALERT_MENTIONS)


def q_dedup_revisions(spark, sf):
    return revisions.dedup_revisions(_facts_docs(spark, sf)[0].drop("window_date"))


def q_per_source_max(spark, sf):
    return leaderboard.per_source_max(_facts_docs(spark, sf)[0])


def q_latest_trends(spark, sf):
    return _leaderboard(spark, sf)


def q_latest_trends_dedup(spark, sf):
    return _leaderboard(spark, sf, dedup=True)


def q_latest_trends_global(spark, sf):
    return _global(spark, sf)


def q_top20_count(spark, sf):
    return leaderboard.top_count_per_source(_global(spark, sf))


def q_recent_top(spark, sf):
    return leaderboard.recent_top(_facts_docs(spark, sf)[0], as_of=AS_OF_DOCS)


def q_trend_history(spark, sf):
    return history.trend_history(_revisions_events(spark, sf), HISTORY_KEYWORD, hours=HISTORY_HOURS,
                                 as_of=HISTORY_AS_OF)


def q_daily_summary(spark, sf):
    return rollup.daily_summary(_revisions_events(spark, sf), SUMMARY_DAY, created_at=SUMMARY_CREATED_AT)


def q_daily_backfill(spark, sf):
    return rollup.daily_summary(_revisions_events(spark, sf), None, created_at=SUMMARY_CREATED_AT)


def q_daily_upsert(spark, sf):
    """Existing table: a backfill computed while only the early revisions had
    arrived (those are the even batch ids).  New rows: the full summary of ten
    days but for one keyword of one source, whose old rows must stay.  The
    upsert replaces the new rows' keys and keeps everything else."""
    facts = _revisions_events(spark, sf)
    existing = rollup.daily_summary(facts.filter(F.col("batch_id") % 2 == 0), None, created_at="2024-01-31 00:15:00")
    full = rollup.daily_summary(facts, None, created_at=SUMMARY_CREATED_AT)
    new = full.filter(F.col("summary_date").between(F.lit(UPSERT_FROM).cast("date"),
                                                    F.date_sub(F.lit(UPSERT_TO).cast("date"), 1))
                      & ~((F.col("keyword") == UPSERT_ABSENT[0]) & (F.col("source") == UPSERT_ABSENT[1])))
    return rollup.merge_daily_summary(existing, new)


def q_sentiment_label(spark, sf):
    return dashboard.with_sentiment_label(_leaderboard(spark, sf))


def q_leaderboard_by_source(spark, sf):
    return dashboard.leaderboard_view(_leaderboard(spark, sf), source="src3")


def q_chart_top15(spark, sf):
    return dashboard.chart_top(_leaderboard(spark, sf), source="all")


def q_kpis(spark, sf):
    return dashboard.kpis(_leaderboard(spark, sf), source="all")


REGISTRY: dict[str, QueryFn] = {
    "keywords": q_keywords,
    "keywords_first20": q_keywords_first20,
    "trends_5m": q_trends_5m,
    "sentiment_alerts": q_sentiment_alerts,
    "sentiment": q_sentiment,
    "mentions": q_mentions,
    "trends_10s": q_trends_10s,
    "trends_events_1h": q_trends_events_1h,
    "dedup_revisions": q_dedup_revisions,
    "per_source_max": q_per_source_max,
    "latest_trends": q_latest_trends,
    "latest_trends_dedup": q_latest_trends_dedup,
    "latest_trends_global": q_latest_trends_global,
    "top20_count": q_top20_count,
    "recent_top": q_recent_top,
    "trend_history": q_trend_history,
    "daily_summary": q_daily_summary,
    "daily_backfill": q_daily_backfill,
    "daily_upsert": q_daily_upsert,
    "sentiment_label": q_sentiment_label,
    "leaderboard_by_source": q_leaderboard_by_source,
    "chart_top15": q_chart_top15,
    "kpis": q_kpis,
}


def _all() -> dict[str, QueryFn]:
    from trendlens.plans import catalog_ingest

    return {**REGISTRY, **catalog_ingest.REGISTRY}


def _pinned(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Windows, day boundaries and the zone-less output timestamps are
        # defined in UTC, whatever zone the calling session was built with.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return normalize(fn(spark, sf_dir))

    return run


def queries() -> dict[str, QueryFn]:
    return {name: _pinned(fn) for name, fn in _all().items()}


# ----------------------------------------------------------------- oracles --

def _latest_trends_sql(dedup: bool, limit: int = 20, horizon: str = HORIZON, base: str | None = None,
                       rounded: bool = True) -> str:
    """Oracle of ``latest_trends``: the per-source newest window as a window
    aggregate (the Spark side joins a table of maxima), top-N with
    QUALIFY."""
    base = base or ("deduped" if dedup else "trend_windows")
    r = (lambda c: f"round({c}, 6)") if rounded else (lambda c: c)
    return f"""WITH {O.revisions_cte(O.POSTS_DOCS)}{O.dedup_cte()},
    marked AS (
        SELECT *, max(window_end) OVER (PARTITION BY source) AS newest_in_source FROM {base}),
    per_keyword AS (
        SELECT keyword, source,
               CAST(sum(mention_count) AS BIGINT) AS mention_count,
               avg(avg_sentiment) AS avg_sentiment,
               sum(trend_score) AS trend_score,
               min(window_start) AS window_start, max(window_end) AS window_end
        FROM marked
        WHERE window_end >= newest_in_source - INTERVAL '{horizon}'
        GROUP BY ALL)
    SELECT keyword, source, mention_count, {r('avg_sentiment')} AS avg_sentiment,
           {r('trend_score')} AS trend_score, window_start, window_end
    FROM per_keyword
    QUALIFY row_number() OVER (PARTITION BY source
                               ORDER BY trend_score DESC, mention_count DESC, keyword) <= {limit}"""


def _global_cte(limit: int = 20) -> str:
    """Oracle of ``latest_trends_global`` (rows in ``top``)."""
    return f"""WITH {O.revisions_cte(O.POSTS_DOCS)}{O.dedup_cte()},
    per_keyword AS (
        SELECT keyword, source,
               CAST(sum(mention_count) AS BIGINT) AS mention_count,
               avg(avg_sentiment) AS avg_sentiment,
               sum(trend_score) AS trend_score,
               min(window_start) AS window_start, max(window_end) AS window_end
        FROM deduped
        WHERE window_end >= coalesce((SELECT max(window_end) FROM deduped), now()::TIMESTAMP)
                            - INTERVAL '10 minutes'
        GROUP BY ALL),
    top AS (
        SELECT * FROM per_keyword
        QUALIFY row_number() OVER (PARTITION BY source
                                   ORDER BY trend_score DESC, mention_count DESC, keyword) <= {limit})"""


def _daily_sql(where: str, summary_date: str) -> str:
    return f"""WITH {O.revisions_cte(O.POSTS_EVENTS)},
    selected AS (SELECT * FROM trend_windows WHERE {where}),
    deduped AS {O.latest_revisions_sql('selected')}
    SELECT {summary_date} AS summary_date, keyword, source,
           CAST(sum(mention_count) AS BIGINT) AS total_mentions,
           round(avg(avg_sentiment), 6) AS avg_sentiment,
           round(max(trend_score), 6) AS max_trend_score,
           TIMESTAMP '{SUMMARY_CREATED_AT}' AS created_at
    FROM deduped GROUP BY ALL"""


def _summary_select(src: str, created_at: str) -> str:
    return f"""SELECT CAST(window_end AS DATE) AS summary_date, keyword, source,
               CAST(sum(mention_count) AS BIGINT) AS total_mentions,
               avg(avg_sentiment) AS avg_sentiment,
               max(trend_score) AS max_trend_score,
               TIMESTAMP '{created_at}' AS created_at
        FROM {src} GROUP BY ALL"""


def _dedup_of(src: str) -> str:
    return O.latest_revisions_sql(src)


def _oracles() -> dict[str, str]:
    docs_trends = f"WITH {O.trends_cte(O.POSTS_DOCS)}"
    sql: dict[str, str] = {}
    sql["keywords"] = f"""WITH {O.enriched_cte(O.POSTS_DOCS)}
    SELECT id, array_to_string(keywords, ' ') AS keywords, CAST(len(keywords) AS BIGINT) AS n_keywords
    FROM enriched"""
    sql["keywords_first20"] = f"""WITH {O.enriched_cte(O.POSTS_DOCS, 20)}
    SELECT id, array_to_string(keywords, ' ') AS keywords, round(sentiment, 6) AS sentiment FROM enriched"""
    sql["trends_5m"] = f"WITH {O.trends_cte(O.POSTS_DOCS, 300)}" + """
    SELECT window_start, window_end, keyword, source, mention_count,
           round(avg_sentiment, 6) AS avg_sentiment, round(trend_score, 6) AS trend_score
    FROM trends"""
    sql["sentiment_alerts"] = f"WITH {O.trends_cte(O.POSTS_EVENTS, 3600)}" + """
    SELECT window_start, window_end, keyword, source, mention_count,
           round(avg_sentiment, 6) AS avg_sentiment, round(trend_score, 6) AS trend_score,
           CASE WHEN avg_sentiment > 0 THEN 'positive' ELSE 'negative' END AS level
    FROM trends WHERE abs(avg_sentiment) >= 0.5 AND mention_count >= 2"""
    sql["sentiment"] = f"""WITH {O.enriched_cte(O.POSTS_DOCS)}
    SELECT id, round(sentiment, 6) AS sentiment FROM enriched"""
    sql["mentions"] = f"""WITH {O.enriched_cte(O.POSTS_DOCS)}
    SELECT id, source, round(sentiment, 6) AS sentiment,
           CAST(unnest(range(len(keywords))) AS BIGINT) AS pos, unnest(keywords) AS keyword
    FROM enriched"""
    sql["trends_10s"] = docs_trends + """
    SELECT window_start, window_end, keyword, source, mention_count,
           round(avg_sentiment, 6) AS avg_sentiment, round(trend_score, 6) AS trend_score
    FROM trends"""
    sql["trends_events_1h"] = f"WITH {O.trends_cte(O.POSTS_EVENTS, 3600)}" + """
    SELECT window_start, window_end, keyword, source, mention_count,
           round(avg_sentiment, 6) AS avg_sentiment, round(trend_score, 6) AS trend_score
    FROM trends"""
    revisions_docs = f"WITH {O.revisions_cte(O.POSTS_DOCS)}"
    sql["dedup_revisions"] = revisions_docs + O.dedup_cte() + """
    SELECT id, batch_id, window_start, window_end, keyword, source, mention_count,
           round(avg_sentiment, 6) AS avg_sentiment, round(trend_score, 6) AS trend_score
    FROM deduped"""
    sql["per_source_max"] = revisions_docs + """
    SELECT source, max(window_end) AS max_window_end FROM trend_windows GROUP BY source"""
    sql["latest_trends"] = _latest_trends_sql(dedup=False)
    sql["latest_trends_dedup"] = _latest_trends_sql(dedup=True)
    sql["latest_trends_global"] = _global_cte() + """
    SELECT keyword, source, mention_count, round(avg_sentiment, 6) AS avg_sentiment,
           round(trend_score, 6) AS trend_score, window_start, window_end
    FROM top"""
    sql["top20_count"] = _global_cte() + """
    SELECT source, count(*) AS n FROM top GROUP BY source"""
    sql["recent_top"] = revisions_docs + f"""
    SELECT keyword, source, CAST(sum(mention_count) AS BIGINT) AS mentions,
           round(sum(trend_score), 6) AS score
    FROM trend_windows
    WHERE window_end BETWEEN TIMESTAMP '{AS_OF_DOCS}' - INTERVAL '10 minutes' AND TIMESTAMP '{AS_OF_DOCS}'
    GROUP BY keyword, source
    ORDER BY sum(trend_score) DESC, mentions DESC, keyword, source
    LIMIT 20"""
    sql["trend_history"] = f"""WITH {O.revisions_cte(O.POSTS_EVENTS)},
    deduped AS {_dedup_of(f"(SELECT * FROM trend_windows WHERE keyword = '{HISTORY_KEYWORD}' "
                          f"AND window_end BETWEEN TIMESTAMP '{HISTORY_AS_OF}' - INTERVAL '{HISTORY_HOURS} hours' "
                          f"AND TIMESTAMP '{HISTORY_AS_OF}')")}
    SELECT {O.bucket_sql('window_end', 10)} AS bucket, keyword, source,
           CAST(sum(mention_count) AS BIGINT) AS mention_count,
           round(avg(avg_sentiment), 6) AS avg_sentiment,
           round(sum(trend_score), 6) AS trend_score
    FROM deduped GROUP BY ALL ORDER BY bucket"""
    sql["daily_summary"] = _daily_sql(
        f"window_end >= DATE '{SUMMARY_DAY}' AND window_end < DATE '{SUMMARY_DAY}' + INTERVAL '1 day'",
        f"DATE '{SUMMARY_DAY}'")
    sql["daily_backfill"] = f"""WITH {O.revisions_cte(O.POSTS_EVENTS)},
    s AS ({_summary_select(_dedup_of('trend_windows'), SUMMARY_CREATED_AT)})
    SELECT summary_date, keyword, source, total_mentions, round(avg_sentiment, 6) AS avg_sentiment,
           round(max_trend_score, 6) AS max_trend_score, created_at FROM s"""
    sql["daily_upsert"] = f"""WITH {O.revisions_cte(O.POSTS_EVENTS)},
    existing AS ({_summary_select(_dedup_of('early_windows'), '2024-01-31 00:15:00')}),
    full_summary AS ({_summary_select(_dedup_of('trend_windows'), SUMMARY_CREATED_AT)}),
    new AS (SELECT * FROM full_summary
            WHERE summary_date >= DATE '{UPSERT_FROM}' AND summary_date < DATE '{UPSERT_TO}'
              AND NOT (keyword = 'click' AND source = 'gdelt')),
    merged AS (
        SELECT * FROM existing e WHERE NOT EXISTS (
            SELECT 1 FROM new n WHERE n.summary_date = e.summary_date
              AND n.keyword = e.keyword AND n.source = e.source)
        UNION ALL SELECT * FROM new)
    SELECT summary_date, keyword, source, total_mentions, round(avg_sentiment, 6) AS avg_sentiment,
           round(max_trend_score, 6) AS max_trend_score, created_at FROM merged"""
    lb = _latest_trends_sql(dedup=False)
    sql["sentiment_label"] = f"""WITH lb AS ({lb})
    SELECT *, CASE WHEN avg_sentiment > 0.04 THEN 'Positive'
                   WHEN avg_sentiment < -0.04 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
    FROM lb"""
    sql["leaderboard_by_source"] = f"""WITH lb AS ({lb})
    SELECT * FROM lb WHERE source = 'src3'
    ORDER BY trend_score DESC, mention_count DESC, keyword, source LIMIT 20"""
    sql["chart_top15"] = f"""WITH lb AS ({lb}),
    ordered AS (SELECT *, row_number() OVER (ORDER BY trend_score DESC, mention_count DESC,
                                                      keyword, source) AS rank FROM lb)
    SELECT CAST(rank AS BIGINT) AS rank, keyword AS name, source, round(trend_score, 1) AS score,
           trend_score
    FROM ordered WHERE rank <= 15"""
    sql["kpis"] = f"""WITH lb AS ({lb})
    SELECT CAST(coalesce(sum(mention_count), 0) AS BIGINT) AS total_volume,
           coalesce(arg_min(keyword, (-trend_score, -mention_count, keyword, source)), '---') AS top_keyword,
           coalesce(arg_min(source, (-trend_score, -mention_count, keyword, source)), '---') AS top_source
    FROM lb"""
    return sql


def oracle_sql() -> dict[str, str]:
    from trendlens.plans import catalog_ingest

    return {**_oracles(), **catalog_ingest.oracle_sql()}
