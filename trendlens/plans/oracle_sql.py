"""SQL building blocks for the DuckDB oracles of the registered queries.

The oracle is an independent formulation of each query in plain SQL over the
same parquet tables; it is compared with the Spark result by the verifier.
DuckDB regexes are RE2 (no ``(?U)`` flag; ``\\w`` is ASCII), which agrees with
the Unicode-aware Spark expression on every test text checked
(tests/test_text.py).  Replacement needs the ``'g'`` flag in DuckDB.
"""

from __future__ import annotations

# Fixed values of the oracles, stated here on their own so that a wrong
# pattern or word in the package does not pass on both sides.
CLEANING = (
    r"https?://\S+",
    r"\b[\w-]+\.[\w.-]+\b",
    r"\b[\w.-]+@[\w.-]+\b",
    r"\b(?:com|org|net|edu|gov|io|co|uk|us|au|ca|de|fr|info|biz|me|tv)\b",
)
TOKEN = "#?([a-z][a-z0-9_]{3,})"
STOP = """
    a about after all also an and are as at be because but by can for from has have i if in into is it its new no not
    of on only or our over than that the their there this to today was we what when which with you your will
    http https rt get got just like make know think see one good great well more much even now some still time day way
    people would could should want need take give back come done real post social media really actually going been
    being they them these those
    com org net edu gov mil io co uk us au ca de fr www html htm php asp json xml pdf png jpg jpeg gif css js svg amp
    via says said according
""".split()
UP = """good great growth gain gains improve improved strong win wins launch fast success positive best safe secure
    stable""".split()
DOWN = """bad bug bugs crash down fail failed issue issues loss risk slow negative worse worst attack outage
    error""".split()


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


def keywords_sql(text: str, first: int | None = None) -> str:
    expr = f"lower({text})"
    for pattern in CLEANING:
        expr = f"regexp_replace({expr}, '{pattern}', ' ', 'g')"
    kept = (f"list_filter(regexp_extract_all({expr}, '{TOKEN}', 1), "
            f"lambda t: NOT list_contains({_sql_list(STOP)}, t))")
    return f"coalesce({kept if first is None else f'list_slice({kept}, 1, {first})'}, []::VARCHAR[])"


def sentiment_sql(keywords: str) -> str:
    up = f"len(list_filter({keywords}, lambda t: list_contains({_sql_list(UP)}, t)))"
    down = f"len(list_filter({keywords}, lambda t: list_contains({_sql_list(DOWN)}, t)))"
    return f"CAST(({up} - {down}) AS DOUBLE) / greatest(len({keywords}), 1)"


# Post fixtures (see trendlens.sources.tables).
POSTS_DOCS = """
    SELECT CAST(doc_id AS VARCHAR) AS id, source, 'd' || CAST(doc_id AS VARCHAR) AS author,
           text, lang, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS event_time
    FROM documents
"""

POSTS_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE user_id % 3 WHEN 0 THEN 'bluesky' WHEN 1 THEN 'gdelt' ELSE 'hackernews' END AS source,
           'u' || CAST(user_id AS VARCHAR) AS author, event_type AS text, 'en' AS lang,
           CAST(ts AS TIMESTAMP) AS event_time
    FROM events
"""


def bucket_sql(ts: str, seconds: int) -> str:
    """Start of the ``seconds``-wide epoch-aligned bucket holding ``ts``."""
    return (f"(TIMESTAMP '1970-01-01 00:00:00' + "
            f"to_microseconds(CAST(floor(epoch_us({ts}) / {seconds * 1_000_000}) AS BIGINT) * {seconds * 1_000_000}))")


def enriched_cte(posts_sql: str, first: int | None = None) -> str:
    return f"""
    posts AS ({posts_sql}),
    kw AS (SELECT *, {keywords_sql('text', first)} AS keywords FROM posts),
    enriched AS (SELECT *, {sentiment_sql('keywords')} AS sentiment FROM kw)"""


def mentions_cte(posts_sql: str) -> str:
    return enriched_cte(posts_sql) + """,
    mentions AS (SELECT id, source, event_time, sentiment, unnest(keywords) AS keyword FROM enriched)"""


def trends_cte(posts_sql: str, seconds: int = 10) -> str:
    return mentions_cte(posts_sql) + f""",
    trends AS (
        SELECT {bucket_sql('event_time', seconds)} AS window_start,
               {bucket_sql('event_time', seconds)} + to_seconds({seconds}) AS window_end,
               keyword, source,
               CAST(count(*) AS BIGINT) AS mention_count,
               avg(sentiment) AS avg_sentiment,
               count(*) * (1.0 + abs(avg(sentiment))) AS trend_score
        FROM mentions GROUP BY ALL)"""


def revisions_cte(posts_sql: str, seconds: int = 10) -> str:
    """Two-trigger revision table: see trendlens.sources.fixtures.simulate_revisions."""
    half = seconds * 1_000_000 // 2
    return mentions_cte(posts_sql) + f""",
    tagged AS (
        SELECT *, {bucket_sql('event_time', seconds)} AS window_start,
               (epoch_us(event_time) - epoch_us({bucket_sql('event_time', seconds)})) < {half} AS early
        FROM mentions),
    grouped AS (
        SELECT window_start, keyword, source,
               count(*) AS n_all, avg(sentiment) AS s_all,
               count(*) FILTER (WHERE early) AS n_early,
               avg(sentiment) FILTER (WHERE early) AS s_early
        FROM tagged GROUP BY ALL),
    early_windows AS (
        SELECT (epoch_us(window_start) // {seconds * 1_000_000}) * 2 AS id,
               (epoch_us(window_start) // {seconds * 1_000_000}) * 2 AS batch_id,
               window_start, window_start + to_seconds({seconds}) AS window_end, keyword, source,
               CAST(n_early AS BIGINT) AS mention_count, s_early AS avg_sentiment,
               n_early * (1.0 + abs(s_early)) AS trend_score
        FROM grouped WHERE n_early > 0),
    final_windows AS (
        SELECT (epoch_us(window_start) // {seconds * 1_000_000}) * 2 + 1 AS id,
               (epoch_us(window_start) // {seconds * 1_000_000}) * 2 + 1 AS batch_id,
               window_start, window_start + to_seconds({seconds}) AS window_end, keyword, source,
               CAST(n_all AS BIGINT) AS mention_count, s_all AS avg_sentiment,
               n_all * (1.0 + abs(s_all)) AS trend_score
        FROM grouped),
    trend_windows AS (SELECT * FROM early_windows UNION ALL SELECT * FROM final_windows)"""


def latest_revisions_sql(src: str) -> str:
    """Latest revision per window group of the relation ``src``."""
    return f"""(SELECT * FROM {src}
        QUALIFY row_number() OVER (PARTITION BY window_start, window_end, keyword, source
                                   ORDER BY batch_id DESC, id DESC) = 1)"""


def dedup_cte() -> str:
    return f""",
    deduped AS {latest_revisions_sql('trend_windows')}"""
