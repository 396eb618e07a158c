"""Provider payloads -> the common post schema.

Each normalizer takes a DataFrame with one raw JSON payload per row in a
string column (``value``) and returns posts with the wire columns
``id, source, author, text, lang, created_at, url, metadata``.  They are
narrow transformations (parse, filter, project; GDELT also explodes its
article array), valid on batch tables and streams alike.

``as_of`` stands for the poll time the provider adapters stamp on records;
tests pass a fixed value, live jobs leave it to the session clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.ids import post_id_col
from trendlens.functions.timefns import gdelt_date_col, iso_utc_col, sanitize_ts_col
from trendlens.operators.common import as_of_col
from trendlens.schemas import BLUESKY_SCHEMA, GDELT_SCHEMA, HN_ITEM_SCHEMA, METADATA_SCHEMA

# ---------------------------------------------------------------------------
# Provider names, accepted record kind, topic names and the
# story-list limits of the provider adapters.
# ---------------------------------------------------------------------------
BLUESKY, GDELT, HACKERNEWS = "bluesky", "gdelt", "hackernews"
BLUESKY_OPERATION = "create"
BLUESKY_COLLECTION = "app.bsky.feed.post"
SOCIAL_TOPIC = "raw-social-posts"
NEWS_TOPIC = "raw-news-events"
HN_ITEM_URL = "https://news.ycombinator.com/item?id="
HN_LIST_HEAD = 50
HN_FETCH_HEAD = 20
# ---------------------------------------------------------------------------

POST_COLUMNS = ("id", "source", "author", "text", "lang", "created_at", "url", "metadata")


def _nonempty(c: Column) -> Column:
    """Python truthiness of an optional string: not NULL and not ''."""
    return c.isNotNull() & (c != F.lit(""))


def _or_default(c: Column, default: str) -> Column:
    """``x or default`` for an optional string."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def parse_json_once(df: DataFrame, value_col: str, schema, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON column into top-level columns, exactly once per record.

    A filter on fields of a plain ``from_json`` projection is pushed below
    it with the expression substituted, so the JSON would be parsed in the
    filter and again in the projection.  Expanding the struct through a
    generator (``inline`` of a one-element array) keeps later filters above
    it; a malformed record still yields one all-NULL row.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(parsed)))


def _metadata(**fields: Column) -> Column:
    cols = []
    for f in METADATA_SCHEMA.fields:
        v = fields.get(f.name, F.lit(None))
        cols.append(v.cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def normalize_bluesky(raw: DataFrame, as_of=None, value_col: str = "value") -> DataFrame:
    """Jetstream commit events -> posts.

    Kept: non-empty record text, operation ``create`` on collection
    ``app.bsky.feed.post``.  Missing nests behave as empty; a missing ``did``
    becomes ``unknown``; ``created_at`` is the sanitized record time.
    """
    p = parse_json_once(raw, value_col, BLUESKY_SCHEMA)
    text = F.col("commit.record.text")
    keep = (
        _nonempty(text)
        & (F.col("commit.operation") == F.lit(BLUESKY_OPERATION))
        & (F.col("commit.collection") == F.lit(BLUESKY_COLLECTION))
    )
    kept = p.filter(keep).select(
        F.coalesce(F.col("did"), F.lit("unknown")).alias("did"),
        sanitize_ts_col(F.col("commit.record.createdAt"), as_of).alias("created_at"),
        text.alias("text"),
        F.col("commit.collection").alias("collection"),
    )
    return kept.select(
        post_id_col("did", "created_at", "text").alias("id"),
        F.lit(BLUESKY).alias("source"),
        F.col("did").alias("author"),
        "text",
        F.lit("unknown").alias("lang"),
        "created_at",
        F.lit(None).cast("string").alias("url"),
        _metadata(collection=F.col("collection")).alias("metadata"),
    )


def normalize_gdelt(raw: DataFrame, as_of=None, value_col: str = "value") -> DataFrame:
    """Article-list responses -> one post per article with a URL and title."""
    p = raw.select(F.from_json(F.col(value_col).cast("string"), GDELT_SCHEMA).alias("p"))
    a = p.select(F.explode("p.articles").alias("a")).select("a.*")
    kept = a.filter(_nonempty(F.col("url")) & _nonempty(F.col("title")))
    return kept.select(
        post_id_col("url").alias("id"),
        F.lit(GDELT).alias("source"),
        _or_default(F.col("domain"), "gdelt").alias("author"),
        F.col("title").alias("text"),
        _or_default(F.col("language"), "unknown").alias("lang"),
        gdelt_date_col("seendate", as_of).alias("created_at"),
        "url",
        _metadata(domain=F.col("domain"), source_country=F.col("sourcecountry")).alias("metadata"),
    )


def story_head(story_lists: DataFrame, list_col: str = "story_ids", keep=("poll_id",)) -> DataFrame:
    """Story-list responses (``array<bigint>``, newest first) -> the ids to
    fetch: the first 50 of the list, then the first 20 of those, with their
    position."""
    head = F.slice(F.slice(F.col(list_col), 1, HN_LIST_HEAD), 1, HN_FETCH_HEAD)
    return story_lists.select(*keep, F.posexplode(head).alias("rank", "story_id"))


def normalize_hackernews(items: DataFrame, as_of=None, value_col: str = "value",
                         id_col: str = "story_id") -> DataFrame:
    """Item responses (JSON in ``value``, numeric id in ``id_col``) -> posts.

    Items without a title are dropped; the item page is the URL when the
    story has none; ``created_at`` is the poll time.
    """
    p = parse_json_once(items.withColumnRenamed(id_col, "story_id"), value_col, HN_ITEM_SCHEMA, keep=("story_id",))
    kept = p.filter(_nonempty(F.col("title")))
    sid = F.col("story_id").cast("string")
    return kept.select(
        F.concat(F.lit("hn_"), sid).alias("id"),
        F.lit(HACKERNEWS).alias("source"),
        _or_default(F.col("by"), "hn").alias("author"),
        F.col("title").alias("text"),
        F.lit("en").alias("lang"),
        iso_utc_col(as_of_col(as_of)).alias("created_at"),
        F.coalesce(F.nullif(F.col("url"), F.lit("")), F.concat(F.lit(HN_ITEM_URL), sid)).alias("url"),
        _metadata(score=F.col("score"), descendants=F.col("descendants")).alias("metadata"),
    )


def dedup_by_url(posts: DataFrame, order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """First post per URL (smallest ``order``); posts without a URL pass.

    Batch form: ``min`` of a struct led by the order columns, grouped by
    URL (a post without one is a group of its own).  It aggregates map-side
    first, so a URL repeated across a third of the input collapses before
    the shuffle.  For a stream use :func:`dedup_by_url_stream`, which bounds
    its state by arrival time instead of by a fixed-size seen-set.
    """
    cols = [c for c in posts.columns if c != "url"]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in cols]))
    alone = F.when(F.col("url").isNull(), F.monotonically_increasing_id())
    deduped = posts.groupBy("url", alone.alias("_alone")).agg(first.alias("_f"))
    return deduped.select("url", *[F.col(f"_f._v_{c}").alias(c) for c in cols]).select(*posts.columns)


def dedup_by_url_stream(posts: DataFrame, remember: str = "1 hour") -> DataFrame:
    """Streaming URL dedup: a URL seen within the last ``remember`` of
    arrival time is dropped, every other post passes.

    The watermark runs on the arrival time of the micro-batch, not on the
    article's date, so an old article that arrives for the first time is
    never late.  A post without URL is told apart by its id.
    """
    keyed = posts.withColumn("_arrived", F.current_timestamp()).withColumn("_key", F.coalesce("url", "id"))
    return (keyed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["_key"])
            .drop("_arrived", "_key"))


def route_topic_col(source: Column | str = "source") -> Column:
    s = F.col(source) if isinstance(source, str) else source
    return F.when(s == F.lit(BLUESKY), F.lit(SOCIAL_TOPIC)).otherwise(F.lit(NEWS_TOPIC))


def with_topic(posts: DataFrame) -> DataFrame:
    """Add the raw topic a post is published to: social for bluesky, news
    for everything else."""
    return posts.withColumn("topic", route_topic_col())


def select_sources(mode: str) -> list[str]:
    """Comma-separated provider list (case and spaces ignored); ``all`` means
    every provider.  Raises ``ValueError`` when nothing known is selected."""
    wanted = {m.strip() for m in mode.lower().split(",")}
    chosen = [s for s in (BLUESKY, GDELT, HACKERNEWS) if s in wanted or "all" in wanted]
    if not chosen:
        raise ValueError(f"unknown source mode {mode!r}; use a comma list such as 'bluesky,gdelt'")
    return chosen


def union_sources(mode: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Union (by name) of the normalized frames of the selected providers."""
    chosen = select_sources(mode)
    out = None
    for name in chosen:
        df = frames[name].select(*POST_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out
