"""Sinks, payloads, the summary upsert and parameter validation."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from trendlens.operators.common import check_hours, check_limit
from trendlens.operators.rollup import merge_daily_summary, write_daily_summary
from trendlens.sources.normalize import select_sources
from trendlens.sources.posts import kafka_options, parse_posts, post_payload
from trendlens.sources.sinks import JdbcTrendSink, history_json, leaderboard_json, trend_payload, trend_rows


def _batch(spark):
    return spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:00:10", "alpha", "bluesky", 3, -0.25, 3.75),
         ("2024-01-01 00:00:00", "2024-01-01 00:00:10", None, "gdelt", 1, 0.0, 1.0)],
        "s string, e string, keyword string, source string, mention_count long, avg_sentiment double, "
        "trend_score double",
    ).select(F.struct(F.to_timestamp("s").alias("start"), F.to_timestamp("e").alias("end")).alias("window"),
             "keyword", "source", "mention_count", "avg_sentiment", "trend_score")


def test_trend_rows_and_payload(spark):
    rows = trend_rows(_batch(spark), 4, created_at="2024-01-01 00:00:12")
    assert rows.count() == 1  # NULL keyword dropped
    rec = trend_payload(rows).first()
    assert rec.key == "alpha"
    v = json.loads(rec.value)
    assert list(v) == ["batch_id", "window_start", "window_end", "keyword", "source", "mention_count",
                       "avg_sentiment", "trend_score", "created_at"]
    assert v["batch_id"] == 4 and v["mention_count"] == 3 and v["trend_score"] == 3.75


def test_leaderboard_and_history_json(spark):
    lb = spark.createDataFrame(
        [("alpha", "bluesky", 3, 0.5, 4.5, dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 10, 5))],
        "keyword string, source string, mention_count long, avg_sentiment double, trend_score double, "
        "window_start timestamp, window_end timestamp")
    v = json.loads(leaderboard_json(lb).first().json)
    assert v == {"keyword": "alpha", "source": "bluesky", "mention_count": 3, "avg_sentiment": 0.5,
                 "trend_score": 4.5, "window_start": "2024-01-01T00:00:00+00:00",
                 "window_end": "2024-01-01T00:00:10.000005+00:00"}
    h = lb.select(F.col("window_end").alias("bucket"), "keyword", "source", "mention_count",
                  "avg_sentiment", "trend_score")
    assert json.loads(history_json(h).first().json)["bucket"] == "2024-01-01T00:00:10.000005+00:00"


def test_post_payload_roundtrip(spark):
    posts = spark.createDataFrame(
        [("i1", "bluesky", "did:x", "Ünïcode \"quoted\"\nline", "unknown", "2024-01-01T00:00:01Z", None)],
        "id string, source string, author string, text string, lang string, created_at string, url string")
    rec = post_payload(posts).first()
    assert rec.key == "i1" and "Ünïcode" in rec.value  # non-ASCII kept verbatim
    back = parse_posts(post_payload(posts)).first()
    assert back.text == "Ünïcode \"quoted\"\nline" and back.event_time == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert back.created_at_utc == "2024-01-01T00:00:01+00:00"


def test_parse_posts_bad_json(spark):
    raw = spark.createDataFrame([("{not json",), ('{"id": "a", "text": "hello world"}',)], "value string")
    rows = parse_posts(raw, event_time_fallback="2024-05-05 00:00:00").orderBy("id").collect()
    assert rows[0].id is None and rows[0].source == "unknown"
    assert rows[1].event_time == dt.datetime(2024, 5, 5)


def test_jdbc_sink_embedded_derby(spark, workdir):
    url = f"jdbc:derby:{os.path.join(workdir, 'db')};create=true"
    rows = trend_rows(_batch(spark), 1, created_at="2024-01-01 00:00:12")
    sink = JdbcTrendSink(url, "TREND_WINDOWS", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    sink(rows, 1)
    sink(rows, 1)  # at-least-once replay appends again
    back = spark.read.jdbc(url, "TREND_WINDOWS", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert back.count() == 2
    assert {c.lower() for c in back.columns} >= {"batch_id", "keyword", "mention_count", "created_at"}
    assert back.select(back.columns[3]).first()[0] == "alpha"


def test_kafka_options():
    o = kafka_options("broker:9092")
    assert o["subscribe"] == "raw-social-posts,raw-news-events"
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"


SUMMARY_SCHEMA = ("summary_date date, keyword string, source string, total_mentions long, "
                  "avg_sentiment double, max_trend_score double, created_at timestamp")


def _summary(spark, rows):
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def test_merge_daily_summary(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    t = dt.datetime(2024, 1, 3)
    existing = _summary(spark, [(d1, "a", "s", 1, 0.0, 1.0, t), (d1, "b", "s", 5, 0.0, 5.0, t),
                                (d2, "a", "s", 9, 0.0, 9.0, t)])
    new = _summary(spark, [(d1, "a", "s", 2, 0.5, 3.0, t), (d1, "c", "s", 1, 0.0, 1.0, t)])
    got = {(r.summary_date, r.keyword): r.total_mentions for r in merge_daily_summary(existing, new).collect()}
    assert got == {(d1, "a"): 2, (d1, "b"): 5, (d1, "c"): 1, (d2, "a"): 9}


def test_write_daily_summary_idempotent(spark, workdir):
    path = os.path.join(workdir, "summary")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    t = dt.datetime(2024, 1, 3)
    write_daily_summary(spark, _summary(spark, [(d1, "a", "s", 1, 0.0, 1.0, t), (d2, "b", "s", 4, 0.0, 4.0, t)]), path)
    new = _summary(spark, [(d1, "a", "s", 7, 0.0, 7.0, t), (d1, "z", "s", 1, 0.0, 1.0, t)])
    write_daily_summary(spark, new, path)
    write_daily_summary(spark, new, path)  # rerun: same result
    got = {(r.summary_date, r.keyword): r.total_mentions for r in spark.read.parquet(path).collect()}
    assert got == {(d1, "a"): 7, (d1, "z"): 1, (d2, "b"): 4}


def test_summary_upsert_raises_read_errors(spark, workdir):
    """An unreadable file is no missing table: the upsert fails and the rows
    that were there stay."""
    path = os.path.join(workdir, "summary")
    d1, t = dt.date(2024, 1, 1), dt.datetime(2024, 1, 3)
    write_daily_summary(spark, _summary(spark, [(d1, "a", "s", 1, 0.0, 1.0, t), (d1, "keep", "s", 2, 0.0, 1.0, t)]),
                        path)
    before = {r.keyword for r in spark.read.parquet(path).collect()}
    bad = os.path.join(path, "summary_date=2024-01-01", "part-bad.snappy.parquet")
    with open(bad, "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception):
        write_daily_summary(spark, _summary(spark, [(d1, "a", "s", 9, 0.0, 9.0, t)]), path)
    os.remove(bad)
    assert {r.keyword for r in spark.read.parquet(path).collect()} == before == {"a", "keep"}


def test_summary_upsert_leaves_no_scratch_and_no_setting(spark, workdir):
    from trendlens.session import checkpoint_dir

    d1, t = dt.date(2024, 1, 1), dt.datetime(2024, 1, 3)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    held = set(os.listdir(checkpoint_dir(spark)))  # the folder may be shared
    write_daily_summary(spark, _summary(spark, [(d1, "a", "s", 1, 0.0, 1.0, t)]), os.path.join(workdir, "summary"))
    assert set(os.listdir(checkpoint_dir(spark))) == held
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_post_errors(spark):
    from trendlens.sources.posts import post_errors

    rows = ['{"id":"1","text":"fine"}', '{"id":"2","te', "", None, '{"text":"no id"}', '{"id":"3","text":""}', "[1]"]
    got = {r.value: r.reason for r in post_errors(spark.createDataFrame([(v,) for v in rows], "value string")).collect()}
    assert got == {rows[1]: "malformed", "": "empty", None: "empty", rows[4]: "no id", rows[5]: "no text",
                   "[1]": "malformed"}


def test_hackernews_reads_every_item(spark):
    """More items than the list heads of the adapters hold: none is cut."""
    from trendlens.sources.normalize import normalize_hackernews

    items = spark.createDataFrame([(i, json.dumps({"title": f"title {i}"})) for i in range(30)],
                                  "story_id long, value string")
    assert normalize_hackernews(items, as_of="2024-01-01 00:00:00").count() == 30


def test_story_head_cuts_long_lists(spark):
    from trendlens.sources.normalize import story_head

    lists = spark.createDataFrame([(1, list(range(100, 0, -1)))], "poll_id long, story_ids array<long>")
    assert [r.story_id for r in story_head(lists).orderBy("rank").collect()] == list(range(100, 80, -1))


def test_url_dedup_passes_posts_without_url(spark):
    from trendlens.sources.normalize import dedup_by_url

    posts = spark.createDataFrame([("1", "u", "2024-01-02"), ("2", "u", "2024-01-01"), ("3", None, "2024-01-01"),
                                   ("3", None, "2024-01-01")], "id string, url string, created_at string")
    assert sorted((r.id, r.url) for r in dedup_by_url(posts).collect()) == [("2", "u"), ("3", None), ("3", None)]


def test_parameter_bounds():
    assert check_limit(1) == 1 and check_limit(100) == 100
    for bad in (0, 101, "20", 2.5):
        with pytest.raises(ValueError):
            check_limit(bad)
    assert check_hours(72) == 72
    with pytest.raises(ValueError):
        check_hours(73)


def test_select_sources():
    assert select_sources(" Bluesky , gdelt") == ["bluesky", "gdelt"]
    assert select_sources("all") == ["bluesky", "gdelt", "hackernews"]
    with pytest.raises(ValueError):
        select_sources("twitter")


def test_timestamp_strings(spark):
    """Shapes that parse, and shapes that fall back (FIXTURES §5)."""
    from trendlens.functions.timefns import event_time_col, parse_ts_col

    good = {"2026-06-07T05:01:43.144321+00:00": dt.datetime(2026, 6, 7, 5, 1, 43, 144321),
            "2026-06-07T05:01:43Z": dt.datetime(2026, 6, 7, 5, 1, 43),
            "2026-06-07": dt.datetime(2026, 6, 7)}
    bad = ["20260607T044500+00:00", "abc--T::+00:00", "garbage", ""]
    df = spark.createDataFrame([(s,) for s in [*good, *bad]] + [(None,)], "s string")
    got = {r.s: (r.t, r.e) for r in df.select("s", parse_ts_col("s").alias("t"),
                                              event_time_col("s", "2030-01-01 00:00:00").alias("e")).collect()}
    for s, expect in good.items():
        assert got[s] == (expect, expect)
    for s in [*bad, None]:
        assert got[s] == (None, dt.datetime(2030, 1, 1))


def test_sanitize_and_gdelt_date(spark):
    from trendlens.functions.timefns import gdelt_date_col, sanitize_ts_col

    as_of = "2026-06-07 06:00:00"
    rows = [("2026-06-07T05:01:43Z",), ("20260607T044500Z",), ("2020-01-01T00:00:00Z",), ("nonsense",),
            ("  2026-06-07T05:01:43+00:00 ",), (None,), ("",)]
    df = spark.createDataFrame(rows, "s string").select(
        "s", sanitize_ts_col("s", as_of).alias("z"), gdelt_date_col("s", as_of).alias("g"))
    got = {r.s: (r.z, r.g) for r in df.collect()}
    now = "2026-06-07T06:00:00+00:00"
    assert got["2026-06-07T05:01:43Z"] == ("2026-06-07T05:01:43Z", "2026-06-07T05:01:43Z")
    assert got["20260607T044500Z"] == ("20260607T044500Z", "2026-06-07T04:45:00Z")
    assert got["2020-01-01T00:00:00Z"][0] == now           # older than a year
    assert got["nonsense"] == (now, "nons-en-seT::Z")       # positional rebuild of garbage
    assert got["  2026-06-07T05:01:43+00:00 "][0] == "2026-06-07T05:01:43+00:00"  # trimmed original kept
    assert got[None] == (now, now) and got[""] == (now, now)


def test_dedup_formulations_agree(spark):
    from conftest import SF_SMALL
    from trendlens.operators.revisions import dedup_revisions
    from trendlens.operators.trends import enrich, mentions, trends_from_posts
    from trendlens.sources.fixtures import simulate_revisions
    from trendlens.sources.tables import posts_docs

    tw = simulate_revisions(mentions(enrich(posts_docs(spark, SF_SMALL))))
    a = dedup_revisions(tw, "aggregate")
    b = dedup_revisions(tw, "row_number")
    c = dedup_revisions(tw.dropDuplicates(["window_start", "window_end", "keyword", "source", "batch_id"]), "by_batch")
    assert c.columns == tw.columns and c.count() == b.count()
    assert c.select("keyword", "batch_id").exceptAll(b.select("keyword", "batch_id")).count() == 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # and the latest revisions are exactly the batch aggregate
    batch = trends_from_posts(posts_docs(spark, SF_SMALL)).select("window_start", "keyword", "source",
                                                                   "mention_count")
    assert a.select(*batch.columns).exceptAll(batch).count() == 0 and a.count() == batch.count()


def test_serving_over_jdbc_table(spark, workdir):
    """Write revisions through the JDBC sink, read them back in parallel
    ranges, and serve the leaderboard from the database table."""
    from trendlens.operators.leaderboard import latest_trends
    from trendlens.sources.tables import read_trend_windows_jdbc

    url = f"jdbc:derby:{os.path.join(workdir, 'db2')};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = trend_rows(_batch(spark), 3, created_at="2024-01-01 00:00:12").withColumn("id", F.lit(1).cast("long"))
    JdbcTrendSink(url, "TW", props)(rows, 3)
    tw = read_trend_windows_jdbc(spark, url, "TW", props, num_partitions=2, id_bounds=(0, 10))
    tw = tw.toDF(*[c.lower() for c in tw.columns])
    lb = latest_trends(tw, 20).collect()
    assert [(r.keyword, r.mention_count) for r in lb] == [("alpha", 3)]


def test_interval_validation(spark):
    from trendlens.operators.common import interval

    assert spark.range(1).select((F.lit("2024-01-01 00:30:00").cast("timestamp") - interval("30 minutes"))
                                 .alias("t")).first().t == dt.datetime(2024, 1, 1)
    for bad in ("30 minutes) OR (1=1", "thirty minutes", "5 weeks"):
        with pytest.raises(ValueError):
            interval(bad)
    with pytest.raises(ValueError):
        check_limit(True)
