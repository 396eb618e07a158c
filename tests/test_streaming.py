"""Structured Streaming: late data, batch/stream parity, restart, archive."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trendlens.operators.revisions import dedup_revisions
from trendlens.operators.trends import trends_from_posts
from trendlens.sources.posts import file_post_stream, post_payload
from trendlens.sources.sinks import ParquetTrendSink, TrendBatchWriter
from trendlens.sources.tables import posts_docs
from trendlens.streaming.job import run_archive_stream, run_trend_stream


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, batch in enumerate(batches):
        p = os.path.join(folder, f"b{i:03d}.json")
        with open(p, "w") as f:
            for sec, text in batch:
                f.write(json.dumps({"id": f"{i}-{sec}", "source": "bluesky", "text": text,
                                    "created_at": f"2024-01-01T00:{sec // 60:02d}:{sec % 60:02d}Z"}) + "\n")
        os.utime(p, (1000 + i, 1000 + i))


def _run(spark, src, fact, ckpt, files_per_trigger=1):
    raw = file_post_stream(spark, src, max_files_per_trigger=files_per_trigger)
    q = run_trend_stream(spark, raw, [ParquetTrendSink(fact)], checkpoint=ckpt, available_now=True)
    q.awaitTermination(180)
    assert q.exception() is None
    return q


LATE_BATCHES = [
    [(1, "alpha alpha crash"), (9, "alpha")],
    [(5, "alpha"), (200, "omega")],
    [(3, "alpha"), (205, "omega")],
    [(4, "alpha"), (206, "omega")],
    [(2, "alpha"), (145, "fresh")],
]


def test_revisions_and_late_data(spark, workdir):
    src, fact = os.path.join(workdir, "in"), os.path.join(workdir, "fact")
    _write_batches(src, LATE_BATCHES)
    _run(spark, src, fact, os.path.join(workdir, "ckpt"))
    rows = {(r.batch_id, r.keyword): r.mention_count
            for r in spark.read.parquet(fact).select("batch_id", "keyword", "mention_count").collect()}
    assert rows[(0, "alpha")] == 3 and rows[(0, "crash")] == 1
    assert rows[(1, "alpha")] == 4                      # update mode re-emits the revised window
    assert rows[(2, "alpha")] == 5                      # dropping lags one batch behind the watermark jump
    assert (3, "alpha") not in rows and rows[(3, "omega")] == 3
    assert (4, "alpha") not in rows and rows[(4, "fresh")] == 1
    # readers keep the latest revision per window
    latest = dedup_revisions(spark.read.parquet(fact).drop("window_date"))
    got = {r.keyword: r.mention_count for r in latest.collect()}
    assert got == {"alpha": 5, "crash": 1, "omega": 3, "fresh": 1}


def test_restart_resumes_without_duplicates(spark, workdir):
    src, fact, ckpt = os.path.join(workdir, "in"), os.path.join(workdir, "fact"), os.path.join(workdir, "ckpt")
    _write_batches(src, LATE_BATCHES[:2])
    _run(spark, src, fact, ckpt)
    n_first = spark.read.parquet(fact).count()
    _run(spark, src, fact, ckpt)  # nothing new: no rows appended
    assert spark.read.parquet(fact).count() == n_first
    # new input after restart continues from committed state
    with open(os.path.join(src, "b900.json"), "w") as f:
        f.write(json.dumps({"id": "x", "source": "bluesky", "text": "omega",
                            "created_at": "2024-01-01T00:03:21Z"}) + "\n")
    _run(spark, src, fact, ckpt)
    latest = dedup_revisions(spark.read.parquet(fact).drop("window_date"))
    assert {r.keyword: r.mention_count for r in latest.collect()}["omega"] == 2


def test_checkpoint_reset_starts_a_new_epoch(spark, workdir):
    """After the checkpoint is removed batches count from 0 again; the new
    run's revisions win and replace none of the old ones."""
    src, fact = os.path.join(workdir, "in"), os.path.join(workdir, "fact")
    _write_batches(src, [[(1, "alpha alpha")], [(2, "alpha")], [(3, "alpha alpha")]])
    _run(spark, src, fact, os.path.join(workdir, "ckpt"))
    n_before = spark.read.parquet(fact).count()
    _run(spark, src, fact, os.path.join(workdir, "ckpt2"), files_per_trigger=10)  # one batch, id 0
    rows = spark.read.parquet(fact)
    assert rows.count() == n_before + 1
    latest = dedup_revisions(rows.drop("window_date")).collect()
    assert [(r.keyword, r.mention_count, r.batch_id) for r in latest] == [("alpha", 5, 1 << 32)]


def test_unique_old_urls_pass_the_stream_dedup(spark, workdir):
    """URLs never seen before pass whatever their article date is."""
    from trendlens.streaming.ingest import run_ingest_stream

    raw_dir, out = os.path.join(workdir, "raw"), os.path.join(workdir, "out")
    os.makedirs(raw_dir)
    dates = ["20240105T000000Z", "20240101T000000Z", "20240104T000000Z", "20240102T000000Z", "20231201T000000Z"]
    for i, d in enumerate(dates):
        p = os.path.join(raw_dir, f"p{i}.json")
        with open(p, "w") as f:
            f.write(json.dumps({"articles": [{"url": f"https://a.example/{i}", "title": "t", "seendate": d}]}) + "\n")
        os.utime(p, (1000 + i, 1000 + i))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", "1").load(raw_dir)
    q = run_ingest_stream(spark, raw, "gdelt", out, checkpoint=os.path.join(workdir, "ck"),
                          as_of="2024-01-05 00:00:00", available_now=True)
    q.awaitTermination(180)
    got = [json.loads(r.value)["url"] for r in spark.read.text(os.path.join(out, "topic=raw-news-events")).collect()]
    assert sorted(got) == [f"https://a.example/{i}" for i in range(5)]


def test_word_list_override_reaches_the_stream(spark, workdir, monkeypatch):
    src = os.path.join(workdir, "in")
    _write_batches(src, [[(1, "alpha beta gamma"), (2, "alpha")]])
    words = os.path.join(workdir, "words.json")
    with open(words, "w") as f:
        json.dump({"stop_words": ["beta"], "positive": ["alpha"], "negative": []}, f)
    monkeypatch.setenv("TRENDLENS_WORDLIST", words)
    fact = os.path.join(workdir, "fact")
    _run(spark, src, fact, os.path.join(workdir, "ck"))
    got = {r.keyword: round(r.avg_sentiment, 6) for r in spark.read.parquet(fact).collect()}
    assert got == {"alpha": 0.75, "gamma": 0.5}


def test_default_checkpoints_differ(spark):
    from trendlens.session import default_checkpoint

    a, b = default_checkpoint(spark, "ingest-gdelt", "files", "/a"), default_checkpoint(spark, "ingest-gdelt", "files", "/b")
    assert a != b and a == default_checkpoint(spark, "ingest-gdelt", "files", "/a")


def test_replayed_batch_is_idempotent(spark, workdir):
    fact = os.path.join(workdir, "fact")
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:00:10", "alpha", "bluesky", 2, 0.0, 2.0)],
        "s string, e string, keyword string, source string, mention_count long, avg_sentiment double, "
        "trend_score double",
    ).select(F.struct(F.to_timestamp("s").alias("start"), F.to_timestamp("e").alias("end")).alias("window"),
             "keyword", "source", "mention_count", "avg_sentiment", "trend_score")
    writer = TrendBatchWriter([ParquetTrendSink(fact)])
    writer(df, 7)
    writer(df, 7)  # at-least-once replay of batch 7
    writer(df.limit(0), 8)  # empty batch is a no-op
    out = spark.read.parquet(fact)
    assert out.count() == 1 and out.first().batch_id == 7


def test_stream_matches_batch(spark, workdir):
    """Final revision of every window from the stream == batch aggregate."""
    src = os.path.join(workdir, "in")
    posts = posts_docs(spark, SF_SMALL)
    wire = posts.withColumn("created_at", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    post_payload(wire).select("value").coalesce(4).write.text(src)
    fact = os.path.join(workdir, "fact")
    _run(spark, src, fact, os.path.join(workdir, "ckpt"), files_per_trigger=1)
    streamed = dedup_revisions(spark.read.parquet(fact).drop("window_date")).select(
        "window_start", "keyword", "source", "mention_count", F.round("avg_sentiment", 9).alias("s"))
    batch = trends_from_posts(posts).select(
        "window_start", "keyword", "source", "mention_count", F.round("avg_sentiment", 9).alias("s"))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_archive_stream(spark, workdir):
    src, out = os.path.join(workdir, "in"), os.path.join(workdir, "archive")
    _write_batches(src, LATE_BATCHES)
    q = run_archive_stream(spark, file_post_stream(spark, src), out,
                           checkpoint=os.path.join(workdir, "ckpt"), available_now=True)
    q.awaitTermination(120)
    arch = spark.read.parquet(out)
    assert arch.count() == 10
    assert {"event_date", "source", "keywords", "sentiment"} <= set(arch.columns)
    assert os.path.isdir(os.path.join(out, "event_date=2024-01-01", "source=bluesky"))


def test_live_leaderboard_snapshot_and_daily_job(spark, workdir):
    """Stream -> fact table + leaderboard snapshot; then the nightly rollup
    over the written fact table."""
    from trendlens.operators.leaderboard import latest_trends
    from trendlens.operators.rollup import run_daily_summary
    from trendlens.sources.sinks import LeaderboardSnapshotSink, read_leaderboard_snapshot
    from trendlens.sources.tables import read_trend_windows

    src, fact, snap = (os.path.join(workdir, n) for n in ("in", "fact", "snapshot"))
    _write_batches(src, LATE_BATCHES)
    raw = file_post_stream(spark, src, max_files_per_trigger=1)
    q = run_trend_stream(spark, raw, [ParquetTrendSink(fact), LeaderboardSnapshotSink(fact, snap, limit=20)],
                         checkpoint=os.path.join(workdir, "ckpt"), available_now=True)
    q.awaitTermination(180)
    snapshot = read_leaderboard_snapshot(spark, snap)
    assert snapshot.select("batch_id").distinct().first().batch_id == 4
    # versions are kept by age: none is old enough to go
    assert sorted(os.listdir(snap)) == [f"batch_id={n}" for n in range(5)] + ["maxima"]
    assert sorted(os.listdir(os.path.join(snap, "maxima"))) == [f"batch_id={n}" for n in range(5)]
    tw = read_trend_windows(spark, fact)
    expect = latest_trends(tw, 20).collect()
    got = snapshot.drop("batch_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expect))
    # served leaderboard sums every revision (alpha 3 + 4 + 5 = 12)
    assert {r.keyword: r.mention_count for r in got}["alpha"] == 12
    summary = run_daily_summary(spark, fact, os.path.join(workdir, "summary"), "2024-01-02",
                                created_at="2024-01-02 00:15:00")
    assert {r.keyword: r.total_mentions for r in summary.collect()} == {"alpha": 5, "crash": 1, "omega": 3,
                                                                       "fresh": 1}


def test_compact_day(spark, workdir):
    from trendlens.operators.compaction import compact_day
    from trendlens.operators.history import trend_history
    from trendlens.operators.rollup import daily_summary
    from trendlens.sources.tables import read_trend_windows

    src, fact = os.path.join(workdir, "in"), os.path.join(workdir, "fact")
    _write_batches(src, LATE_BATCHES)
    _run(spark, src, fact, os.path.join(workdir, "ckpt"))
    before = read_trend_windows(spark, fact)
    expect = sorted(map(tuple, daily_summary(before, "2024-01-01", created_at="2024-01-02 00:00:00").collect()))
    n_before = before.count()
    from trendlens.operators.leaderboard import latest_trends

    served = latest_trends(before, 20, horizon="30 seconds").collect()
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        kept = compact_day(spark, fact, "2024-01-01", files=2, horizon="30 seconds")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    after = read_trend_windows(spark, fact)
    assert kept == after.count() < n_before
    by_keyword = {}
    for r in after.collect():
        by_keyword.setdefault(r.keyword, []).append(r.batch_id)
    # closed windows keep one row; those the served leaderboard still sums keep all
    assert by_keyword["alpha"] == [-1] and by_keyword["fresh"] == [-1] and -1 not in by_keyword["omega"]
    assert latest_trends(after, 20, horizon="30 seconds").collect() == served
    assert sorted(f for f in os.listdir(fact) if not f.startswith((".", "_SUCCESS"))) == ["window_date=2024-01-01"]
    got = sorted(map(tuple, daily_summary(after, "2024-01-01", created_at="2024-01-02 00:00:00").collect()))
    assert got == expect
    hist = trend_history(after, "alpha", hours=72, as_of="2024-01-02 00:00:00").collect()
    assert [r.mention_count for r in hist] == [5]


def test_ingest_then_trend_stream_end_to_end(spark, workdir):
    """Provider payloads -> ingest stream -> topic folders -> trend stream ->
    fact table; the latest revisions equal the batch computation."""
    from trendlens.sources.fixtures import FIXTURE_AS_OF, bluesky_raw
    from trendlens.sources.normalize import normalize_bluesky
    from trendlens.sources.posts import parse_posts
    from trendlens.operators.trends import enrich, flatten_windows, mentions, windowed_trends
    from trendlens.streaming.ingest import run_ingest_stream

    raw_dir, posts_dir, fact = (os.path.join(workdir, n) for n in ("raw", "posts", "fact"))
    raw = bluesky_raw(spark, SF_SMALL)
    raw.select("value").coalesce(3).write.text(raw_dir)
    q = run_ingest_stream(spark, spark.readStream.format("text").load(raw_dir), "bluesky", posts_dir,
                          checkpoint=os.path.join(workdir, "ck1"), as_of=FIXTURE_AS_OF, available_now=True)
    q.awaitTermination(180)
    assert q.exception() is None
    assert os.path.isdir(os.path.join(posts_dir, "topic=raw-social-posts"))
    q2 = run_trend_stream(spark, file_post_stream(spark, posts_dir), [ParquetTrendSink(fact)],
                          checkpoint=os.path.join(workdir, "ck2"), available_now=True,
                          event_time_fallback=FIXTURE_AS_OF)
    q2.awaitTermination(180)
    assert q2.exception() is None
    cols = ["window_start", "keyword", "source", "mention_count"]
    streamed = dedup_revisions(spark.read.parquet(fact).drop("window_date")).select(
        *cols, F.round("avg_sentiment", 9).alias("s"))
    posts = parse_posts(post_payload(normalize_bluesky(raw, as_of=FIXTURE_AS_OF)),
                        event_time_fallback=FIXTURE_AS_OF)
    batch = flatten_windows(windowed_trends(mentions(enrich(posts)))).select(
        *cols, F.round("avg_sentiment", 9).alias("s"))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_gdelt_ingest_dedups_urls_within_watermark(spark, workdir):
    from trendlens.streaming.ingest import run_ingest_stream

    raw_dir, out = os.path.join(workdir, "raw"), os.path.join(workdir, "out")
    os.makedirs(raw_dir)
    art = {"url": "https://a.example/x", "title": "Outage hits cloud", "domain": "a.example",
           "language": "English", "seendate": "20240101T000000Z", "sourcecountry": "US"}
    other = dict(art, url="https://b.example/y", title="Growth returns")
    for i, arts in enumerate([[art, other], [art]]):  # the first URL is polled twice
        with open(os.path.join(raw_dir, f"p{i}.json"), "w") as f:
            f.write(json.dumps({"articles": arts}) + "\n")
    q = run_ingest_stream(spark, spark.readStream.format("text").load(raw_dir), "gdelt", out,
                          checkpoint=os.path.join(workdir, "ck"), as_of="2024-01-01 00:00:00",
                          available_now=True)
    q.awaitTermination(180)
    got = [json.loads(r.value) for r in spark.read.text(os.path.join(out, "topic=raw-news-events")).collect()]
    assert sorted(g["url"] for g in got) == ["https://a.example/x", "https://b.example/y"]
    assert all(g["created_at"] == "2024-01-01T00:00:00Z" for g in got)


def test_cli_stream_and_daily(spark, workdir):
    """The command-line entry runs the same jobs (available-now stream, then
    the nightly rollup)."""
    from trendlens.__main__ import main

    src, fact, summary = (os.path.join(workdir, n) for n in ("in", "fact", "summary"))
    _write_batches(src, LATE_BATCHES[:1])
    main(["stream", "--input", src, "--fact", fact, "--checkpoint", os.path.join(workdir, "ck"),
          "--available-now"])
    main(["daily", "--fact", fact, "--summary", summary, "--run-date", "2024-01-02"])
    got = {r.keyword: r.total_mentions for r in spark.read.parquet(summary).collect()}
    assert got == {"alpha": 3, "crash": 1}


def test_cli_ingest_and_compact(spark, workdir):
    from trendlens.__main__ import main

    raw_dir, posts_dir, fact = (os.path.join(workdir, n) for n in ("raw", "posts", "fact"))
    os.makedirs(raw_dir)
    with open(os.path.join(raw_dir, "p.json"), "w") as f:
        f.write(json.dumps({"articles": [{"url": "https://a.example/x", "title": "Outage at cloud provider",
                                          "seendate": "20240101T000005Z"}]}) + "\n")
    main(["ingest", "--provider", "gdelt", "--input", raw_dir, "--output", posts_dir,
          "--checkpoint", os.path.join(workdir, "ck1"), "--available-now"])
    main(["stream", "--input", posts_dir, "--fact", fact, "--checkpoint", os.path.join(workdir, "ck2"),
          "--available-now", "--state-partitions", "2"])
    before = spark.read.parquet(fact).collect()
    assert {r.keyword for r in before} == {"outage", "cloud", "provider"}
    main(["compact", "--fact", fact, "--day", "2024-01-01", "--files", "1"])
    after = spark.read.parquet(fact).collect()
    assert len(after) == len(before)  # all within the horizon of the served leaderboard
