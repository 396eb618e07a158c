"""Command-line entry for the long-running and scheduled jobs.

    python -m trendlens stream  --kafka broker:9092 --fact s3a://b/trend_windows [--snapshot PATH]
                                [--live PATH] [--jdbc-url URL --jdbc-table T] [--kafka-out broker:9092] [--alerts PATH]
    python -m trendlens stream  --input /landing/posts --fact PATH          (JSON-lines folder)
    python -m trendlens split   --input /landing/posts --output PATH        (accepted and error routes)
    python -m trendlens ingest  --provider gdelt --input /landing/gdelt --output broker:9092 --format kafka
    python -m trendlens daily   --fact PATH --summary PATH [--run-date 2024-01-02]
    python -m trendlens compact --fact PATH --day 2024-01-01 [--files 8]

Checkpoints default to folders under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from trendlens.functions.wordlists import Lexicon
from trendlens.session import build_session


def _raw(args, spark):
    from trendlens.sources.posts import file_post_stream, kafka_post_stream

    if args.kafka:
        return kafka_post_stream(spark, args.kafka, max_offsets_per_trigger=args.max_offsets,
                                 min_partitions=args.min_partitions)
    return file_post_stream(spark, args.input, max_files_per_trigger=args.max_files)


def _split(args, spark):
    from trendlens.streaming.errors import run_split_stream

    run_split_stream(spark, _raw(args, spark), args.output, args.checkpoint, args.available_now,
                     args.trigger).awaitTermination()


def _stream(args, spark):
    from trendlens.sources.jdbc import LedgerJdbcTrendSink
    from trendlens.sources.sinks import AlertSink, KafkaTrendSink, LeaderboardSnapshotSink, ParquetTrendSink
    from trendlens.streaming.job import run_trend_stream
    from trendlens.streaming.live import IncrementalLeaderboardSink

    raw = _raw(args, spark)
    sinks = [ParquetTrendSink(args.fact, files_per_batch=args.files_per_batch)]
    if args.jdbc_url:
        sinks.append(LedgerJdbcTrendSink(args.jdbc_url, args.jdbc_table))
    if args.kafka_out:
        sinks.append(KafkaTrendSink(args.kafka_out))
    if args.alerts:
        sinks.append(AlertSink(args.alerts))
    if args.snapshot:
        sinks.append(LeaderboardSnapshotSink(args.fact, args.snapshot))
    if args.live:
        sinks.append(IncrementalLeaderboardSink(args.live, fact_path=args.fact))
    q = run_trend_stream(spark, raw, sinks, checkpoint=args.checkpoint, trigger=args.trigger,
                         available_now=args.available_now, parallelism=args.parallelism,
                         state_partitions=args.state_partitions, lexicon=Lexicon.load(args.wordlist),
                         max_keywords=args.max_keywords)
    q.awaitTermination()


def _ingest(args, spark):
    from trendlens.streaming.ingest import run_ingest_stream

    raw = spark.readStream.format("text").load(args.input)
    q = run_ingest_stream(spark, raw, args.provider, args.output, fmt=args.format, checkpoint=args.checkpoint,
                          available_now=args.available_now, url_state=args.url_state)
    q.awaitTermination()


def _daily(args, spark):
    from trendlens.operators.rollup import run_daily_summary

    run_date = args.run_date or dt.datetime.now(dt.timezone.utc).date().isoformat()
    run_daily_summary(spark, args.fact, args.summary, run_date)


def _compact(args, spark):
    from trendlens.operators.compaction import compact_day

    print(compact_day(spark, args.fact, args.day, files=args.files, horizon=args.horizon))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trendlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s, e = sub.add_parser("stream"), sub.add_parser("split")
    for posts in (s, e):
        src = posts.add_mutually_exclusive_group(required=True)
        src.add_argument("--kafka")
        src.add_argument("--input")
        posts.add_argument("--checkpoint")
        posts.add_argument("--trigger", default="2 seconds")
        posts.add_argument("--min-partitions", type=int)
        posts.add_argument("--available-now", action="store_true")
        posts.add_argument("--max-offsets", type=int, help="Kafka offsets per micro-batch, the first one included")
        posts.add_argument("--max-files", type=int, help="files per micro-batch, the first one included")
    e.add_argument("--output", required=True)
    s.add_argument("--fact", required=True)
    s.add_argument("--snapshot", help="leaderboard ranked from the fact table on every trigger")
    s.add_argument("--live", help="the same leaderboard, kept as state")
    s.add_argument("--alerts", help="folder of the sentiment alerts")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-table", default="trend_windows")
    s.add_argument("--kafka-out")
    s.add_argument("--parallelism", type=int)
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--files-per-batch", type=int)
    s.add_argument("--wordlist", help="JSON word lists; default $TRENDLENS_WORDLIST, else the built-in ones")
    s.add_argument("--max-keywords", type=int, help="count only the first so many keywords of a post")
    i = sub.add_parser("ingest")
    i.add_argument("--provider", required=True, choices=["bluesky", "gdelt", "hackernews"])
    i.add_argument("--input", required=True)
    i.add_argument("--output", required=True)
    i.add_argument("--format", default="files", choices=["files", "kafka"])
    i.add_argument("--checkpoint")
    i.add_argument("--available-now", action="store_true")
    i.add_argument("--url-state", action="store_true", help="seen URLs as keyed state with counted evictions")
    d = sub.add_parser("daily")
    d.add_argument("--fact", required=True)
    d.add_argument("--summary", required=True)
    d.add_argument("--run-date")
    c = sub.add_parser("compact")
    c.add_argument("--fact", required=True)
    c.add_argument("--day", required=True)
    c.add_argument("--files", type=int)
    c.add_argument("--horizon", default="30 minutes", help="how far back a leaderboard sums all revisions")
    args = ap.parse_args(argv)
    spark = build_session()
    {"stream": _stream, "split": _split, "ingest": _ingest, "daily": _daily, "compact": _compact}[args.cmd](args, spark)


if __name__ == "__main__":
    main()
