"""Database ledger, epochs after a reset, error and alert routes, watermarks
per provider."""

import json
import os

import pytest
from pyspark.sql import functions as F

from test_streaming import _write_batches
from trendlens.operators.alerts import sentiment_alerts
from trendlens.operators.revisions import dedup_revisions
from trendlens.sources.jdbc import LedgerJdbcTrendSink, execute, scalar, transaction
from trendlens.sources.posts import file_post_stream
from trendlens.sources.sinks import AlertSink, JdbcTrendSink, KafkaTrendSink, ParquetTrendSink
from trendlens.streaming import errors
from trendlens.streaming.job import run_epoch, run_trend_stream

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _url(workdir, name="db"):
    return f"jdbc:derby:{os.path.join(workdir, name)};create=true"


def _rows(spark, batch_id, words=("alpha", "beta")):
    return spark.createDataFrame([(batch_id, w, 3) for w in words], "batch_id long, keyword string, n long").select(
        "batch_id", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("window_start"),
        F.lit("2024-01-01 00:00:10").cast("timestamp").alias("window_end"), "keyword", F.lit("gdelt").alias("source"),
        F.col("n").alias("mention_count"), F.lit(-0.6).alias("avg_sentiment"), F.lit(4.8).alias("trend_score"),
        F.lit("2024-01-01 00:00:12").cast("timestamp").alias("created_at"))


def _table(spark, url, name="TW"):
    df = spark.read.jdbc(url, name, properties=DERBY)
    return df.toDF(*[c.lower() for c in df.columns])


def test_a_replayed_batch_changes_nothing_in_the_database(spark, workdir):
    url = _url(workdir)
    sink = LedgerJdbcTrendSink(url, "TW", DERBY)
    sink(_rows(spark, 0), 0)
    sink(_rows(spark, 0), 0)
    sink(_rows(spark, 1, ["gamma"]), 1)
    LedgerJdbcTrendSink(url, "TW", DERBY)(_rows(spark, 1, ["gamma"]), 1)  # a new driver's sink
    assert sorted((r.batch_id, r.keyword) for r in _table(spark, url).collect()) == [
        (0, "alpha"), (0, "beta"), (1, "gamma")]
    ledger = _table(spark, url, "TW_BATCHES")
    assert sorted(map(tuple, ledger.collect())) == [(0, 2), (1, 1)]
    assert _table(spark, url, "TW_STAGING").count() == 0


def test_a_batch_that_fails_in_the_transaction_leaves_nothing(spark, workdir):
    url = _url(workdir)
    sink = LedgerJdbcTrendSink(url, "TW", DERBY)
    sink(_rows(spark, 0), 0)
    with transaction(spark, url, sink.properties) as conn:
        execute(conn, 'ALTER TABLE TW ADD CONSTRAINT few CHECK ("mention_count" < 10)')
    bad = _rows(spark, 1).withColumn("mention_count", F.lit(99).cast("long"))
    with pytest.raises(Exception):
        sink(bad, 1)
    assert _table(spark, url).count() == 2 and _table(spark, url, "TW_BATCHES").count() == 1
    sink(_rows(spark, 1, ["gamma"]), 1)  # the retry; staged rows of the failed run are gone
    assert sorted(r.keyword for r in _table(spark, url).collect()) == ["alpha", "beta", "gamma"]
    with transaction(spark, url, sink.properties) as conn:
        assert scalar(conn, "SELECT MAX(batch_id) FROM TW_BATCHES WHERE batch_id > 7") is None


@pytest.mark.parametrize("kind", [JdbcTrendSink, LedgerJdbcTrendSink])
def test_reset_with_a_database_alone(spark, workdir, kind):
    src, url = os.path.join(workdir, "in"), _url(workdir)
    _write_batches(src, [[(1, "alpha alpha")], [(2, "alpha")]])
    for ckpt, files in (("ck1", 1), ("ck2", 10)):
        q = run_trend_stream(spark, file_post_stream(spark, src, max_files_per_trigger=files), [kind(url, "TW", DERBY)],
                             checkpoint=os.path.join(workdir, ckpt), available_now=True)
        q.awaitTermination(180)
    rows = _table(spark, url).withColumn("id", F.monotonically_increasing_id())
    assert sorted(r.batch_id for r in rows.collect()) == [0, 1, 1 << 32]
    assert [(r.keyword, r.mention_count) for r in dedup_revisions(rows).collect()] == [("alpha", 3)]


def test_reset_counts_every_target(spark, workdir):
    """Two sinks: the epoch follows the target that has seen most; a sink that
    cannot be read (Kafka) leaves its epoch in the shared folder."""
    fact, broker = ParquetTrendSink(f"{workdir}/fact"), KafkaTrendSink(f"broker-{os.path.basename(workdir)}:9092")
    assert run_epoch(spark, f"{workdir}/k1", [broker]) == 0
    assert run_epoch(spark, f"{workdir}/k1", [broker]) == 0  # the same checkpoint goes on
    assert run_epoch(spark, f"{workdir}/k2", [broker]) == 1
    fact(_rows(spark, 5 << 32), 5 << 32)
    assert run_epoch(spark, f"{workdir}/k3", [broker, fact]) == 6
    assert run_epoch(spark, f"{workdir}/k4", [broker]) == 7


def test_errors_are_split_off_and_sent_back_once(spark, workdir):
    src, path = os.path.join(workdir, "in"), os.path.join(workdir, "routes")
    os.makedirs(src)
    good = lambda i, text="alpha": json.dumps({"id": i, "source": "gdelt", "text": text,
                                               "created_at": "2024-01-01T00:00:01Z"})
    for n, lines in enumerate([[good("a"), "{broken", "[1]", good("b")], [good("c"), good("d", ""), "{broken", "{broken"]]):
        with open(os.path.join(src, f"{n}.json"), "w") as f:
            f.writelines(line + "\n" for line in lines)
        os.utime(os.path.join(src, f"{n}.json"), (1000 + n, 1000 + n))
    q = errors.run_split_stream(spark, file_post_stream(spark, src, 1), path, os.path.join(workdir, "ck"), True)
    q.awaitTermination(180)
    counts = lambda: sorted(map(tuple, errors.route_counts(spark, path).collect()))
    assert counts() == [(0, 2, 2, 0), (1, 1, 3, 0)]
    batch = spark.read.text(os.path.join(src, "0.json"))
    errors.split_batch(batch.coalesce(1), 0, path)  # a replayed batch replaces itself
    assert counts() == [(0, 2, 2, 0), (1, 1, 3, 0)]
    reasons = sorted(r.reason for r in errors.read_route(spark, path, errors.ERRORS).collect())
    assert reasons == ["malformed", "malformed", "malformed", "malformed", "no text"]

    def mend(rows):
        fixed = F.concat(F.lit('{"id": "m'), F.col("place"), F.lit('", "text": "omega"}'))
        return rows.withColumn("value", F.when(F.col("value") == "{broken", fixed).otherwise(F.col("value")))

    assert errors.replay_errors(spark, path, lambda rows: rows) == 0
    assert errors.replay_errors(spark, path, mend) == 3
    assert errors.replay_errors(spark, path, mend) == 0
    assert counts() == [(0, 2, 2, 1), (1, 1, 3, 2)]
    assert sorted(r.value for r in errors.open_errors(spark, path).collect()) == sorted(["[1]", good("d", "")])
    # The trend stream reads the accepted route, mended records included.
    q = run_trend_stream(spark, errors.accepted_stream(spark, path), [ParquetTrendSink(f"{workdir}/fact")],
                         checkpoint=f"{workdir}/ck2", available_now=True, event_time_fallback="2024-01-01 00:00:02")
    q.awaitTermination(180)
    latest = dedup_revisions(spark.read.parquet(f"{workdir}/fact").drop("window_date"))
    assert {(r.keyword, r.source): r.mention_count for r in latest.collect()} == {
        ("alpha", "gdelt"): 3, ("omega", "unknown"): 3}


def test_alerts_from_the_stream(spark, workdir):
    src, out = os.path.join(workdir, "in"), os.path.join(workdir, "alerts")
    _write_batches(src, [[(1, "crash crash crisis"), (2, "crash")], [(3, "alpha alpha")]])
    fact = os.path.join(workdir, "fact")
    q = run_trend_stream(spark, file_post_stream(spark, src, 1), [ParquetTrendSink(fact), AlertSink(out)],
                         checkpoint=os.path.join(workdir, "ck"), available_now=True)
    q.awaitTermination(180)
    got = spark.read.parquet(out)
    want = sentiment_alerts(spark.read.parquet(fact))
    key = ["batch_id", "keyword", "mention_count", "avg_sentiment", "level"]
    n = got.count()
    assert n and sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    AlertSink(out)(spark.read.parquet(fact).filter("batch_id = 0").drop("window_date", "id"), 0)  # a replayed batch
    assert spark.read.parquet(out).count() == n
    with pytest.raises(ValueError):
        AlertSink(out, fmt="mail")


def test_a_provider_that_lags_loses_no_row_under_min(spark, workdir):
    """Two providers, one two minutes behind with a one-minute watermark: its
    own time decides, not the fast provider's; windows still close."""
    fast, slow = os.path.join(workdir, "fast"), os.path.join(workdir, "slow")
    _write_batches(fast, [[(130, "alpha")], [(180, "alpha")], [(240, "alpha")], [(400, "alpha")], [(410, "alpha")]])
    _write_batches(slow, [[(10, "omega")], [(60, "omega")], [(61, "omega")], [(290, "omega")], [(300, "omega")]])

    def run(policy):
        streams = {"bluesky": file_post_stream(spark, fast, 1), "gdelt": file_post_stream(spark, slow, 1)}
        q = run_trend_stream(spark, streams, [ParquetTrendSink(f"{workdir}/{policy}")], f"{workdir}/ck-{policy}",
                             available_now=True, watermark={"bluesky": "1 minute", "gdelt": "1 minute"},
                             watermark_policy=policy)
        q.awaitTermination(180)
        dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
        removed = sum(op["numRowsRemoved"] for p in q.recentProgress for op in p["stateOperators"])
        latest = dedup_revisions(spark.read.parquet(f"{workdir}/{policy}").drop("window_date"))
        return dropped, removed, sum(r.mention_count for r in latest.collect() if r.keyword == "omega")

    dropped, removed, said = run("min")
    assert dropped == 0 and said == 5 and removed > 0
    dropped, _, said = run("max")
    assert dropped > 0 and said < 5
    with pytest.raises(ValueError):
        run_trend_stream(spark, {"a": None}, [], watermark={"b": "1 minute"})
