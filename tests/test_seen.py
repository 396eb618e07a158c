"""URL dedup with keyed state: horizon, evictions, restart, batch form."""

import json
import os

from pyspark.sql import functions as F

from trendlens.sources.normalize import dedup_by_url
from trendlens.streaming.seen import dedup_urls_stateful, evictions

SCHEMA = "id string, url string, created_at string, at string"


def _land(folder, n, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{n:03d}.json"), "w") as f:
        f.writelines(json.dumps(dict(zip(("id", "url", "created_at", "at"), r))) + "\n" for r in rows)


def _run(spark, workdir, land):
    posts = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(land)
    out = dedup_urls_stateful(posts, "1 hour", arrived=F.to_timestamp("at"))
    q = (out.writeStream.format("parquet").option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ck")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(r.id for r in spark.read.parquet(f"{workdir}/out").collect()), evictions(q)


def test_seen_urls_expire_and_survive_a_restart(spark, workdir):
    land = f"{workdir}/land"
    first = [("b", "u1", "2024-01-01", "2024-01-01 00:00:00"), ("a", "u1", "2024-01-01", "2024-01-01 00:00:00"),
             ("c", "u2", "2024-01-01", "2024-01-01 00:10:00"), ("n1", None, "2024-01-01", "2024-01-01 00:10:00"),
             ("n2", "", "2024-01-01", "2024-01-01 00:10:00")]
    _land(land, 0, first)
    ids, gone = _run(spark, workdir, land)
    assert ids == ["a", "c", "n1", "n2"] and gone == 0
    # Inside the horizon the stream equals the batch form.
    posts = spark.createDataFrame([(i, u or None, c, t) for i, u, c, t in first], SCHEMA)
    assert ids == sorted(r.id for r in dedup_by_url(posts).collect())
    # After a restart: u1 and u2 are still known, u1 once more after its hour.
    _land(land, 1, [("d", "u1", "2024-01-01", "2024-01-01 00:59:59"), ("e", "u2", "2024-01-01", "2024-01-01 00:30:00")])
    _land(land, 2, [("f", "u1", "2024-01-01", "2024-01-01 01:00:00"), ("g", "u2", "2024-01-01", "2024-01-01 01:00:00")])
    ids, _ = _run(spark, workdir, land)
    assert ids == ["a", "c", "f", "n1", "n2"]
    # Two hours on all remembered URLs have been evicted.
    _land(land, 3, [("h", "u9", "2024-01-01", "2024-01-01 03:30:00")])
    _land(land, 4, [("i", "u8", "2024-01-01", "2024-01-01 03:30:00")])
    _land(land, 5, [("j", "u2", "2024-01-01", "2024-01-01 03:30:00")])
    ids, gone = _run(spark, workdir, land)
    assert ids == ["a", "c", "f", "h", "i", "j", "n1", "n2"]
    assert gone == 2  # u1 and u2
