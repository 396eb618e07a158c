"""trendlens: keyword-trend analytics as plain Spark DataFrame functions.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
built-in expressions, so the same code runs on a batch table and on a
Structured Streaming source.  Sub-packages:

* ``functions``  column expressions (tokenizer, sentiment, time parsing, ids)
* ``sources``    readers, payload normalizers, sinks
* ``operators``  mentions, windowed trends, revision dedup, serving queries,
                 daily rollup, dashboard views
* ``plans``      the registered query catalog and its DuckDB oracles
* ``streaming``  the long-running trend stream and its archive stream
"""

from trendlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
