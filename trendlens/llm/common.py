"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# Rows and bytes of one Arrow batch: texts may be very long, so a batch is
# bounded by both.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def python_workers(spark: SparkSession) -> None:
    """Settings that operators with Python stages rely on.

    Lowers the session's Arrow batch limits to ``ARROW_ROWS`` and
    ``ARROW_BYTES`` (smaller limits a user has set are left alone) and lets
    workers on the driver's machine import this package from where the driver
    has it; on a cluster ship the package with ``--py-files``.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = str(spark.conf.get(key))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage with a copy that survives the loss of any executor and
    that later jobs can scan several times.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`written` that no later
    step reads (iterations leave one table per round)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def bounded_sample(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``df`` if it has at most ``most`` rows, else ``most`` of them (about so
    many if rows repeat), those with small hashes of ``keys``.

    Rows are first thinned by their hashes to little more than ``most``, so
    that the final sort gets as many whatever the size of ``df``.
    """
    n = df.count()
    if n <= most:
        return df
    order = F.xxhash64(*keys)
    share = int(1.25 * most / n * (1 << 30)) + 1
    return df.filter(F.pmod(order, F.lit(1 << 30)) < share).orderBy(F.pmod(order, F.lit(1 << 30)), *keys).limit(most)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, made from ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns that tell its rows apart, repeated ones too, and
    the names of those columns.

    A table read straight from Parquet files (filtered or projected, but not
    multiplied) is told apart by file and place in it, without a copy; any
    other table is numbered in a written copy.  Either way a recomputed task
    gives a row the same key.
    """
    file, place = fresh(docs, "row_file"), fresh(docs, "row_place")
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place)), [
            file, place]
    except AnalysisException:  # no file behind a row
        return written(docs.withColumn(place, F.monotonically_increasing_id()), name), [place]


def words_col(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for NULL.

    ``split`` on one plain character and ``array_remove`` stay inside code
    generation, unlike a regular expression per word.
    """
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\v\f\r", "     ")
    return F.array_remove(F.split(blank, " ", -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column that a lambda refers to would be inlined into the lambda and
    computed once per element; as a lambda's own variable it is not.
    """
    return F.transform(F.array(value), body)[0]


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """A written copy of ``df`` with ``place``, a row's rank from 0 among the
    rows of its ``keys`` (no NULLs in them) by ``order``, and ``size``, their
    number.  Rows that tie are numbered in any order.

    Rows are sorted into range partitions; a row's rank is its place in its
    partition plus the counts of the partitions before, so no task holds all
    rows of a key.  The counts are one row per key and partition.
    """
    at, part = fresh(df, "row_at"), fresh(df, "row_part")
    tie = F.monotonically_increasing_id()  # spreads equal rows over partitions
    dealt = df.withColumn(at, tie).repartitionByRange(*keys, *order, at).sortWithinPartitions(*keys, *order, at)
    # The id of a sorted row is its partition (upper bits) and its place there.
    kept = written(dealt.withColumn(at, F.monotonically_increasing_id()), name)
    runs = kept.groupBy(*keys, F.shiftright(at, 33).alias(part)).agg(
        F.count("*").alias("run_rows"), F.min(at).alias("run_first"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("run_rows").over(before), F.lit(0)) - F.col("run_first")
    runs = runs.select(*keys, part, base.alias("run_base"), F.sum("run_rows").over(whole).alias("size"))
    joined = kept.withColumn(part, F.shiftright(at, 33)).join(runs, [*keys, part])
    return joined.withColumn("place", F.col(at) + F.col("run_base")).select(*df.columns, "place", "size")
