"""Token counts as delta-maintained rollups.

Totals per source, language and tokenizer version are additive, so a change
of the corpus is a batch of signed rows: an insert adds a document's counts, a
delete takes them away, a revision adds the difference (and moves the
document if its source or language changed).  Batches are summed in Spark and
committed under their id by one rename (so the folder must be on a file system
whose renames are atomic, as HDFS and local disks are and object stores are
not); committing an id again changes nothing, and a batch that a failed job
left behind was never part of the totals.

Totals are kept as snapshots, each with the list of the batches in it.  A
commit adds the batches since to the newest one, so reading the totals takes
one snapshot and the batches of commits that are still under way, however
long the history is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import python_workers, words_col
from trendlens.llm.packing import default_tokenizer, encoder

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["n_docs", "n_tokens"]
COUNTED = "doc_id long, source string, lang string, tokenizer string, n_tokens long"
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def words_tokenizer(text: Column) -> Column:
    """Number of white-space-separated words."""
    return F.size(words_col(text)).cast("long")


def bpe_tokenizer(path: str | None = None) -> Callable[[Column], Column]:
    """Number of ids that a tokenizer file gives a text."""
    file = path or default_tokenizer()

    def count(text: Column) -> Column:
        @F.pandas_udf("long")
        def ids(texts: pd.Series) -> pd.Series:
            encode = encoder(file).encode
            return pd.Series([len(encode(t)) // 4 for t in texts], dtype="int64")

        return ids(text)

    return count


def count_tokens(docs: DataFrame, tokenizers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``doc_id, source, lang, tokenizer, n_tokens`` per document and
    tokenizer version.

    NULL and empty texts have no tokens, long ones count whole; NULL ids,
    sources and languages are kept as such (the rollup sums NULL keys as keys
    of their own); repeated rows and ids count row by row, ties cannot occur;
    other columns are not read; an empty table gives no rows."""
    python_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                       *(count(F.col("text")).alias(f"t{i}") for i, count in enumerate(tokenizers.values())))
    each = F.array(*(F.struct(F.lit(name).alias("tokenizer"), F.col(f"t{i}").alias("n_tokens"))
                     for i, name in enumerate(tokenizers)))
    return rows.select("doc_id", "source", "lang", F.inline(each))


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """The old counts out, the new ones in; where the keys agree the two sum
    to the difference."""
    return deletes(before).unionAll(inserts(after))


class TokenRollup:
    """Totals kept under a folder that all executors reach.

    NULL keys are keys of their own; repeated rows of a batch add up; a batch
    without rows is committed like any other; columns beside ``KEYS`` and
    ``MEASURES`` are not read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self._conf)

    def committed(self, batch_id: str) -> bool:
        return self._fs().exists(self._path(f"batch={batch_id}"))

    def commit(self, batch_id: str, deltas: DataFrame, strict: bool = False) -> bool:
        """Add a batch of signed rows; False if the id was committed before
        (``strict``: if it was with other sums, raise).

        The rows are summed per key (per task first) and written to a staging
        folder of this attempt, whose rename is the commit.  Of two attempts
        at once one wins the rename and the other's files are removed.
        """
        if not batch_id or any(c in batch_id for c in "/=\\ "):
            raise ValueError(f"bad batch id {batch_id!r}")
        summed = deltas.groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        if self.committed(batch_id):
            if strict and _digest(summed) != _digest(self._read([f"batch={batch_id}"])):
                raise ValueError(f"batch {batch_id!r} was committed with other rows")
            return False
        stage = f"_stage-{batch_id}-{uuid.uuid4().hex}"
        summed.write.parquet(f"{self.folder}/{stage}")
        won = self._publish(stage, f"batch={batch_id}")
        if won:
            self._fold()
        return won

    def _publish(self, stage: str, name: str) -> bool:
        """Rename a staged folder to its name, or delete it if that is taken."""
        fs = self._fs()
        if not fs.exists(self._path(name)) and fs.rename(self._path(stage), self._path(name)):
            # A rename onto a folder that appeared meanwhile lands inside it.
            inside = self._path(f"{name}/{stage}")
            if not fs.exists(inside):
                return True
            fs.delete(inside, True)
            return False
        fs.delete(self._path(stage), True)
        return False

    def _names(self, kind: str) -> list[str]:
        fs = self._fs()
        if not fs.exists(self._path("")):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(self._path(""))) if n.startswith(kind))

    def batches(self) -> list[str]:
        return self._names("batch=")

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(DELTAS).parquet(*(f"{self.folder}/{n}" for n in names))

    def _state(self) -> tuple[list[str], set[str], list[str]]:
        """The newest snapshot (none or one), the batches in it, those after it."""
        known = self._names("batch=")
        snapshots = sorted(self._names("snapshot="), key=lambda n: int(n.split("=")[1].split("-")[0]))
        if not snapshots:
            return [], set(), known
        inside = {r.value for r in self.spark.read.text(f"{self.folder}/{snapshots[-1]}/covers").collect()}
        return snapshots[-1:], inside, [n for n in known if n not in inside]

    def _fold(self) -> None:
        """Write a snapshot of all batches there are now; older snapshots but
        the last one before it (a reader may hold it) go."""
        newest, inside, later = self._state()
        stage = f"_stage-snapshot-{uuid.uuid4().hex}"
        self._sums([f"{n}/totals" for n in newest] + later).write.parquet(f"{self.folder}/{stage}/totals")
        covers = sorted(inside | set(later))
        (self.spark.createDataFrame([(n,) for n in covers], "value string").coalesce(1)
         .write.text(f"{self.folder}/{stage}/covers"))
        # The number of batches leads the name: the snapshot that covers most is the newest.
        self._publish(stage, f"snapshot={len(covers)}-{uuid.uuid4().hex[:8]}")
        for old in sorted(self._names("snapshot="), key=lambda n: int(n.split("=")[1].split("-")[0]))[:-2]:
            self._fs().delete(self._path(old), True)

    def _sums(self, names: list[str]) -> DataFrame:
        return (self._read(names).groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
                .filter("n_docs <> 0 OR n_tokens <> 0"))

    def totals(self) -> DataFrame:
        """Sums over all committed batches; keys without documents left out.
        Reads the newest snapshot and the batches that it does not cover."""
        newest, _, later = self._state()
        names = [f"{n}/totals" for n in newest] + later
        return self._sums(names) if names else self.spark.createDataFrame([], DELTAS)


def _digest(summed: DataFrame) -> tuple:
    """Equal for equal rows in any order."""
    row = summed.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*KEYS, *MEASURES)).alias("a"),
                     F.bit_xor(F.xxhash64(F.lit(1), *MEASURES, *KEYS)).alias("b")).first()
    return row["n"], row["a"], row["b"]
