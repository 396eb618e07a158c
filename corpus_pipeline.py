"""A training corpus in five stages, each an operator of ``trendlens.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the documents it keeps (the last: packed pieces), which
are written as Parquet and read back as the next one's ``docs``.

Every stage works row by row of what it gets: repeated rows and ids are rows
of their own, columns beside those of ``documents`` come back as they are,
texts count whole, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.llm import decontaminate, packing, quality, secrets, simhash
from trendlens.llm.common import written
from trendlens.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  NULL and empty texts have no
    words and go; a document with NULL id is judged like any other, unlabelled;
    one that scores exactly the least score stays."""
    return quality.keep_good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates, that with the
    smallest id (NULL ids last; of rows that tie one stays).  NULL and empty
    texts share the fingerprint zero and are one group."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate.  NULL and empty texts
    have no words and stay; a document hit on exactly a twentieth goes."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark.  NULL and empty
    texts stay as they are."""
    return secrets.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens.  NULL
    and empty texts are the end token alone; of pieces that fit equally well
    any order is right."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# SQL has neither the tokenizer's ids nor Spark's XXH64 buckets: the stages are
# tested against brute-force versions instead (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
