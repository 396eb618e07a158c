"""One registered query per operator, and the pipeline, over the corpus tables.

Every query applies its operator with its production parameters to the whole
table and returns the whole result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import (chat, collocations, decontaminate, htmltext, merkle, multiindex, oracles, packing, quality,
                           rollups, secrets, simhash, urlrank, warc)
from trendlens.llm.common import written
from trendlens.session import scratch_path
from trendlens.sources.tables import read_table

# Host and path rules that the URL filter query applies (fixed values).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrank.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.withColumn("value_sha256", F.sha2("value", 256)).drop("value")


def op6_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: every document inserted; the documents
    labelled toxic deleted; those labelled low in quality revised to their
    distinct lines; and the deletion once more, which must change nothing."""
    docs = read_table(spark, sf_dir, "documents")
    marks = (read_table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality")))
    versions = {"words-1": rollups.words_tokenizer, "word_bpe_49k": rollups.bpe_tokenizer()}
    counted = written(rollups.count_tokens(docs, versions), "rollup-counts")
    labelled = written(counted.join(marks, "doc_id"), "rollup-labelled")
    toxic = labelled.filter("toxic = 1").select(counted.columns)
    low = labelled.filter("quality = 0 AND coalesce(toxic, 0) <> 1").select(counted.columns)
    lines = F.array_join(F.array_distinct(F.split("text", "\n", -1)), "\n")
    revised = docs.join(low.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("text", lines)
    ledger = rollups.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    ledger.commit("0-insert", rollups.inserts(counted))
    ledger.commit("1-toxic", rollups.deletes(toxic))
    ledger.commit("2-lines", rollups.revisions(low, rollups.count_tokens(revised, versions)))
    ledger.commit("1-toxic", rollups.deletes(toxic), strict=True)
    return ledger.totals()


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), folder)
    records = warc.resolve_revisits(warc.read_records(spark, folder, with_payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(read_table(spark, sf_dir, "documents"),
                                              read_table(spark, sf_dir, "benchmark")).drop("spans")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract_pages(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, checked against rows of which a third by the CRC-32 of
    the id have their texts lower-cased (A-Z)."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", collocations.UPPER, collocations.LOWER)
    tampered = merkle.leaf_col([lowered if c == "text" else F.col(c) for c in columns])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = merkle.merkle_manifest(docs, columns, "lang", "doc_id", F.when(chosen, tampered))
    return found.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(read_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("grp", "lang")


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiindex.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat, op2_simhash, op3_quality, op4_urls, op5_secrets, op6_rollups, op7_warc,
                                    op8_decontaminate, op9_html, op10_packing, op11_merkle, op12_collocations, op13_embeddings,
                                    pipeline)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
