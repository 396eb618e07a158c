"""The corpus pipeline, stage by stage, on the small tables."""

import os
import subprocess
import sys

import corpus_pipeline
from conftest import SF_SMALL
from trendlens.llm import decontaminate, quality, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_take_effect(spark, workdir):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = table.columns, {}
    # One more document, of the corpus's own words in another order.
    words = " ".join(r.text for r in table.filter("lang = 'en' AND text NOT RLIKE '[#!|]'").limit(4).collect()).split()
    text = " ".join(words[::2] + ["password=b7db7aa4a5fcc78305"] + words[1::2])
    one = spark.createDataFrame([(10_000, text, "en", "src0", len(text))], table.schema)
    docs = whole = table.unionAll(one)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        path = os.path.join(workdir, str(k))
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = ({r.doc_id for r in before.collect()}, docs)
    ids = {n: (b, {r.doc_id for r in d.collect()}) for n, (b, d) in seen.items()}
    kept = {r.doc_id for r in quality.score_documents(whole, spark.read.parquet(
        f"{SF_SMALL}/labels.parquet")).filter("kept").collect()}
    assert ids["quality rules"][1] == kept
    before, after = ids["near duplicates"]
    assert after < before and min(before) in after
    before, after = ids["benchmark decontamination"]
    report = decontaminate.contamination_report(seen["near duplicates"][1], spark.read.parquet(
        f"{SF_SMALL}/benchmark.parquet"))
    assert before - after == {r.doc_id for r in report.filter("contaminated").collect()}
    before, after = ids["secret scans"]
    assert after == before  # redacted, not dropped
    mended = {r.doc_id: r for r in seen["secret scans"][1].collect()}[10_000]
    assert mended.text == text.replace("b7db7aa4a5fcc78305", "[SECRET]") and mended.n_chars == len(mended.text)
    before, after = ids["best-fit packing"]
    assert after == before


def test_run_applies_the_stages_to_the_table(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kept = quality.keep_good_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"),
                                       spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    found = {r.doc_id for r in rows.collect()}
    assert found and found <= {r.doc_id for r in kept.collect()}


def test_registered_once():
    names = list(queries.queries())
    assert [n for n in names if n == "pipeline"] == ["pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_library_does_not_need_the_subpackage():
    """Nothing outside imports it: the driver's entry works without it."""
    code = ("import sys, importlib.util as u; find = u.find_spec; "
            "u.find_spec = lambda n, *a: None if n == 'trendlens.llm' else find(n, *a); "
            "import __spark_entry__ as e; q = e.queries(); "
            "assert 'trends_10s' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q); "
            "assert not [m for m in sys.modules if m.startswith('trendlens.llm')]")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
