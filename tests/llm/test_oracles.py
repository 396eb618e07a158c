"""Registered queries against their DuckDB forms, on the small tables and on
awkward rows."""

import os
import sys

import pytest

from conftest import SF_SMALL
from trendlens.llm import queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
import compare  # noqa: E402


def same(spark, folder, name):
    df = queries.queries()[name](spark, folder)
    cur = compare.duck(folder).execute(queries.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = compare.rows_of([tuple(r) for r in df.collect()], df.columns)
    assert got == compare.rows_of(cur.fetchall(), cols)
    return got


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_small_tables(spark, name):
    assert same(spark, SF_SMALL, name)


def test_awkward_rows(spark, workdir):
    from llm.test_chat import corpus
    from llm.test_decontaminate import case
    from llm.test_multiindex import cases
    from llm.test_warc import pages

    docs, items = case()
    langs = ["en", None, "de", "en", ""]
    docs = [(d, t, langs[k % 5], "s" if k % 3 else None, k) for k, (d, t) in enumerate(docs)]
    vectors = [(*r, 0) for r in cases(7, 80) if r[1] is None or max([abs(x or 0) for x in r[1]] + [0]) < 1e30]
    for name, rows, schema in (("conversations", corpus(3), "conv_id long, turn long, role string, text string"),
                               ("pages", pages(), "page_id long, url string, html string"),
                               ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                               ("embeddings", vectors, "vec_id long, embedding array<double>, label long"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).toPandas().astype(
            {c.split()[0]: "Int64" for c in schema.split(", ") if c.endswith("long")}).to_parquet(
            os.path.join(workdir, f"{name}.parquet"))
    for name in queries.oracle_sql():
        same(spark, workdir, name)
