"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

from conftest import SF_SMALL
from trendlens.plans import catalog


NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck():
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location(
        "compare", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "compare.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_every_query_has_an_oracle():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    s_rows = duck.rows_of([tuple(r) for r in df.collect()], df.columns)
    con = duck.duck(SF_SMALL)
    cur = con.execute(catalog.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    d_rows = duck.rows_of(cur.fetchall(), cols)
    assert sorted(cols) == sorted(df.columns)
    assert s_rows == d_rows
