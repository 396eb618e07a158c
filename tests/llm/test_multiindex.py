"""Vector near duplicates against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from trendlens.llm import multiindex, queries


def brute(vectors, least=0.95):
    """Links and components of (id, vector) rows by comparing all pairs."""
    ok = [k for k, (_, v) in enumerate(vectors) if v is not None and len(v) and None not in v
          and np.isfinite(v).all() and np.any(np.asarray(v) != 0)]
    root, links = list(range(len(vectors))), [0] * len(vectors)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(ok)):
        for y in range(x):
            a, b = (np.asarray(vectors[k][1], "float64") for k in (ok[x], ok[y]))
            if len(a) == len(b) and (a / np.abs(a).max()) @ (b / np.abs(b).max()) / np.linalg.norm(
                    a / np.abs(a).max()) / np.linalg.norm(b / np.abs(b).max()) >= least:
                links[ok[x]] += 1
                links[ok[y]] += 1
                root[find(ok[x])] = find(ok[y])
    least_id = {}
    for k, (i, _) in enumerate(vectors):
        r = find(k)
        if i is not None:
            least_id[r] = min(i, least_id.get(r, i))
    return [(i, links[k], least_id.get(find(k)), i == least_id.get(find(k))) for k, (i, _) in enumerate(vectors)]


def near(rng, base, cosine):
    away = rng.normal(size=base.shape)
    away -= away @ base * base
    return cosine * base + (1 - cosine ** 2) ** 0.5 * away / np.linalg.norm(away)


def cases(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    add = lambda v: rows.append((len(rows), np.asarray(v).tolist()))
    for k in range(40):  # pairs just above, just below, scaled and equal
        add(near(rng, base[k], 0.9501))
        add(near(rng, base[k], 0.9499))
    add(base[7] * 1e-200)
    add(base[8] * 1e200)
    add(base[9])
    add(base[9])
    link = base[50]
    for _ in range(12):  # a chain: neighbours link, ends do not
        link = near(rng, link, 0.96)
        add(link)
    for _ in range(60):  # a large group
        add(near(rng, base[60], 0.985))
    rows += [(1000, None), (1001, []), (1002, [0.0] * dim), (1003, [float("nan")] * dim), (1004, [None] + [1.0] * (dim - 1)),
             (1005, [float("inf")] + [0.0] * (dim - 1)), (None, base[3].tolist()), (4, base[3].tolist()),
             (1006, [1.0]), (1007, [2.0]), (1008, [-1.0]), (1009, [1.0, 1.0]), (1010, [1.0, 1.01]), (None, [0.0, 0.0])]
    return rows


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(multiindex, "BLOCK", block)  # 16: hot rows are dealt to many tasks
    rows = cases(3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = [(r.id, r.n_links, r.component_id, r.id == r.component_id)
           for r in multiindex.near_duplicate_vectors(df).collect()]
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_query_on_floats_with_clashing_columns(spark, workdir):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
            for i, v in cases(5, 120) if v is None or not v or max(abs(x or 0) for x in v) < 1e30]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS label", "'x' AS node", "2 AS vector", "3 AS weight", "4 AS links", "5 AS dim", "6 AS id")
    df.write.parquet(f"{workdir}/embeddings.parquet")
    got = queries.op13_embeddings(spark, workdir)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = [(i, n, c, i == c) for i, n, c, _ in brute(rows)]
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_recall_of_the_traversal():
    """One direction alone meets the target on neighbours at the threshold,
    within a small part of the grid."""
    rng = np.random.default_rng(1)
    x = multiindex.unit_rows(rng.normal(size=(6000, 64)))
    index = multiindex.fit_index(x, 50_000)
    own = x[:2000]
    asks = np.stack([near(rng, v, 0.95) for v in own])
    u, v = index.distances(asks)
    i, j = (d.argmin(1) for d in index.distances(own))
    row = np.arange(len(own))
    met = u[row, i] + v[row, j] <= u.min(1) + v.min(1) + index.slack
    assert met.mean() >= 0.985
    visited = (u[:, :, None] + v[:, None, :] <= (u.min(1) + v.min(1) + index.slack)[:, None, None]).mean()
    assert visited < 0.05


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert multiindex.near_duplicate_vectors(df).collect() == []
    only = spark.createDataFrame([(1, None), (None, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(str, map(tuple, multiindex.near_duplicate_vectors(only).collect()))) == [
        "(1, 0, 1)", "(None, 0, None)"]


def test_matrix_of_a_chunked_column():
    column = pa.chunked_array([pa.array([[1.0, 2.0]]), pa.array([[3.0, 4.0], [5.0, 6.0]]).slice(1)])
    assert multiindex._matrix(column).tolist() == [[1, 2], [5, 6]]
