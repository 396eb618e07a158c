"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length one and cut into halves.  Each half has its own
codebook; the product of the two is a grid of ``K * K`` cells, and every
vector is stored in the cell of its two nearest codewords.  A query visits
cells in the order of the sum of its squared distances to the two codewords
(multi-sequence traversal) until the sum exceeds its least one by ``slack``;
in the cells it visits, cosines in double precision decide.

``slack`` is fitted: for sampled vectors, worst-case neighbours (at exactly
the threshold, in random directions) are made, and the share ``recall`` of
them must be met within it.  A pair is found if either of the two visits the
other, so the recall of links is higher still.

Rows of the grid (equal first codeword) are the unit of exchange: a vector is
stored once and sent once to every row that it visits, with what is left of
its budget there.  Rows with many vectors are dealt as a grid of blocks of
stored and visiting vectors, so no task holds more than two blocks.  A task
returns a count and a local component per vector, never the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import bounded_sample, forget, python_workers, written
from trendlens.llm.graph import connected_components

LEAST = 0.95
RECALL = 0.995
# Vectors that the codebooks and the slack are fitted on, at most.
SAMPLE = 20_000
# Stored vectors a cell should hold, and codewords of a half at most.
CELL, MOST_CODES = 16, 1024
# Stored and visiting vectors of one block.
BLOCK = 4096
STEPS = 10


@dataclass(frozen=True)
class Index:
    """Codebooks of the two halves, and the slack of the traversal."""

    first: np.ndarray
    second: np.ndarray
    slack: float

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _squared(units[:, :half], self.first), _squared(units[:, half:], self.second)


def _squared(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances less the points' own squared lengths."""
    return (codes * codes).sum(1) - 2.0 * points @ codes.T


def unit_rows(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(1, keepdims=True)  # no overflow in the squares
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def _codebook(points: np.ndarray, codes: int) -> np.ndarray:
    """Lloyd's k-means from evenly spread sample points."""
    book = points[np.linspace(0, len(points) - 1, codes).astype(int)].copy()
    for _ in range(STEPS):
        nearest = _squared(points, book).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=codes)
        book[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return book


def fit_index(sample: np.ndarray, n: int, least: float = LEAST, recall: float = RECALL) -> Index:
    """An index for ``n`` vectors, fitted on the rows of ``sample``."""
    units = unit_rows(sample.astype("float64"))
    codes = int(max(1, min(MOST_CODES, round((n / CELL) ** 0.5), len(units))))
    half = units.shape[1] // 2
    index = Index(_codebook(units[:, :half], codes), _codebook(units[:, half:], codes), 0.0)
    away = np.random.default_rng(0).normal(size=units.shape)
    away -= (away * units).sum(1, keepdims=True) * units
    away /= np.maximum(np.sqrt((away * away).sum(1, keepdims=True)), 1e-300)
    u, v = index.distances(least * units + (1.0 - least * least) ** 0.5 * away)
    i, j = (d.argmin(1) for d in index.distances(units))
    row = np.arange(len(units))
    excess = u[row, i] - u.min(1) + v[row, j] - v.min(1)
    return Index(index.first, index.second, float(np.quantile(excess, recall, method="higher")) + 1e-9)


def usable_col(vector: Column) -> Column:
    """Whether a vector can have a cosine: not NULL or empty, all components
    finite numbers, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype("float64")


VISITS = "dim int, grid_row int, stored boolean, node long, weight long, cell int, budget double, vector array<{}>"


def _send(indexes: dict[int, Index]):
    """Every vector to the grid row that stores it and to those it visits."""

    def send(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in np.unique(table["dim"].to_numpy()):
                own = table.filter(pa.compute.equal(table["dim"], int(dim)))
                u, v = indexes[int(dim)].distances(unit_rows(_matrix(own["vector"])))
                i, j, least = u.argmin(1), v.argmin(1), v.min(1)
                # Budget left for the second codeword in each grid row.
                budget = u.min(1)[:, None] + least[:, None] + indexes[int(dim)].slack - u
                who, where = np.nonzero(budget >= least[:, None])
                row = np.arange(len(own))
                take = np.concatenate([row, who])
                mark = np.arange(len(take)) < len(row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(take), dim), pa.int32()),
                    pa.array(np.concatenate([i, where]), pa.int32()),
                    pa.array(mark),
                    own["node"].take(pa.array(take)).combine_chunks(),
                    own["weight"].take(pa.array(take)).combine_chunks(),
                    pa.array(np.concatenate([j, np.zeros(len(who), int)]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(row)), budget[who, where]]), pa.float64()),
                    own["vector"].take(pa.array(take)).combine_chunks(),
                ], names=["dim", "grid_row", "stored", "node", "weight", "cell", "budget", "vector"])

    return send


FOUND = "node long, links long, root long"


def _verify(indexes: dict[int, Index], least: float):
    """Counts and local components of one block of a grid row."""

    def verify(table: pa.Table) -> pa.Table:
        dim, here = table["dim"][0].as_py(), table["grid_row"][0].as_py()
        index = indexes[dim]
        stored = table.filter(table["stored"]).sort_by("cell")
        visits = table.filter(pa.compute.invert(table["stored"]))
        x, q = unit_rows(_matrix(stored["vector"])) if len(stored) else None, None
        if len(visits):
            q = unit_rows(_matrix(visits["vector"]))
        if x is None or q is None:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()),
                             "root": pa.array([], pa.int64())})
        x_node, q_node = stored["node"].to_numpy(), visits["node"].to_numpy()
        x_weight, q_weight = stored["weight"].to_numpy(), visits["weight"].to_numpy()
        budget, cell = visits["budget"].to_numpy(), stored["cell"].to_numpy()
        qu, qv = index.distances(q)
        xu, xv = index.distances(x)
        q_row, q_cell = qu.argmin(1), qv.argmin(1)
        x_reach = xu.min(1) + xv.min(1) + index.slack
        nodes = np.unique(np.concatenate([x_node, q_node]))
        x_at, q_at = np.searchsorted(nodes, x_node), np.searchsorted(nodes, q_node)
        links, root = np.zeros(len(nodes), "int64"), np.arange(len(nodes))
        met = np.zeros(len(nodes), bool)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], len(cell)]):
            asks = np.flatnonzero(qv[:, cell[start]] <= budget)
            for low in range(0, len(asks), 1024):
                some = asks[low:low + 1024]
                a, b = np.nonzero(q[some] @ x[start:end].T >= least)
                a, b = some[a], start + b
                other = q_at[a] != x_at[b]
                a, b = a[other], b[other]
                if not len(a):
                    continue
                # The stored one counts the visitor itself if it visits the visitor's cell.
                alone = xu[b, q_row[a]] + xv[b, q_cell[a]] > x_reach[b]
                left, right = q_at[a], x_at[b]
                links += _summed(left, x_weight[b], len(nodes)) + _summed(right[alone], q_weight[a[alone]], len(nodes))
                met[left] = met[right] = True
                apart = root[left] != root[right]
                _join(root, left[apart], right[apart])
        return pa.table({"node": nodes[met], "links": links[met], "root": nodes[root[met]]})

    return verify


def _summed(at: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights, n).astype("int64")  # sums below 2^53 are exact


def _join(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give all nodes linked by ``left, right`` their component's least root."""
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root[:] = root[root]
        if (root == before).all():
            return


def _blocks(sent: DataFrame) -> DataFrame:
    """Rows of ``sent`` dealt to blocks: a grid row of ``s`` stored and ``v``
    visiting vectors is a grid of ``s / BLOCK`` by ``v / BLOCK`` tasks."""
    side = lambda mark: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("stored") == mark) / BLOCK)).cast("int")
    sizes = sent.groupBy("dim", "grid_row").agg(side(True).alias("n_stored"), side(False).alias("n_visits"))
    rows = sent.join(sizes, ["dim", "grid_row"])
    own = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    down = F.when(F.col("stored"), own("n_stored")).otherwise(every("n_stored"))
    across = F.when(F.col("stored"), every("n_visits")).otherwise(own("n_visits"))
    return rows.withColumn("block_row", F.explode(down)).withColumn("block_col", F.explode(across))


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           least: float = LEAST, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """``(id, n_links, component_id)`` for every row of ``vectors``.

    ``n_links`` counts the other rows with a cosine of at least ``least``;
    ``component_id`` is the smallest id that links reach, the own included.
    Equal vectors are folded before the index and always link.  The index
    holds every vector; codebooks and slack are fitted on ``sample`` of them,
    chosen by hash.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing; vectors of different lengths do not link (every length
    has an index of its own, fitted on the driver in turn).  Rows with a NULL
    or repeated id count as rows of their own; a NULL id is no component's
    smallest unless no other is in it.  Other columns are not read; an empty
    table gives no rows.
    """
    python_workers(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    usable = rows.filter(usable_col(F.col("vector")))
    nodes = written(usable.groupBy("vector").agg(F.count("*").alias("weight"), F.min("id").alias("least_id"))
                    .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")}), "vector-nodes")
    indexes = {}
    for dim, n in [(r["dim"], r["n"]) for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()]:
        some = bounded_sample(nodes.filter(F.col("dim") == dim).select("vector"), ["vector"], sample).toArrow()
        indexes[dim] = fit_index(_matrix(some["vector"]), n, least, recall)
    kind = nodes.schema["vector"].dataType.elementType.simpleString()
    sent = written(nodes.select("dim", "node", "weight", "vector").mapInArrow(_send(indexes), VISITS.format(kind)),
                   "vector-visits")
    found = written(_blocks(sent).groupBy("dim", "grid_row", "block_row", "block_col")
                    .applyInArrow(_verify(indexes, least), FOUND), "vector-links")
    forget(sent)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = written(nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "node", "vector", "weight", "least_id", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "node").alias("root")), "vector-known")
    least_ids = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = known.join(least_ids, "root").select(
        "vector", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    alone = rows.filter(~usable_col(F.col("vector"))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return usable.join(classes, "vector").select("id", "n_links", "component_id").unionAll(alone)
