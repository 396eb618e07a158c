"""Merkle manifest of a table: a digest per row, a tree per group, one root.

Every row is a leaf, a SHA-256 over its columns.  The leaves of a group (NULL
is a group) are ordered; while a group has several nodes, every ``FANOUT``
consecutive ones (the last run may be shorter, down to one) become the digest
of their hex digests.  What remains is the group's subroot; the subroots,
ordered by group, are reduced likewise to the root of the manifest.

The trees are cut into superblocks of ``FANOUT ** HEIGHT`` consecutive nodes:

* up: ``applyInPandas`` per superblock folds its nodes to one, round after
  round, until a tree has one node left (a round divides by 4,096, so three
  rounds do for 6 * 10^10 leaves);
* down: nodes and the outer nodes their superblock needs (the siblings of its
  root on the way to the manifest's root) are cogrouped by superblock in
  ``applyInPandas``.  One call finishes the reduction inside the superblock,
  joins inner and outer siblings to proofs, and, for leaves, folds the proof.

No task holds more than a superblock however the groups are dealt, ranks come
from range partitions (:func:`ranked`), and every round is a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import forget, python_workers, ranked, written

# Children of a node, and levels that one superblock folds.
FANOUT, HEIGHT = 8, 4
HEX = 64

NODES = "tree string, size long, place long, hash string"
OUTER = "tree string, block long, proof string, root string, subroot string, tree_place long, trees long"
PROOFS = ("tree string, id string, leaf string, place long, size long, tree_place long, trees long, subroot string, "
          "root string, proof string, folded_root string")


def leaf_col(columns: Sequence[Column]) -> Column:
    """Leaf digest: per column ``-`` if NULL, else its UTF-8 length, ``:`` and
    its value, concatenated; SHA-256 as lower-case hex."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def levels(size: int, height: int = HEIGHT) -> int:
    """Levels that one superblock of a tree of ``size`` nodes folds."""
    if size > FANOUT ** height:
        return height
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


def reduce_block(nodes: list[str], height: int) -> tuple[str, list[str]]:
    """Root of a superblock's ``nodes`` after ``height`` levels, and for every
    node the siblings on its way there, concatenated level by level."""
    if not height:
        return nodes[0], [""]
    parents, beside = [], []
    for start in range(0, len(nodes), FANOUT):
        run = "".join(nodes[start:start + FANOUT])
        parents.append(digest(run))
        beside.extend(run[:k] + run[k + HEX:] for k in range(0, len(run), HEX))
    root, above = reduce_block(parents, height - 1)
    return root, [own + above[k // FANOUT] for k, own in enumerate(beside)]


def fold_proof(leaf: str, proof: str, shape: Sequence[tuple[int, int]]) -> str:
    """Root that follows from a leaf and its proof; ``shape`` is ``(place,
    size)`` of the leaf in its tree and of the tree among the trees."""
    at, node = 0, leaf
    for place, size in shape:
        while size > 1:
            left = place % FANOUT
            beside = min(FANOUT, size - (place - left)) - 1
            own = proof[at:at + HEX * beside]
            node = digest(own[:HEX * left] + node + own[HEX * left:])
            at, place, size = at + HEX * beside, place // FANOUT, -(-size // FANOUT)
    if at != len(proof):
        raise ValueError("proof does not fit the shape of the tree")
    return node


def _block_root(height: int):
    def root(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size, nodes = int(rows["size"].iloc[0]), rows.sort_values("place")["hash"].tolist()
        top, _ = reduce_block(nodes, levels(size, height))
        return pd.DataFrame({"tree": [key[0]], "size": [-(-size // FANOUT ** height)], "place": [int(key[1])],
                             "hash": [top]})

    return root


def _inner_paths(rows: pd.DataFrame, outer: pd.DataFrame, height: int) -> tuple[pd.DataFrame, list[str], pd.Series]:
    """Nodes of a superblock in order, their whole proofs, the outer row."""
    rows, above = rows.sort_values("place"), outer.iloc[0]
    _, paths = reduce_block(rows["hash"].tolist(), levels(int(rows["size"].iloc[0]), height))
    return rows, [p + above["proof"] for p in paths], above


def _extend(height: int):
    """Outer rows of the superblocks below, one per node."""

    def extend(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, proofs, above = _inner_paths(rows, outer, height)
        return pd.DataFrame({"tree": key[0], "block": rows["place"].to_numpy(), "proof": proofs, "root": above["root"],
                             "subroot": above["subroot"], "tree_place": int(above["tree_place"]),
                             "trees": int(above["trees"])})

    return extend


def _finish(height: int):
    """Proofs of the leaves, and the roots that they fold to."""

    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, proofs, above = _inner_paths(rows, outer, height)
        tree = (int(above["tree_place"]), int(above["trees"]))
        size = int(rows["size"].iloc[0])
        folded = [fold_proof(now, proof, ((place, size), tree))
                  for now, proof, place in zip(rows["claimed"], proofs, rows["place"].tolist())]
        return pd.DataFrame({"tree": key[0], "id": rows["id"].to_numpy(), "leaf": rows["hash"].to_numpy(),
                             "place": rows["place"].to_numpy(), "size": size, "tree_place": tree[0], "trees": tree[1],
                             "subroot": above["subroot"], "root": above["root"], "proof": proofs,
                             "folded_root": folded})

    return finish


def _blocks(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.expr(f"place div {FANOUT ** height}")).groupBy("tree", "block")


def _reduce(nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """Tables of nodes from ``nodes`` (tree, size, place, hash) up to one node
    per tree; all trees take the rounds of the largest, a lone node stays."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    tables = [nodes]
    while True:
        tables.append(written(_blocks(tables[-1], height).applyInPandas(_block_root(height), NODES), f"{name}-up"))
        largest = -(-largest // FANOUT ** height)
        if largest <= 1:
            return tables


def _descend(tables: list[DataFrame], top: DataFrame, name: str, height: int) -> DataFrame:
    """Outer rows of the superblocks of ``tables[0]``, from those of the top."""
    outer = top
    for nodes in reversed(tables[1:-1]):
        outer = written(_blocks(nodes, height).cogroup(outer.groupBy("tree", "block"))
                        .applyInPandas(_extend(height), OUTER), f"{name}-down")
    return outer


def merkle_manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                    group: str = "lang", order: str = "doc_id", claimed: Column | None = None,
                    height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: ``id`` (``order`` as a string), ``leaf``,
    ``place`` and ``size`` of its tree, ``tree_place`` and ``trees`` of the
    manifest, ``subroot``, ``root``, ``proof`` (siblings from the leaf's run to
    the root's, left to right) and ``folded_root``, the root that follows from
    the proof and the leaf of the ``claimed`` row (a leaf digest column; the
    own leaf where it is NULL or not given).

    ``height`` is that of a superblock, whose nodes one task holds.

    Leaves of a group ascend by ``order`` (NULL first) and, where that ties, by
    digest; equal rows have equal leaves, each with its own place.  A NULL
    group comes before all others, the empty string included.  NULL columns
    and empty or very long texts are values like others; columns not in
    ``columns`` do not count, whatever their names.  An empty table gives no
    rows.
    """
    python_workers(docs.sparkSession)
    leaf = leaf_col([F.col(c) for c in columns])
    # Tree names are never NULL, and sort like the groups, NULL first.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = written(docs.select(tree.alias("tree"), F.col(order).alias("by"), leaf.alias("hash"),
                                 (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed")),
                     "merkle-leaves")
    placed = ranked(leaves, ["tree"], ["by", "hash"], "merkle-order")
    placed = written(placed.select("tree", "size", "place", "hash", F.col("by").cast("string").alias("id"),
                                   F.coalesce("claimed", "hash").alias("claimed")), "merkle-placed")
    forget(leaves)
    tables = _reduce(placed, "merkle", height)
    # The subroots are the leaves of one more tree.
    subroots = ranked(tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("id"), "hash"), ["tree"], ["id"],
                      "merkle-trees")
    subroots = written(subroots.select("tree", "size", "place", "hash", "id", F.col("hash").alias("claimed")),
                       "merkle-subroots")
    forest = _reduce(subroots, "merkle-forest", height)
    top = forest[-1].select("tree", F.col("place").alias("block"), F.lit("").alias("proof"), F.col("hash").alias("root"),
                            F.lit("").alias("subroot"), F.lit(0).cast("long").alias("tree_place"),
                            F.lit(1).cast("long").alias("trees"))
    above = _blocks(subroots, height).cogroup(
        _descend(forest, top, "merkle-forest", height).groupBy("tree", "block")).applyInPandas(_finish(height), PROOFS)
    outer = written(above.select(F.col("id").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", "root",
                                 F.col("leaf").alias("subroot"), F.col("place").alias("tree_place"),
                                 F.col("size").alias("trees")), "merkle-outer")
    inner = _descend(tables, outer, "merkle", height)
    return _blocks(placed, height).cogroup(inner.groupBy("tree", "block")).applyInPandas(_finish(height), PROOFS)
