"""SimHash near-duplicate detection by anchor-point covering.

A fingerprint has 64 bits and two fingerprints link at three or fewer
differing bits.  Three bits over two 32-bit halves leave at most one in one
of them.  In each half the code words of the perfect [31, 26] Hamming code,
times the free 32nd bit, are the anchors: a covering code of radius 1.  A
fingerprint has one home anchor per half (the one within radius 1) and
probes every anchor within radius + 1 = 2 (17 at most).  Whenever the halves
of ``x`` and ``y`` differ in one bit or none, the home of ``x`` lies within 2
of ``y``, so an equi-join of homes with probes meets every linking pair; the
bits are then counted.  There are 2^27 anchors per half, so one anchor holds
few fingerprints beyond true neighbours.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import numbered, python_workers, written
from trendlens.llm.graph import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HASH_SEED = 42
_CHUNK = 1 << 16  # hashes whose bits are unpacked at a time


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one text.

    Words are runs of anything but ASCII white space in the text with A-Z
    lowered; shingles of ``shingle`` words joined by a space, repeats
    included (fewer words: all of them, no word: 0).  A bit is set if it is
    set in more than half of the shingles' XXH64 values.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    digest, ones, left = xxhash.xxh64_intdigest, np.zeros(64, np.int64), n
    while left:
        k = min(left, _CHUNK)
        h = np.fromiter(map(digest, islice(grams, k), repeat(HASH_SEED)), np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(k, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= k
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.int64)[0])


def fingerprint_col(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _half(fp: Column, which: int) -> Column:
    return (fp if which == 0 else F.shiftrightunsigned(fp, 32)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def _syndrome(half: Column) -> Column:
    """XOR of the 1-based positions of the set bits among the low 31."""
    out = F.lit(0)
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)
        out = out + (F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))) % 2) * (1 << j)
    return out.cast("int")


def _flip(position: Column) -> Column:
    """Mask of a 1-based position; position 0 flips nothing."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), position - 1)
    return F.when(position == 0, F.lit(0).cast("long")).otherwise(mask)


def _anchors(fps: DataFrame) -> DataFrame:
    """Each fingerprint twice, once per half, with the half and its syndrome."""
    rows = F.array(*(F.struct(F.lit(w).alias("side"), _half(F.col("fp"), w).alias("half")) for w in (0, 1)))
    return (fps.select("fp", F.explode(rows).alias("r")).select("fp", "r.side", "r.half")
            .withColumn("s", _syndrome(F.col("half"))))


def _key(anchor: Column) -> Column:
    return (anchor * 2 + F.col("side")).alias("anchor")


def home_anchors(fps: DataFrame) -> DataFrame:
    """``(anchor, fp)``: the one anchor per half within the covering radius."""
    return _anchors(fps).select(_key(F.col("half").bitwiseXOR(_flip(F.col("s")))), "fp")


def probe_anchors(fps: DataFrame) -> DataFrame:
    """``(anchor, fp)``: every anchor per half within covering radius + 1."""
    top = F.lit(1 << 31).cast("long")
    home = F.col("half").bitwiseXOR(_flip(F.col("s")))

    def pair(p: Column) -> Column:
        other = p.bitwiseXOR(F.col("s"))
        return F.when((F.col("s") != 0) & (p < other),
                      F.col("half").bitwiseXOR(_flip(p)).bitwiseXOR(_flip(other)))

    near = F.array(home, home.bitwiseXOR(top), *(pair(F.lit(p)) for p in range(1, 32)))
    return (_anchors(fps).select("fp", "side", F.explode(F.array_compact(near)).alias("near"))
            .select(_key(F.col("near")), "fp"))


def fingerprint_links(fps: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Every pair ``(a, b)``, a < b, of distinct fingerprints ``fps(fp)`` that
    differ in at most ``distance`` (0 to 3) bits, each pair once.

    A pair whose low halves differ in one bit or none is taken at the low
    half's anchor, any other at the high half's, so no deduplication follows.
    Both sides of the join are exchanged by anchor, where adaptive execution
    splits an anchor that holds much of the table.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must lie in 0..{MAX_DISTANCE}")
    home = home_anchors(fps).select("anchor", F.col("fp").alias("a"))
    probe = probe_anchors(fps).select("anchor", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    low_bits = F.bit_count(_half(diff, 0))
    own_side = F.when(F.col("anchor") % 2 == 0, low_bits <= 1).otherwise(low_bits > 1)
    return (home.join(probe, "anchor")
            .filter((F.col("a") < F.col("b")) & (F.bit_count(diff) <= distance) & own_side)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(id, fp, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` bits, the row itself included.  Rows with equal fingerprints
    are folded into one node before any pair is formed, so a group of copies
    costs one node.  A NULL or empty text has fingerprint 0 and links like
    any other; a NULL id counts as larger than every id (a component with
    none but NULL ids has NULL); repeated ids and repeated rows each give
    their own row; extra columns are ignored; an empty table gives no rows.
    """
    python_workers(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).alias("id"), fingerprint_col(F.col(text_col), shingle).alias("fp")),
                   "simhash")
    groups = fingerprint_groups(rows, distance)
    return (rows.join(groups.select("fp", F.col("component_id").alias("_c")), "fp", "left")
            .select("id", "fp", F.coalesce("_c", "id").alias("component_id")))


def fingerprint_groups(rows: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(fp, root, component_id)`` for each fingerprint of the written table
    ``rows(id, fp)`` that more than one row shares or that links to another;
    ``root`` is the smallest fingerprint of the component."""
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    links = written(fingerprint_links(nodes.select("fp"), distance), "simhash-links")
    roots = written(connected_components(links), "simhash-roots")
    linked = roots.join(nodes, roots.node == nodes.fp).select("fp", "root", "least")
    tops = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-tops")
    alone = nodes.filter("n > 1").join(roots.select(F.col("node").alias("fp")), "fp", "left_anti")
    return written(linked.join(tops, "root").select("fp", "root", "component_id")
                   .unionAll(alone.select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))),
                   "simhash-groups")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with
    the smallest ``doc_id`` (NULL ids last; of repeated ids any one row).

    Only fingerprints, ids and row keys are grouped and joined, never texts
    (see :func:`numbered`).  Every column is returned as it came.
    """
    python_workers(docs.sparkSession)
    keyed, keys = numbered(docs, "simhash-docs")
    row = F.struct(*keys).alias("row")
    rows = written(keyed.select(F.col("doc_id").alias("id"), fingerprint_col(F.col("text"), shingle).alias("fp"), row),
                   "simhash")
    members = written(rows.join(fingerprint_groups(rows, distance), "fp").select("id", "root", "row"),
                      "simhash-members")
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))
    first = written(members.groupBy("root").agg(F.min(rank)["row"].alias("first")), "simhash-first")
    gone = members.join(first.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).filter("row <> first")
    return keyed.join(written(gone.select("row.*"), "simhash-gone"), keys, "left_anti").select(*docs.columns)
