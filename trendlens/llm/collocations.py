"""Phrases that occur more often than their parts explain, by SETM.

Set-oriented mining over relations, one length after another:

* the occurrence relation ``R1(place, word)`` holds every occurrence of a
  frequent word; places number the words of a text with a gap between pieces
  and texts, so ``place + 1`` is the next word of the same piece.  It is
  persisted sorted by place, in blocks of whole texts of one group;
* ``Rk`` merge-joins ``R(k-1)`` with itself on the adjacent place: both sides
  are sorted, so the partner, if there is one, is the next row.  A row of
  ``Rk`` stands for a phrase of ``k`` words, by its first and its last
  ``k - 1`` words;
* a group count over all of ``Rk`` keeps the frequent phrases, and a
  semi-join of ``Rk`` with them, persisted again, is what the next length
  extends.

Only phrases whose parts are all frequent can be frequent, so pruning loses
nothing.  Blocks are worked on as arrays in Arrow batches; what is shuffled are
counts, summed per task first and sent as one packed row per task and range of
the reduction.  Words and phrases travel as numbers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import forget, python_workers, ranked, written

# Characters that end a piece, and those that only part words (fixed values).
PIECE_ENDS = ".,;:!?\n\v\f\r"
BLANKS = " \t"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text of a block (a longer text is a block of its own), and of all
# blocks that a task has open.
BLOCK_BYTES, OPEN_BYTES = 2 << 20, 16 << 20
# Frequent words, and frequent phrases, that every executor is sent at once
# (about 40 MB); more are met in as many passes as it takes.
WORDS_PER_PASS, PHRASES_PER_PASS = 1_000_000, 4_000_000
# Rows that a task sums before it sends them: words of blocks, and pairs; and
# pairs of one range of the reduction, repeats counted.
HELD_WORDS, HELD_PAIRS, RANGE_PAIRS = 500_000, 1_500_000, 1_000_000
# Parts in which the best phrases of a group are sought first.
RANK_PARTS = 32

SCORE_UNIT = 1_000_000


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype="uint8")
    table[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]
    table[[ord(c) for c in PIECE_ENDS]] = ord("\n")
    table[[ord(c) for c in BLANKS]] = ord(" ")
    return table


_BYTES = _byte_table()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, in order, and their places.

    Works on the UTF-8 bytes at once: what parts words and pieces is ASCII.
    The next word of the same piece has the next place; the end of a piece or
    of a text leaves a gap.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], "int64")[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or offsets[0] == offsets[-1]:
        return pa.array([], pa.large_string()), np.zeros(0, "int64")
    plain = _BYTES[np.frombuffer(texts.buffers()[2], "uint8")[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    ends = plain == 10
    inside = ~(ends | (plain == 32))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]  # first bytes of texts
    first[heads] = inside[heads]  # begin a word even after another text's last one
    starts = np.flatnonzero(first)
    if not len(starts):
        return pa.array([], pa.large_string()), np.zeros(0, "int64")
    place = (np.arange(len(starts)) + np.searchsorted(np.flatnonzero(ends), starts)
             + np.searchsorted(heads, starts, "right"))
    bounds = np.r_[0, np.cumsum(np.add.reduceat(inside, starts, dtype="int64"))]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(plain[inside].tobytes()))
    return words, place


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: differences, byte planes, Zstandard."""
    steps = np.diff(values.astype("int64"), prepend=np.int64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view("uint8").reshape(-1, 8).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), "uint8").reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("int64").ravel())


TEXT_BLOCK = "grp string, places binary, codes binary, words array<string>"


def _tokenise(block_bytes: int, open_bytes: int) -> Callable:
    """Blocks of one group's texts: places, and words as codes into the
    block's own list."""

    def block(grp: str, held: dict, sizes: dict) -> pa.RecordBatch:
        words, place = words_of(pa.concat_arrays(held.pop(grp)))
        sizes.pop(grp)
        coded = words.dictionary_encode()
        own = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()),
                                       coded.dictionary.cast(pa.string()))
        return pa.RecordBatch.from_arrays([
            pa.array([grp], pa.string()), pa.array([pack(place)], pa.binary()),
            pa.array([pack(coded.indices.to_numpy())], pa.binary()), own], names=["grp", "places", "codes", "words"])

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes = defaultdict(list), defaultdict(int)
        for batch in batches:
            for grp in pc.unique(batch["grp"]).to_pylist():
                texts = batch["text"].filter(pc.equal(batch["grp"], grp)).cast(pa.large_string())
                held[grp].append(texts)
                sizes[grp] += texts.nbytes
                if sizes[grp] >= block_bytes:
                    yield block(grp, held, sizes)
            while sum(sizes.values()) >= open_bytes:
                yield block(max(sizes, key=sizes.get), held, sizes)
        for grp in list(held):
            yield block(grp, held, sizes)

    return tokenise


def _count_words(held_rows: int) -> Callable:
    """Word counts, summed over the blocks of a task until ``held_rows``."""

    def summed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        total = pa.concat_tables(held).group_by(["grp", "word"]).aggregate([("n", "sum")])
        yield from total.select(["grp", "word", "n_sum"]).rename_columns(["grp", "word", "n"]).to_batches(100_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for grp, codes, words in zip(batch["grp"], batch["codes"], batch["words"]):
                n = np.bincount(unpack(codes.as_py()), minlength=len(words.values))
                held.append(pa.table({"grp": pa.repeat(grp, len(n)), "word": words.values, "n": n}))
                rows += len(n)
                if rows >= held_rows:
                    yield from summed(held)
                    held, rows = [], 0
        if rows:
            yield from summed(held)

    return count


OCCURRENCES = "block long, places binary, ids binary"


def _occurrences(block: int, place: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pack(place)], pa.binary()),
                                       pa.array([pack(ids)], pa.binary())], names=["block", "places", "ids"])


def _known_words(shared) -> Callable:
    """R1 of the words of one pass: a table (grp, word, id)."""

    def known(batches):
        groups: dict[str, tuple] = {}
        for batch in batches:
            for row in range(len(batch)):
                grp = batch["grp"][row].as_py()
                if grp not in groups:
                    own = shared.value.filter(pc.equal(shared.value["grp"], grp))
                    groups[grp] = own["word"].combine_chunks(), own["id"].to_numpy()
                listed, ids = groups[grp]
                found = pc.index_in(batch["words"][row].values, value_set=listed)
                number = np.append(ids, -1)[found.fill_null(-1).to_numpy()] if len(ids) else np.full(len(found), -1)
                codes = number[unpack(batch["codes"][row].as_py())]
                have = codes >= 0
                yield _occurrences(batch["block"][row].as_py(), unpack(batch["places"][row].as_py())[have], codes[have])

    return known


def _adjacent(places: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Merge join of a sorted relation with itself on the next place: places
    of the first rows, and both rows' numbers as one."""
    place, own = unpack(places), unpack(ids)
    at = np.flatnonzero(np.diff(place) == 1)
    return place[at], (own[at] << 32) | own[at + 1]


def _range_of(pairs: np.ndarray, ranges: int) -> np.ndarray:
    mixed = pairs.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(ranges)).astype("int64")


def _count_pairs(ranges: int, held_pairs: int) -> Callable:
    """Counts of adjacent pairs per task, packed by range of the reduction."""

    def summed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        part = _range_of(pairs, ranges)
        order = np.argsort(part, kind="stable")
        pairs, n = pairs[order], n[order]
        which, starts = np.unique(part[order], return_index=True)
        ends = np.r_[starts[1:], len(pairs)]
        for low in range(0, len(which), 1024):
            spans = list(zip(starts[low:low + 1024], ends[low:low + 1024]))
            yield pa.RecordBatch.from_arrays([
                pa.array(which[low:low + 1024], pa.int64()), pa.array([pack(pairs[a:b]) for a, b in spans], pa.binary()),
                pa.array([pack(n[a:b]) for a, b in spans], pa.binary())], names=["part", "pairs", "counts"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for places, ids in zip(batch["places"], batch["ids"]):
                held.append(_adjacent(places.as_py(), ids.as_py())[1])
                size += len(held[-1])
                if size >= held_pairs:
                    yield from summed(held)
                    held, size = [], 0
        if size:
            yield from summed(held)

    return count


def _frequent_pairs(least: int) -> Callable:
    def total(table: pa.Table) -> pa.Table:
        pairs = np.concatenate([unpack(v.as_py()) for v in table["pairs"]])
        n = np.concatenate([unpack(v.as_py()) for v in table["counts"]])
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        sums = np.add.reduceat(n, starts)
        keep = sums >= least
        return pa.table({"pair": pairs[starts][keep], "f": sums[keep]})

    return total


def _frequent_rows(shared) -> Callable:
    """Semi-join of the next relation with the frequent pairs of one pass (a
    sorted array and the number of its first); a phrase is numbered by its
    rank among all of them."""

    def frequent(batches):
        listed, first = shared.value
        for batch in batches:
            for block, places, ids in zip(batch["block"], batch["places"], batch["ids"]):
                place, pairs = _adjacent(places.as_py(), ids.as_py())
                at = np.minimum(np.searchsorted(listed, pairs), len(listed) - 1)
                have = listed[at] == pairs
                yield _occurrences(block.as_py(), place[have], at[have] + first)

    return frequent


def _merge_passes(table: pa.Table) -> pa.Table:
    place = np.concatenate([unpack(v.as_py()) for v in table["places"]])
    ids = np.concatenate([unpack(v.as_py()) for v in table["ids"]])
    order = np.argsort(place, kind="stable")
    return pa.Table.from_batches([_occurrences(table["block"][0].as_py(), place[order], ids[order])])


def _passes(blocks: DataFrame, keys: DataFrame, n: int, most: int, held: Callable, step: Callable, name: str) -> DataFrame:
    """The relation of the rows of ``blocks`` that meet ``keys`` (numbered by
    ``id`` in order, ``n`` of them), ``most`` of them sent and met at a time."""
    parts = []
    for low in range(0, max(n, 1), most):
        some = keys.filter((F.col("id") >= low) & (F.col("id") < low + most)).orderBy("id").toArrow()
        shared = blocks.sparkSession.sparkContext.broadcast(held(some))
        parts.append(written(blocks.mapInArrow(step(shared), OCCURRENCES), name))
        shared.destroy()
    if len(parts) == 1:
        return parts[0]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionAll(part)
    merged = written(together.groupBy("block").applyInArrow(_merge_passes, OCCURRENCES), name)
    for part in parts:
        forget(part)
    return merged


def _numbered(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """A written copy of ``rows`` with ``id``, their rank, and their number."""
    out = written(ranked(rows, [], order, f"{name}-order").withColumnRenamed("place", "id").drop("size"), name)
    n = out.count()
    if n >= 1 << 31:  # two numbers make one of 64 bits
        raise OverflowError(f"{n} frequent rows of one length; numbers end at 2^31")
    return out, n


def _ids(n: int, start: int = 1) -> list[str]:
    return [f"w{k}" for k in range(start, start + n)]


def _cut_score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(15,0)")  # noqa: E731  a product of two counts and the unit fits 38 digits
    return F.call_function("div", wide(a) * wide(a) * F.lit(SCORE_UNIT).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", max_words: int = 3, least: int = 10,
                 inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """``(grp, rank, phrase, a, l, r, n, score)``: per group its best ``top``
    phrases of 2 to ``max_words`` words that occur at least ``least`` times.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut
    (least ``floor(1000000 a a / (l r))``, the first of equal ones), ``n`` all
    words of the group.  A phrase whose words lie inside a longer one with
    ``100 f(longer) >= inside_percent * a`` is dropped.  Ranked by score, then
    ``a``, descending, then by phrase.

    Words are lower-cased (A-Z); ``.,;:!?`` and line breaks end a piece, and
    phrases lie within pieces.  A NULL text has no words, a NULL group is
    ``und``; repeated rows count as often as they are there; texts count
    whole; other columns are not read; an empty table gives no rows.
    """
    python_workers(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col(text).alias("text"))
    blocks = written(texts.mapInArrow(_tokenise(BLOCK_BYTES, OPEN_BYTES), TEXT_BLOCK).withColumn("block", F.monotonically_increasing_id()),
                     "phrase-texts")
    counts = written(blocks.mapInArrow(_count_words(HELD_WORDS), "grp string, word string, n long")
                     .groupBy("grp", "word").agg(F.sum("n").alias("f")), "phrase-words")
    totals = counts.groupBy("grp").agg(F.sum("f").alias("n"))
    total = counts.agg(F.sum("f")).first()[0] or 0
    words, n = _numbered(counts.filter(F.col("f") >= least), ["grp", "word"], "phrase-dictionary")
    occurs = _passes(blocks, words.select("grp", "word", "id"), n, WORDS_PER_PASS, lambda t: t, _known_words,
                     "phrase-occurs-1")
    forget(blocks)
    frequent = {1: words.select(F.col("id").alias("w1"), "f")}
    previous = words.select("id", F.col("id").alias("w1"))
    used = [counts, words]
    ranges = max(1, -(-total // RANGE_PAIRS))
    for k in range(2, max_words + 1):
        counted = occurs.mapInArrow(_count_pairs(ranges, HELD_PAIRS), "part long, pairs binary, counts binary")
        found, n = _numbered(counted.groupBy("part").applyInArrow(_frequent_pairs(least), "pair long, f long"), ["pair"],
                             f"phrases-{k}")
        first, last = previous.alias("first"), previous.alias("last")
        named = found.join(first, F.shiftright("pair", 32) == F.col("first.id")).join(
            last, F.col("pair").bitwiseAND((1 << 32) - 1) == F.col("last.id"))
        named = written(named.select(found["id"], *[F.col(f"first.{w}") for w in _ids(k - 1)],
                                     F.col(f"last.w{k - 1}").alias(f"w{k}"), "f"), f"phrases-{k}")
        frequent[k], previous = named.select(*_ids(k), "f"), named.select("id", *_ids(k))
        used += [found, named]
        if k < max_words:
            longer = _passes(occurs, found.select("id", "pair"), n, PHRASES_PER_PASS,
                             lambda t: (t["pair"].to_numpy(), t["id"][0].as_py()) if len(t) else (np.full(1, -1), 0),
                             _frequent_rows, f"phrase-occurs-{k}")
            forget(occurs)
            occurs = longer
    forget(occurs)

    found = None
    for k in range(2, max_words + 1):
        best = _named(_outside(_scored(frequent, k), frequent, k, max_words, inside_percent), words, k)
        found = best if found is None else found.unionByName(best)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First within parts of a group, so that at most RANK_PARTS * top rows of one meet.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("grp", part).orderBy(*order)))
    ranks = first.filter(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    result = written(ranks.filter(F.col("rank") <= top).join(totals, "grp").select(
        "grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "phrases")
    for table in used:
        forget(table)
    return result


def _scored(frequent: dict[int, DataFrame], k: int) -> DataFrame:
    """Phrases of ``k`` words with ``a`` and the ``l, r, score`` of their
    weakest cut."""
    rows, cuts = frequent[k].withColumnRenamed("f", "a"), []
    for cut in range(1, k):
        left = frequent[cut].withColumnRenamed("f", f"l{cut}")
        right = frequent[k - cut].select(*[F.col(x).alias(y) for x, y in zip(_ids(k - cut), _ids(k - cut, cut + 1))],
                                         F.col("f").alias(f"r{cut}"))
        rows = rows.join(left, _ids(cut)).join(right, _ids(k - cut, cut + 1))
        score = _cut_score(F.col("a"), F.col(f"l{cut}"), F.col(f"r{cut}"))
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"),
                             F.col(f"r{cut}").alias("r")))
    weakest = rows.withColumn("weakest", F.array_min(F.array(*cuts)))
    return weakest.select(*_ids(k), "a", "weakest.l", "weakest.r", "weakest.score")


def _outside(phrases: DataFrame, frequent: dict[int, DataFrame], k: int, max_words: int, percent: int) -> DataFrame:
    """``phrases`` of ``k`` words without those that a longer one covers."""
    parts = None
    for m in range(k + 1, max_words + 1):
        for start in range(1, m - k + 2):
            part = frequent[m].select(*[F.col(x).alias(y) for x, y in zip(_ids(k, start), _ids(k))], "f")
            parts = part if parts is None else parts.unionAll(part)
    if parts is None:
        return phrases
    cover = parts.groupBy(*_ids(k)).agg(F.max("f").alias("cover"))
    return phrases.join(cover, _ids(k), "left").filter(
        F.coalesce(F.lit(100) * F.col("cover") < F.lit(percent) * F.col("a"), F.lit(True))).drop("cover")


def _named(phrases: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Phrases with their group and words in place of the numbers."""
    for j in range(1, k + 1):
        word = words.select(F.col("id").alias(f"w{j}"), F.col("word").alias(f"word{j}"),
                            *([F.col("grp")] if j == 1 else []))
        phrases = phrases.join(word, f"w{j}")
    return phrases.select("grp", F.concat_ws(" ", *[f"word{j}" for j in range(1, k + 1)]).alias("phrase"),
                          "a", "l", "r", "score")
