"""Best-fit-decreasing packing of tokenized documents into fixed sequences.

Best fit depends on lengths alone and a length is one of ``1..capacity``, so
the packing of the whole corpus is planned from its length histogram: lengths
in decreasing order, each document into the open bin with the smallest
remaining capacity that takes it, found in a segment tree over the remaining
capacities.  Documents of one length that meet bins with the same history are
placed in one step, which gives the very bins that one-by-one placement
gives.  The plan (ranges of documents onto ranges of bins) is bounded by the
capacity, not by the corpus; every task then looks up its own documents.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import python_workers, written

CAPACITY = 2048
END_ID = 0
# Words, and parts of words, whose ids a Python worker keeps at least, and
# twice at most.
CACHE_WORDS = 250_000
# ASCII punctuation but for the apostrophe, which the tokenizer joins to letters.
PUNCTUATION = string.punctuation.replace("'", "")
# Up to here letters are single code points in normal form C and lower-case one
# by one; words with others are left to the tokenizer's own normalizer.
LAST_PLAIN = "\u024f"

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the other bytes, in order, for
    the characters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


class WordEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The tokenizer never joins what ASCII white space separates (its
    normalizer and its pre-tokenizer treat white space as a boundary and drop
    it), so the ids of a text are the ids of its white-space-separated words
    in order.  Nor does it join letters with the punctuation around them, so a
    word of letters between ASCII punctuation has the ids of its parts, and
    such a part (lowered, its bytes written as letters) goes straight to the
    tokenizer's merges.  Any other word is encoded as it is.

    Words and parts seen before are looked up.  Each table has two
    generations of at most ``cache_words`` entries; when the younger one is
    full it becomes the older one, so what is met often stays.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.most = cache_words
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_words: dict[bytes, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.letters = byte_letters()

    def encode(self, text: str | None) -> bytes:
        words = (text or "").encode().split()
        found = list(map(self.words.get, words))
        if None in found:
            learned = self._learn({w for w, ids in zip(words, found) if ids is None})
            found = [learned[w] if ids is None else ids for w, ids in zip(words, found)]
        return b"".join(found)

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        if len(self.words) > self.most:
            self.words, self.older_words = {}, self.words
        if len(self.parts) > self.most:
            self.parts, self.older_parts = {}, self.parts
        older, out = self.older_words, {}
        for word in words:
            out[word] = older.get(word) or self._word(word)
        self.words.update(out)
        return out

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        core = text.strip(PUNCTUATION)
        if not core.isalpha() or max(core) > LAST_PLAIN or "\u0130" in core or "<|" in text:
            return self._whole(text)
        if len(core) == len(text):
            return self._part(core)
        at = text.index(core)
        return self._part(text[:at]) + self._part(core) + self._part(text[at + len(core):])

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.older_parts.get(part)
            if ids is None:
                if part.isascii():
                    plain = part.lower()
                else:
                    letters = self.letters
                    plain = "".join([letters[b] for b in "".join([c.lower() for c in part]).encode()])
                tokens = self.merge(plain) if plain else ()
                ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            self.parts[part] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per tokenizer file and Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids then id 0, cut after each
    ``capacity`` ids.  ``task`` and ``place`` number the pieces of one length
    within the task that made them."""
    path, spark = tokenizer or default_tokenizer(), docs.sparkSession
    python_workers(spark)
    end = np.array([END_ID], "<u4").tobytes()
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path).encode, TaskContext.get().partitionId()
        places = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(part), task, int(places[n]), part))
                    places[n] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place", "ids"]
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
            keep = range(8 if with_ids else 7)
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(columns[i], types[i]) for i in keep], [names[i] for i in keep])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class CapacityTree:
    """Segment tree over remaining capacities: how many open bins have each,
    and the smallest capacity of at least ``need`` that some bin has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, need: int) -> int | None:
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:  # climb until a right sibling has bins
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit-decreasing plan for ``{length: count}`` and the bin count.

    Each step ``(length, rank, bin, per_bin, used)`` places the documents of
    that length from ``rank`` on, ``per_bin`` after another into the bins from
    ``bin`` on, after ``used`` tokens.
    """
    tree, open_bins, steps, bins = CapacityTree(capacity), {}, [], 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            tree.add(room, n)
            open_bins.setdefault(room, []).append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -n)
            per_bin = room // length
            full = min(n, left // per_bin)
            rest = min(left - full * per_bin, per_bin - 1) if full < n else 0
            steps.append((length, rank, first, per_bin, capacity - room))
            leave(room - per_bin * length, first, full)
            touched = full
            if rest:
                leave(room - rest * length, first + full, 1)
                touched += 1
            leave(room, first + touched, n - touched)
            placed = full * per_bin + rest
            left -= placed
            rank += placed
    return steps, bins


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and its place there.

    No sequence exceeds ``capacity`` tokens and its pieces follow each other
    from offset 0 without a gap.  Only documents longer than ``capacity`` are
    cut.  A NULL or empty text is the single id 0; NULL and repeated ids and
    repeated rows are packed like any other; extra columns are ignored; an
    empty table gives no rows.  ``with_ids`` adds the ids (little-endian
    unsigned 32-bit).
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer, capacity, with_ids), "pieces")
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps, _ = plan_bins(histogram, capacity)  # at most ``capacity`` lengths were collected
    plan = spark.sparkContext.broadcast(np.array(steps or [(0, 0, 0, 1, 0)], np.int64).T)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    base = written(counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("base")), "piece-bases")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, firsts, per_bins, used = plan.value
        span = int(ranks.max()) + 1
        starts = (capacity - lengths) * span + ranks  # steps are in decreasing order of length
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            step = np.searchsorted(starts, (capacity - length) * span + np.minimum(rank, span - 1), side="right") - 1
            nth = rank - ranks[step]
            sequence = firsts[step] + nth // per_bins[step]
            offset = used[step] + nth % per_bins[step] * length
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*kept, "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    extra = ["ids"] if with_ids else []
    ranked = (pieces.join(base, ["length", "task"])
              .select(*columns, *extra, (F.col("base") + F.col("place")).alias("rank")))
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              + ("ids binary, " if with_ids else "") + "sequence_id long, offset long")
    return ranked.mapInArrow(place, schema)
