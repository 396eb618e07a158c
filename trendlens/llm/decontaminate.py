"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: every 13 consecutive words
of an item, or the whole item if it is shorter.  For each pattern length there
is one matcher.  A table of blocks (two consecutive words) says how far the
search may shift when it meets a block; blocks of no pattern, nearly all of a
clean text, skip a whole window.  At shift zero the block is the suffix of
some patterns: its bucket is compared word for word, so a reported occurrence
is exact.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import fresh, numbered, python_workers, written

WINDOW_WORDS = 13
# Benchmark words searched for in one pass over the documents (about 100 MB of
# tables in a Python worker); a larger
# benchmark is split over as many passes as it needs.
WORDS_PER_PASS = 200_000

# Bytes of words: 0-9, a-z (A-Z lowered) and everything beyond ASCII.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPANS_TYPE = "n_words long, spans array<int>, items array<string>"


def bench_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lowered."""
    return (text or "").encode().translate(_TABLE).split()


class WuManber:
    """Occurrences of word sequences that all have the same length."""

    def __init__(self, patterns: dict[tuple, list[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.patterns = patterns
        self.skip = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for words in patterns:
            for end in range(self.block, length + 1):
                key = words[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.skip), length - end)
            self.buckets[words[length - self.block:]].append(words)

    def search(self, words: list[bytes]):
        """Yield ``(start, pattern)`` for every occurrence, in order."""
        shift, skip, block, length = self.shift.get, self.skip, self.block, self.length
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block:end])
            step = shift(key, skip)
            if step:
                end += step
                continue
            start = end - length
            for pattern in self.buckets[key]:
                if words[start] == pattern[0] and tuple(words[start:end]) == pattern:
                    yield start, pattern
            end += 1


def build_matchers(items: list[tuple[str, str | None]], window: int = WINDOW_WORDS) -> list[WuManber]:
    """One matcher per pattern length for items ``(id, text)``."""
    by_length: dict[int, dict[tuple, list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        words = bench_words(text)
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            owners = by_length[size][tuple(words[start:start + size])]
            if item not in owners:
                owners.append(item)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


def find_spans(matchers: list[WuManber], text: str | None) -> tuple[int, list[int], list[str]]:
    """Word count, merged hit spans ``[start, end, start, end, ...]`` and the
    sorted ids of the items with an occurring window."""
    words = bench_words(text)
    found, items = [], set()
    for matcher in matchers:
        for start, pattern in matcher.search(words):
            found.append((start, start + matcher.length))
            items.update(matcher.patterns[pattern])
    return len(words), merge_spans(found), sorted(items)


def merge_spans(found: list[tuple[int, int]]) -> list[int]:
    spans: list[int] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1]:
            spans[-1] = max(spans[-1], end)
        else:
            spans += [start, end]
    return spans


_matchers: dict = {}


def _spans_udf(items, tag: str, window: int):
    @F.pandas_udf(SPANS_TYPE)
    def spans_of(texts: pd.Series) -> pd.DataFrame:
        if tag not in _matchers:  # once per Python worker
            _matchers.clear()
            _matchers[tag] = build_matchers(items.value, window)
        rows = [find_spans(_matchers[tag], t) for t in texts]
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return spans_of


def _merged(spans: Column) -> Column:
    @F.pandas_udf("array<int>")
    def merged(rows: pd.Series) -> pd.Series:
        return pd.Series([merge_spans(list(zip(s[::2], s[1::2]))) for s in rows])

    return merged(spans)


def _shards(benchmark: DataFrame, words_per_pass: int) -> tuple[DataFrame, int]:
    """Distinct items with their pass (``shard``), and the number of passes of
    about ``words_per_pass`` words, measured without bringing any here."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (2 * words_per_pass)))  # a word has two characters at least, its separator included
    return rows.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
                   words_per_pass: int = WORDS_PER_PASS) -> DataFrame:
    """``docs`` with a struct column ``hits(n_words, spans, items)``.

    ``spans`` holds the hit word ranges (start, end, start, end, ...), merged;
    ``items`` the ids, as sorted strings, of benchmark items with an occurring
    window.  A pass over the documents searches a checked number of benchmark
    words, which is all of it that the driver and a worker ever hold: a
    benchmark of several passes is brought, sent, searched and dropped one
    pass after another, hits are written by row, and only they are joined
    back.  One pass shuffles nothing.

    NULL and empty texts have no words; an empty benchmark hits nothing;
    repeated items count once; a NULL item_id counts as the empty string; rows
    of ``docs`` are neither merged nor dropped.
    """
    spark = docs.sparkSession
    python_workers(spark)
    out = fresh(docs, "hits")
    items, n = _shards(benchmark, words_per_pass)

    def search(k: int):
        held = [(r.item, r.text) for r in items.filter(F.col("shard") == k).orderBy("item", "text").collect()]
        shared = spark.sparkContext.broadcast(held)
        return shared, _spans_udf(shared, f"{shared._jbroadcast.id()}/{window}", window)(F.col("text"))

    if n == 1:
        return docs.withColumn(out, search(0)[1])
    keyed, keys = numbered(docs, "bench-docs")
    parts = None
    for k in range(n):
        shared, found = search(k)
        rows = keyed.select(*keys, found.alias(out)).select(*keys, f"{out}.*")
        # The first pass counts the words of every document.
        part = written(rows if k == 0 else rows.filter(F.size("items") > 0), "bench-hits")
        shared.destroy()
        parts = part if parts is None else parts.unionAll(part)
    merged = parts.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = F.struct("n_words", _merged(F.col("spans")).alias("spans"), "items").alias(out)
    return keyed.join(merged.select(*keys, hits), keys).select(*docs.columns, out)


def n_hit(hits: Column) -> Column:
    """Words inside the spans: even places hold starts, odd ones ends."""
    signed = F.transform(hits["spans"], lambda v, i: F.when(i % 2 == 0, -v).otherwise(v))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, v: total + v)


def contaminated(hits: Column) -> Column:
    """At least one hit word and at least a twentieth of the words hit."""
    return (n_hit(hits) > 0) & (n_hit(hits) * 20 >= hits["n_words"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
                         words_per_pass: int = WORDS_PER_PASS) -> DataFrame:
    """Per document: word and hit counts, items found and the verdict; see
    :func:`benchmark_hits` for NULL, empty and repeated input."""
    found = benchmark_hits(docs.select("doc_id", "text"), benchmark, window, words_per_pass)
    hits = F.col("hits")
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), n_hit(hits).alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        contaminated(hits).alias("contaminated"), hits["spans"].alias("spans"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the contaminated documents, all columns as they came."""
    found = benchmark_hits(docs, benchmark, window)
    return found.filter(~contaminated(F.col(fresh(docs, "hits")))).select(*docs.columns)
