"""Phrases against a plain count."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trendlens.llm import collocations
from trendlens.llm.collocations import pack, unpack, words_of

SCHEMA = "doc_id long, text string, lang string"


def pieces_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, max_words=3, least=10, percent=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        own = {p[1:]: c for p, c in f.items() if p[0] == lang}
        big = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in big.items():
            if any(len(q) > len(p) and 100 * c >= percent * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in big.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                 for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "new", "York", "city", "é", "Émile", "a", "b-c", "x", "ab"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "!", "\x0b"])
                       for _ in range(rnd.randint(0, 60)))
        rows.append((i, text, rnd.choice(["en", "en", "de", None])))
    # Ties, repeated rows, NULL and empty texts, overlaps, one very long text, no blank at the ends.
    return rows + [rows[0]] * 3 + [(1, None, "en"), (2, "", "fr"), (3, " .. \t", "fr"), (None, "a a a a a a a a a a a a", "fr"),
                                   (4, "new York city " * 3000 + "end", "en"), (5, "und word " * 20, "und")]


@pytest.mark.parametrize("kw", [{}, {"max_words": 4, "least": 5}, {"top": 3, "inside_percent": 90}, {"max_words": 2}])
def test_equals_a_plain_count(spark, kw):
    rows = corpus(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = collocations.collocations(df, **kw)
    args = {"percent" if k == "inside_percent" else k: v for k, v in kw.items()}
    assert sorted(map(tuple, found.collect())) == brute(rows, **args)


def test_many_passes_blocks_and_ranges(spark, monkeypatch):
    """What is beyond the size of one pass is met in several; blocks, counts
    of a task and ranges of the reduction may be small."""
    for name, value in (("WORDS_PER_PASS", 3), ("PHRASES_PER_PASS", 5), ("BLOCK_BYTES", 200), ("OPEN_BYTES", 300),
                        ("HELD_WORDS", 20), ("HELD_PAIRS", 50), ("RANGE_PAIRS", 40), ("RANK_PARTS", 3)):
        monkeypatch.setattr(collocations, name, value)
    rows = corpus(2, 60)
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), max_words=4)
    assert sorted(map(tuple, found.collect())) == brute(rows, max_words=4)


def test_packing_round_trip():
    for values in ([], [5], [0, 1, 2, 5, 4, 1 << 60, 0], list(range(1000))):
        assert unpack(pack(np.array(values, "int64"))).tolist() == values


def test_scores_pass_64_bits(spark):
    row = spark.createDataFrame([(10 ** 11, 10 ** 11 + 7, 10 ** 11 + 9)], "a long, l long, r long")
    from pyspark.sql import functions as F

    a, l, r = 10 ** 11, 10 ** 11 + 7, 10 ** 11 + 9
    assert row.select(collocations._cut_score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10 ** 6 * a * a // (l * r)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(df).collect() == []
    rows = corpus(4, 30)
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS grp", "'x' AS word", "2 AS at", "3 AS doc", "4 AS w1")
    assert sorted(map(tuple, collocations.collocations(extra).collect())) == brute(rows)


def test_words_of_sliced_arrays():
    texts = ["skip me", "A b.c", None, "", "d\te,", "f"]
    words, place = words_of(pa.array(texts).slice(1))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "f"]
    steps = np.diff(place).tolist()
    assert steps[0] == 1 and steps[3] == 1 and all(s > 1 for s in (steps[1], steps[2], steps[4]))
    assert words_of(pa.array([None, ""], pa.string()))[0].to_pylist() == []
    assert words_of(pa.array([" .", "\n"]))[0].to_pylist() == []
