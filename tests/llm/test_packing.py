"""Packing against one-by-one best-fit decreasing."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from trendlens.llm import packing


def naive_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        open_bins = [i for i, room in enumerate(bins) if room >= n]
        if open_bins:
            bins[min(open_bins, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return Counter(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_one_by_one_placement(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 64, 100])
    top = rng.choice([capacity, capacity // 2 + 1, 5])
    lengths = [rng.randint(1, top) for _ in range(rng.randint(1, 400))]
    steps, n_bins = packing.plan_bins(dict(Counter(lengths)), capacity)
    room, placed = {}, Counter()
    order = sorted(steps, key=lambda s: (-s[0], s[1]))
    for k, (length, rank, first, per_bin, used) in enumerate(order):
        end = order[k + 1][1] if k + 1 < len(order) and order[k + 1][0] == length else Counter(lengths)[length]
        for j in range(end - rank):
            b, at = first + j // per_bin, used + j % per_bin * length
            assert room.get(b, 0) == at  # gapless
            room[b] = at + length
            placed[length] += 1
    assert placed == Counter(lengths) and set(room) == set(range(n_bins)) and max(room.values()) <= capacity
    assert Counter(capacity - used for used in room.values()) == naive_best_fit(lengths, capacity)


def test_capacity_tree():
    rng = random.Random(1)
    tree, held = packing.CapacityTree(100), Counter()
    for _ in range(3000):
        c = rng.randint(1, 100)
        if held[c] and rng.random() < 0.5:
            held[c] -= 1
            tree.add(c, -1)
        else:
            held[c] += 1
            tree.add(c, 1)
        need = rng.randint(1, 100)
        assert tree.tightest(need) == min((k for k, n in held.items() if n and k >= need), default=None)


TEXTS = ["", None, "A plain text, with Punctuation!!", "tabs\tand\nlines\r\n and  blanks", "Ünïcode straße İstanbul ΑΣ",
         "don't we'll they've", "combining é a ́b", "nbsp and em　wide", "\x1cx\x1f y\x00z",
         "emoji \U0001F600\U0001F468‍\U0001F469", "中文字符 テスト", "12345 3.14 x9", "(word) ##Word!! 'tis o'clock it's, 'word' wor'd. --É--", "<|endoftext|> a<|startoftext|>b <|x|>",
         "x\u0301y. (e\u0301) ºª ¼ ʰ _a_ a_b", "x" * 3000, "word " * 3000]


def test_ids_equal_the_tokenizer_on_whole_texts():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    enc = packing.WordEncoder(packing.default_tokenizer(), cache_words=50)
    for text in TEXTS * 2:
        expect = tok.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == expect
        assert len(enc.words) <= 50 + len(set((text or "").split()))


def test_packed_rows(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    rng = random.Random(2)
    texts = TEXTS + ["w%d " % i * rng.randint(1, 900) for i in range(60)] + ["same text"] * 50
    rows = [(i % 100 if i else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "'x' AS rank", "2 AS n")
    got = packing.pack_documents(docs.repartition(5), with_ids=True).collect()
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows]
    expect = Counter((d, p, p * 2048, len(i[p * 2048:][:2048]), zlib.crc32(np.array(i[p * 2048:][:2048], "<u4").tobytes()))
                     for (d, _), i in zip(rows, ids) for p in range(-(-len(i) // 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expect
    by_sequence = {}
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) == sum(naive_best_fit([r.length for r in got], 2048).values())
    plain = packing.pack_documents(docs)
    assert plain.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
