"""SimHash near-duplicates against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from trendlens.llm import simhash


def naive_fingerprint(text):
    """The fingerprint's definition, bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def naive_components(rows):
    """``{row index: smallest id}`` by comparing all pairs."""
    fps = [naive_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append(min(ids) if ids else None)
    return fps, out


def corpus():
    rng = random.Random(7)
    vocabulary = ["w%d" % i for i in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 300))]
        rows.append((i * 3, " ".join(words)))
        if i % 3 == 0:  # near copies: one word changed
            other = list(words)
            other[rng.randrange(len(other))] = "changed"
            rows.append((1000 - i, "\n".join(other)))
        if i % 5 == 0:
            rows.append((2000 + i, " ".join(words).upper()))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "one two"), (4999, "One Two"),
             (6000, "nbsp joins words \x1cand more"), (None, "no id here at all"), (None, "one"),
             (6001, "x" * 50_000), (6001, "x" * 50_000), (6002, "ÄÖÜ äöü straße"), (6003, "äöü äöü straße")]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn(
        "component_id", F.lit("clash")).withColumn("row", F.lit(2))


def test_fingerprint_definition():
    for _, text in corpus():
        assert simhash.fingerprint(text) & (1 << 64) - 1 == naive_fingerprint(text)


def test_long_text_is_hashed_in_chunks(monkeypatch):
    text = " ".join(str(i * 7919 % 1000) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text) == whole


def test_components_match_brute_force(spark):
    rows = corpus()
    fps, comps = naive_components(rows)
    got = simhash.near_duplicates(table(spark, rows)).select(
        "id", simhash.fingerprint_hex(F.col("fp")).alias("f"), "component_id").collect()
    expect = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, comps)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expect, key=key)


def test_links_are_exactly_the_close_pairs(spark):
    """Fingerprints around a few centres: every pair at distance 0 to 4."""
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for bits in (1, 1, 2, 2, 3, 3, 3, 4, 5):
            other = centre
            for b in rng.sample(range(64), bits):
                other ^= 1 << b
            fps.add(other)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = [(r.a, r.b) for r in simhash.fingerprint_links(
        spark.createDataFrame([(f,) for f in signed], "fp long")).collect()]
    expect = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == expect


def test_probes_cover_every_half_within_one_bit(spark):
    rng = random.Random(5)
    halves = [0, (1 << 32) - 1, *(rng.getrandbits(32) for _ in range(20))]
    near = [(h, h ^ (1 << b)) for h in halves for b in range(32)] + [(h, h) for h in halves]
    fps = spark.createDataFrame([(x,) for p in near for x in p], "fp long").distinct()
    homes = {r.fp: r.anchor for r in simhash.home_anchors(fps).filter("anchor % 2 = 0").collect()}
    probes = {}
    for r in simhash.probe_anchors(fps).filter("anchor % 2 = 0").collect():
        probes.setdefault(r.fp, set()).add(r.anchor)
    assert all(homes[a] in probes[b] and homes[b] in probes[a] for a, b in near)
    assert max(map(len, probes.values())) == 17


def test_one_of_each_group_stays(spark):
    rows = corpus()
    _, comps = naive_components(rows)
    docs = table(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    # one row for each component; with ids, the smallest
    groups = {}
    fps = [naive_fingerprint(t) for _, t in rows]
    for (i, _), c, f in zip(rows, comps, fps):
        groups.setdefault(c if c is not None else ("none", f), set()).add(i)
    assert len(got) == len(groups)
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(c for c in groups if isinstance(c, int))


def test_a_large_group_of_copies_is_one_node(spark):
    rows = [(i, "the same text over and over") for i in range(3000)] + [(-1, "something else entirely here")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.component_id, r["count"]) for r in got.groupBy("component_id").count().collect()} == {(0, 3000), (-1, 1)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


def test_components_of_a_long_chain(spark):
    from trendlens.llm.graph import connected_components

    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (502, 502), (503, None)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}
