"""Quality rules against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from trendlens.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive_rules(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def corpus():
    rng = random.Random(11)
    good = [f"wort{i}" for i in range(80)]
    bad = [f"junk{i}##" for i in range(80)]
    rows, labels = [], []
    for i in range(60):
        rows.append((i, " ".join(rng.choice(good) for _ in range(rng.randint(55, 200)))))
        if i < 40:
            labels.append((i, 1, 0))
    for i in range(60, 80):
        rows.append((i, " ".join(rng.choice(bad) for _ in range(rng.randint(55, 200)))))
        labels.append((i, 0, 0))
    labels += [(61, 1, 0), (39, 1, 1), (None, 1, 0), (40, None, None), (0, 1, 0)]
    line = "one line that is here again and again\n"
    rows += [(100, None), (101, ""), (102, " \n\t\x0b\x0c\r"), (103, line * 30), (104, line + "\n \n" + line + "x\ny\nx"),
             (105, "a b c " * 40), (106, "a " * 60), (107, "é ü\x1cß 😀 <|>"), (None, "word " * 10), (5, rows[5][1]),
             (5, rows[5][1]), (108, " ".join(f"u{i}" for i in range(20_000))), (109, "a b c a b c x y z a b d"),
             (110, "x" * 100_000)]
    return rows, labels


def tables(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit(-1)).withColumn(
        "bucket", F.lit("clash")).withColumn("__words", F.lit(0)).withColumn("row", F.lit(1))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("score", F.lit(9))


def test_base_counts_match_brute_force(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    got = Q.score_documents(docs, marks)
    key = lambda r: tuple((x is None, x) for x in r)
    found = sorted((tuple(r) for r in got.select("doc_id", *Q.RULE_COLUMNS, "base_failed").collect()), key=key)
    assert found == sorted(((i, *naive_rules(t)) for i, t in rows), key=key)
    verdicts = {r.doc_id: r for r in got.collect()}
    assert all(not r.kept for r in verdicts.values() if r.base_failed)
    assert all(verdicts[i].kept for i in range(60))       # the trusted kind
    assert not any(verdicts[i].kept for i in range(60, 80))  # in the other words


def test_scores_match_brute_force(spark):
    """Counts per bucket, weights and sums from Spark's own hash values."""
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    words = sorted({w for _, t in rows for w in WORD.findall(t or "")})
    pairs = sorted({p for _, t in rows for w in [WORD.findall(t or "")] for p in zip(w, w[1:])})
    mask = Q.BUCKETS - 1
    one = {r.w: r.h & mask for r in spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", F.xxhash64("w").alias("h")).collect()}
    two = {(r.a, r.b): r.h & mask for r in spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    halves = {r.doc_id: r.held for r in Q.trusted_ids(marks).collect()}
    assert set(halves) == set(range(39))  # 39 is toxic in one row, 61 low in one
    trusted, held = ({i for i, h in halves.items() if h == side} for side in (False, True))
    raw, good, grams = Counter(), Counter(), []
    for i, t in rows:
        w = WORD.findall(t or "")
        g = [one[x] for x in w] + [two[p] for p in zip(w, w[1:])]
        grams.append(g)
        raw.update(g)
        if i in trusted:
            good.update(g)
    n_raw, n_good = sum(raw.values()), sum(good.values())
    weight = {b: math.log((good[b] + 1) / (n_good + Q.BUCKETS)) - math.log((raw[b] + 1) / (n_raw + Q.BUCKETS))
              for b in raw}
    expect = [(i, sum(weight[b] for b in g) / len(g) if g else 0.0) for (i, _), g in zip(rows, grams)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.score) for r in Q.score_documents(docs, marks).collect()), key=key)
    for (i, s), (j, e) in zip(got, sorted(expect, key=key)):
        assert i == j and abs(s - e) < 1e-5
    # One row is labelled low: the threshold is midway between it and the least good one.
    least = (min(s for i, s in expect if i in held) + max(s for i, s in expect if i == 61)) / 2
    for r in Q.score_documents(docs, marks).collect():
        if abs(r.score - least) > 1 / Q._BINS:
            assert r.kept == (not r.base_failed and r.score >= least)


def test_kept_documents_come_back_whole(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    kept = Q.keep_good_documents(docs, marks)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in Q.score_documents(docs, marks).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.collect())[5] == 3  # repeated rows are judged one by one


def test_without_labels_the_base_rules_decide(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    got = Q.score_documents(docs, marks.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) and r.score == 0 for r in got)
    assert Q.score_documents(docs.limit(0), marks).collect() == []
    assert Q.keep_good_documents(docs.limit(0), marks).collect() == []


@pytest.mark.parametrize("folder", [SF_MID, SF_MID.replace("sf0.01", "sf0.1")])
def test_labelled_low_documents_go_and_trusted_stay(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = Q.trusted_ids(labels)
    low = labels.filter("quality = 0").select("doc_id", F.lit(True).alias("low")).distinct()
    got = (Q.score_documents(docs, labels).filter("NOT base_failed").join(low, "doc_id", "left").join(held, "doc_id", "left")
           .agg(F.count_if("low").alias("low"), F.count_if(F.col("low") & ~F.col("kept")).alias("caught"),
                F.count_if(F.col("held").isNotNull()).alias("good"),
                F.count_if(F.col("held").isNotNull() & ~F.col("kept")).alias("lost")).first())
    print(folder, got)
    assert got.caught >= 0.9 * got.low > 0 and got.lost <= Q.MAX_LOST * got.good


def test_least_score(spark):
    def least(good, low):
        rows = [(i, x) for i, x in enumerate([*good, *low])]
        scored = spark.createDataFrame([*rows, (None, -9.0), (10**6, -8.0)], "__id long, score double")
        rest = spark.createDataFrame([(i, i < len(good)) for i, _ in rows], "doc_id long, good boolean")
        return Q.least_score(scored, rest)

    good = [i / 1000 for i in range(1000)]
    wide = [*good, *(x - 5 for x in good)]  # trusted documents of two kinds
    assert abs(least(wide, [-5.5] * 5) - -5.25) < 0.01         # six deviations would be below -17
    assert abs(least(good, [0.004] * 50 + [-1.0] * 50) - 0.005) < 0.002  # few good ones lost, many low ones caught
    assert abs(least(good, [0.9] * 50) - 0) < 0.002            # not at any price
    assert abs(least(good, []) - 0.02) < 0.002                 # the quantile
    assert abs(least([0.0, 0.2], []) - 0) < 0.002              # of a few the least: none is lost
    assert abs(least([0.3, 0.5], [0.1]) - 0.2) < 0.002         # one label of each kind
    assert least([], [0.1]) == float("-inf")


def test_plan_is_native(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    plan = Q.base_rules(docs, "text", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
