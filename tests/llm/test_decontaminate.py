"""Wu-Manber decontamination against a plain scan."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from trendlens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def naive(docs, items):
    def words(t):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    out = []
    wanted = [("" if i is None else str(i), words(t)) for i, t in items]
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, iw in wanted:
            size = min(13, len(iw))
            for s in range(len(iw) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p:p + size] == iw[s:s + size]:
                        hit.update(range(p, p + size))
                        found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def case(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]  # few words: many partial matches
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([13, 14, 30]))) for i in range(12)]
    items += [(100, "Solo"), (101, "two Words!"), (102, "a b c d e f"), (103, None), (104, "... !!"), (105, ""),
              (1, items[1][1]), (None, "nameless item"), (106, items[2][1]), (107, "Ünïcode Wörter ß")]
    docs = [(i, say(rng.randint(0, 120))) for i in range(20)]
    for i in range(20, 50):
        _, text = rng.choice(items)
        joint = rng.choice([" ", ", ", "\n", "--"])
        docs.append((i, say(rng.randint(0, 400)) + joint + (text or "").upper().replace(" ", joint) + joint + say(20)))
    docs += [(60, None), (61, ""), (62, "!!! ---"), (63, "solo"), (64, "SOLO " * 3 + "x " * 500), (65, "two\twords"),
             (66, "x " * 19 + "solo"), (67, "x " * 20 + "solo"), (None, "nameless-item"), (63, "solo"),
             (68, "wörter ünïcode wörter ß"), (69, items[0][1] + " " + items[0][1]), (70, items[0][1][1:])]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit("clash")).withColumn(
        "n_words", F.lit(-1))
    return d, spark.createDataFrame(items, "item_id long, text string").withColumn("extra", F.lit(0))


def rows(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_report_matches_a_plain_scan(spark):
    docs, items = case()
    d, b = frames(spark, docs, items)
    expect = sorted(naive(docs, items), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert rows(D.contamination_report(d, b)) == expect
    assert any(r[5] for r in expect) and not all(r[5] for r in expect)
    # a benchmark of many passes gives the same
    assert rows(D.contamination_report(d, b, words_per_pass=40)) == expect


def test_clean_documents_stay(spark):
    docs, items = case(9)
    d, b = frames(spark, docs, items)
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    bad = [r[0] for r in naive(docs, items) if r[5]]
    expect = [i for (i, _), r in zip(docs, naive(docs, items)) if not r[5]]
    key = lambda i: (i is None, i or 0)
    assert sorted((r.doc_id for r in kept.collect()), key=key) == sorted(expect, key=key) and bad


def test_empty_tables(spark):
    docs, items = case()
    d, b = frames(spark, docs, items)
    assert D.contamination_report(d.limit(0), b).collect() == []
    none = D.contamination_report(d, b.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)


def test_shift_table_skips_whole_windows():
    matcher, = D.build_matchers([("a", " ".join(f"p{i}" for i in range(13)))])
    assert matcher.skip == 12 and matcher.shift[(b"p11", b"p12")] == 0 and matcher.shift[(b"p0", b"p1")] == 11
