"""Delta-maintained token rollups against counting anew."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trendlens.llm import rollups as R

SCHEMA = "doc_id long, text string, lang string, source string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("n_tokens", F.lit("clash")).withColumn("tokenizer", F.lit(1))


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


def expected(rows, bpe):
    out = Counter(), Counter()
    for _, text, lang, source in rows:
        for version, n in (("words", len((text or "").encode().split())), ("bpe", bpe(text))):
            out[0][source, lang, version] += 1
            out[1][source, lang, version] += n
    return {k: (out[0][k], out[1][k]) for k in out[0]}


def test_batches_keep_the_totals(spark, workdir):
    from trendlens.llm.packing import WordEncoder, default_tokenizer

    enc = WordEncoder(default_tokenizer())
    bpe = lambda t: len(enc.encode(t)) // 4
    versions = {"words": R.words_tokenizer, "bpe": R.bpe_tokenizer()}
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 50))), rng.choice(["en", "fr", None]),
             rng.choice(["hot", "hot", "cold", None])) for i in range(200)]
    rows += [(500, None, "en", "hot"), (501, "", "en", "cold"), (None, "no id", None, None), (7, "again", "en", "hot"),
             (502, "z " * 20_000, "en", "hot")]
    ledger = R.TokenRollup(spark, os.path.join(workdir, "ledger"))
    assert ledger.totals().collect() == []
    count = lambda r: R.count_tokens(docs_of(spark, r), versions)
    assert ledger.commit("1", R.inserts(count(rows)))
    assert totals(ledger) == expected(rows, bpe)
    gone, left = rows[:50], rows[50:]
    assert ledger.commit("2", R.deletes(count(gone)))
    assert totals(ledger) == expected(left, bpe)
    old, rest = left[:40], left[40:]
    new = [(i, (t or "") + " more words", "de", s) for i, t, _, s in old]  # another language as well
    assert ledger.commit("3", R.revisions(count(old), count(new)))
    assert totals(ledger) == expected(new + rest, bpe)
    # committing again changes nothing, with the same rows or with others
    assert not ledger.commit("2", R.deletes(count(gone))) and not ledger.commit("3", R.deletes(count(rest)))
    assert totals(ledger) == expected(new + rest, bpe)
    # keys without documents disappear
    assert ledger.commit("4", R.deletes(count(new + rest)))
    assert totals(ledger) == {}
    assert not [f for f in os.listdir(ledger.folder) if f.startswith("_stage")]


def test_left_over_stage_is_no_part_of_the_totals(spark, workdir):
    ledger = R.TokenRollup(spark, os.path.join(workdir, "ledger"))
    one = R.inserts(R.count_tokens(docs_of(spark, [(1, "a b", "en", "s")]), {"words": R.words_tokenizer}))
    one.groupBy(*R.KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.parquet(
        os.path.join(ledger.folder, "_stage-1-dead"))
    assert totals(ledger) == {}
    assert ledger.commit("1", one) and totals(ledger) == {("s", "en", "words"): (1, 2)}
    assert ledger.commit("empty", one.limit(0)) and totals(ledger) == {("s", "en", "words"): (1, 2)}
    for bad in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            ledger.commit(bad, one)


def test_totals_read_a_snapshot_and_what_came_after(spark, workdir):
    ledger = R.TokenRollup(spark, os.path.join(workdir, "ledger"))
    one = lambda k: spark.createDataFrame([("s", "en", "words", 1, k), ("s", None, "words", 1, 1)], R.DELTAS)
    for k in range(6):
        assert ledger.commit(f"b{k}", one(k))
        newest, inside, later = ledger._state()
        assert len(inside) == k + 1 and later == [] and len(ledger._names("snapshot=")) <= 2
    want = {("s", "en", "words"): (6, 15), ("s", None, "words"): (6, 6)}
    assert totals(ledger) == want
    plan = ledger.totals()._jdf.queryExecution().toString()
    assert "batch=" not in plan and "snapshot=" in plan
    # a commit whose snapshot is still missing counts; so does one without any
    fold, R.TokenRollup._fold = R.TokenRollup._fold, lambda self: None
    try:
        assert ledger.commit("late", one(10))
    finally:
        R.TokenRollup._fold = fold
    assert ledger._state()[2] == ["batch=late"]
    assert totals(ledger) == {("s", "en", "words"): (7, 25), ("s", None, "words"): (7, 7)}
    assert ledger.commit("next", one(0).limit(0)) and ledger._state()[2] == []
    assert totals(ledger) == {("s", "en", "words"): (7, 25), ("s", None, "words"): (7, 7)}


def test_an_id_with_other_rows_raises(spark, workdir):
    ledger = R.TokenRollup(spark, os.path.join(workdir, "ledger"))
    rows = spark.createDataFrame([("s", "en", "words", 1, 4), ("t", None, "words", 1, 2)], R.DELTAS)
    assert ledger.commit("1", rows, strict=True)
    assert not ledger.commit("1", rows.repartition(3), strict=True)  # the same sums
    with pytest.raises(ValueError):
        ledger.commit("1", rows.limit(1), strict=True)
    assert not ledger.commit("1", rows.limit(1))


def test_registered_query(spark):
    """Totals of the query's commits equal a count of the corpus they leave."""
    from conftest import SF_SMALL
    from trendlens.llm import queries
    from trendlens.llm.packing import WordEncoder, default_tokenizer

    enc = WordEncoder(default_tokenizer())
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    expect = {}
    for i, d in docs.items():
        text, mark = d.text, labels.get(i)
        if mark and mark.toxic == 1:
            continue
        if mark and mark.quality == 0:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        for version, n in (("words-1", len(text.encode().split())), ("word_bpe_49k", len(enc.encode(text)) // 4)):
            docs_n, tokens = expect.get((d.source, d.lang, version), (0, 0))
            expect[d.source, d.lang, version] = (docs_n + 1, tokens + n)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens)
           for r in queries.queries()["op6_rollups"](spark, SF_SMALL).collect()}
    assert got == expect
