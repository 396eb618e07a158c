"""Quality rules: base text rules and a hashed n-gram log-likelihood ratio.

Words and word pairs of every document fall into ``buckets`` hash buckets.
Two multinomials over the buckets are counted: one over the whole corpus, one
over trusted documents.  A document's score is its log-likelihood under the
trusted one minus that under the corpus one, divided by its number of
n-grams.  One half of the trusted documents is counted; the other labelled
documents, which the counts have not seen, set the least score: the point that
best tells the trusted ones from those labelled low in quality.

Built from DataFrame functions alone.  Texts are never shuffled: counts are
summed per task and bucket before the exchange, weights (one per bucket, a
fixed number) are broadcast, and a document's n-grams are summed in the task
that reads it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import bounded_sample, numbered, words_col, written

BUCKETS = 1 << 16
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
# Trusted documents of which the multinomial counts one half, at most: those
# with the smallest hashes of their ids.
MAX_TRUSTED = 50_000
# Share of the held-out trusted documents that the least score may reject.
# Without documents labelled low it rejects that share.
MAX_LOST = 0.02
# Standard deviations below the held-out trusted documents' mean score that
# are the least score without low labels and with too few trusted documents
# for a share of MAX_LOST.
_BINS = 1000  # of scores, per unit
SYMBOLS = r"[#*$%&|<>]"
_SCALE = 1 << 20  # weights are fixed-point, so that sums don't depend on the order

RULE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_rules(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, the words and the rule counts of every text.

    Each array that a lambda reads is a column of its own that is used more
    than once, so it is computed once per row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, text.alias("__text"), words_col(F.col(text_col)).alias("__words"))
    lines = F.filter(F.split(F.col("__text"), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("__words")
    windows = F.when(n >= REPEAT_WINDOW, F.transform(
        F.slice("__words", 1, F.greatest(n - (REPEAT_WINDOW - 1), F.lit(1))),
        lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        *keep, "__words",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("__lines"), windows.alias("__windows"))
    ordered = F.when(
        F.size("__windows") > F.size(F.array_distinct("__windows")),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(
        *keep, "__words", "n_words", "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        ordered.alias("__ordered"))
    # Equal windows lie side by side in hash order; their places, in text
    # order, each cover the words not covered by the place before.
    repeated = F.filter("__ordered", lambda s, i: (
        F.coalesce(F.get("__ordered", i - 1)["h"] == s["h"], F.lit(False))
        | F.coalesce(F.get("__ordered", i + 1)["h"] == s["h"], F.lit(False))))
    places = F.sort_array(F.transform(repeated, lambda s: s["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(-REPEAT_WINDOW).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(F.lit(REPEAT_WINDOW), p - acc["last"]))
                                .cast("long").alias("sum")),
        lambda acc: acc["sum"])
    return rows.select(*keep, "__words", *RULE_COLUMNS[:4],
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def gram_buckets(words: str, buckets: int = BUCKETS) -> Column:
    """Buckets of the words and of the pairs of consecutive words."""
    last = F.lit(buckets - 1).cast("long")
    ones = F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(last).cast("int"))
    n = F.size(words)
    twos = F.when(n >= 2, F.transform(
        F.slice(words, 1, F.greatest(n - 1, F.lit(1))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1)).bitwiseAND(last).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(ones, twos)


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """``(doc_id, held)``: ids labelled good and never toxic, ``most`` of them
    at most, every other one (by hash) held out from the counts."""
    good = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
            .filter("q = 1 AND coalesce(t, 0) = 0").select("doc_id"))
    chosen = bounded_sample(written(good, "quality-good"), ["doc_id"], most)
    return chosen.select("doc_id", (F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(2)) == 1).alias("held"))


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str,
                   buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, weight)``: fixed-point log ratio of the trusted to the
    corpus multinomial, add-one smoothed, for every bucket the corpus fills."""
    marked = docs.select(F.col(id_col).alias("doc_id"), words_col(F.col(text_col)).alias("__words")).join(
        F.broadcast(trusted.filter("NOT held").select("doc_id", F.lit(1).alias("__good"))), "doc_id", "left")
    grams = marked.select("__good", F.explode(gram_buckets("__words", buckets)).alias("bucket"))
    counts = written(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("__good").alias("good")),
                     "quality-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    raw, good = total["raw"] or 0, total["good"] or 0
    if not good:
        return counts.select("bucket", F.lit(0).cast("long").alias("weight"))
    ratio = (F.log((F.col("good") + 1) / float(good + buckets)) - F.log((F.col("raw") + 1) / float(raw + buckets)))
    return counts.select("bucket", F.round(ratio * _SCALE).cast("long").alias("weight"))


def labelled_rest(labels: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(doc_id, good)`` of all labelled ids that the counts have not seen:
    those good and never toxic, and those ever labelled low."""
    each = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
            .filter("q < 1 OR q = 1 AND coalesce(t, 0) = 0").select("doc_id", (F.col("q") == 1).alias("good")))
    return each.join(trusted.filter("NOT held"), "doc_id", "left_anti").select("doc_id", "good")


def least_score(scored: DataFrame, rest: DataFrame) -> float:
    """Least score of a kept document, from the rows of ``scored(__id, score)``
    that ``rest(doc_id, good)`` labels.

    Of the points that reject ``MAX_LOST`` of the good rows at most, the one
    with the smallest sum of good rows' share rejected and low rows' share
    kept, midway between the rows on either side.  Without low rows it is the
    largest such point: the ``MAX_LOST`` quantile of the good, which for fewer
    than ``1 / MAX_LOST`` of them is the least.  Rows are counted per bin of
    scores, so the driver gets a table bounded by the range of scores.
    """
    rows = scored.join(rest, F.col("__id") == F.col("doc_id")).groupBy(F.floor(F.col("score") * _BINS).alias("bin")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("low"))
    bins = sorted(rows.collect(), key=lambda r: r["bin"])
    good, low = sum(r["good"] for r in bins), sum(r["low"] for r in bins)
    if not good:
        return float("-inf")
    best, least, lost, caught, end = None, float("-inf"), 0, 0, None
    for r in bins:  # points between the bin before, if any, and this one
        if lost > good * MAX_LOST:
            break
        loss = lost / good + (low - caught) / low if low else -lost
        if best is None or loss < best:
            best, least = loss, (r["bin"] + (r["bin"] if end is None else end)) / 2 / _BINS
        lost, caught, end = lost + r["good"], caught + r["low"], r["bin"] + 1
    return least


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED, row_cols: list[str] | None = None) -> DataFrame:
    """``(id, [rows], n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, score, base_failed, kept)``, one row per row of ``docs``.

    A NULL or empty text has no words and fails the base rules; NULL and
    repeated ids and repeated rows are judged row by row; extra columns are
    ignored; an empty table gives no rows.  ``row_cols`` names columns that
    tell the rows apart; they are returned.  Without trusted documents in
    either half the base rules decide alone (without counted ones all scores
    are 0).  Documents that fail the base rules are scored as well, but only
    labelled documents that pass them set the threshold (:func:`least_score`).
    """
    trusted = written(trusted_ids(labels, max_trusted), "quality-trusted")
    weights = bucket_weights(docs, trusted, id_col, text_col, buckets)
    row = F.struct(*row_cols) if row_cols else F.monotonically_increasing_id()
    keep = [F.col(id_col).alias("__id"), row.alias("__row")]
    ruled = base_rules(docs.select(*keep, F.col(text_col).alias("__t")), "__t", ["__id", "__row"])
    grams = ruled.select("__id", "__row", *RULE_COLUMNS,
                         F.explode_outer(gram_buckets("__words", buckets)).alias("bucket"))
    summed = (grams.join(F.broadcast(weights), "bucket", "left")
              .groupBy("__row", "__id", *RULE_COLUMNS)
              .agg(F.sum("weight").alias("__sum"), F.count("bucket").alias("__grams")))
    score = F.coalesce(F.col("__sum") / (F.col("__grams") * float(_SCALE)), F.lit(0.0))
    scored = written(summed.select(
        "__id", "__row", *RULE_COLUMNS, score.alias("score"),
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed")), "quality-scores")
    rest = written(labelled_rest(labels, trusted), "quality-rest")
    least = least_score(scored.filter(~F.col("base_failed")).select("__id", "score"), rest)
    return scored.select(
        F.col("__id").alias(id_col), *(["__row.*"] if row_cols else []), *RULE_COLUMNS, "score",
        "base_failed", (~F.col("base_failed") & (F.col("score") >= F.lit(least))).alias("kept"))


def keep_good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that :func:`score_documents` keeps, every column as it
    came; verdicts are joined by row keys (see :func:`numbered`)."""
    keyed, keys = numbered(docs, "quality-docs")
    verdicts = score_documents(keyed, labels, row_cols=keys)
    gone = written(verdicts.filter(~F.col("kept")).select(*keys), "quality-gone")
    return keyed.join(gone, keys, "left_anti").select(*docs.columns)
