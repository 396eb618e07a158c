"""URL filters: rules by host and path, and trust propagated over links.

A rule fits its host and that host's subdomains where the path starts with
the rule's; the longest rule decides.  URLs without a rule get their host's
verdict from two rankings over the host graph: personalised PageRank from
trusted hosts along the links, and the same from blocked hosts against them
(a host that links to blocked hosts inherits distrust).

Built from DataFrame functions alone.  The graph is one row per pair of
hosts; ranks are joined and summed by host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import forget, written

DAMPING = 0.85
# Ranks are iterated until this many rounds add less than this share to them,
# and never for more than so many rounds.
STEP_ROUNDS = 4
TOLERANCE = 1e-3
MOST_ROUNDS = 400
# A host is blocked if its distrust exceeds its trust by this many shares of
# an even distribution.
MARGIN = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lowered; empty without ``://`` or for NULL."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` pairs, a rule being host then path, as a table."""
    if any(v not in ("allow", "block") or "/" not in r for v, r in rules):
        raise ValueError("a rule is ('allow' or 'block', 'host/path')")
    rows = spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string").distinct()
    cut = F.locate("/", F.col("rule"))
    return rows.select("verdict", "rule", F.lower(F.substr("rule", F.lit(1), cut - 1)).alias("rule_host"),
                       F.substr("rule", cut).alias("rule_path"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, rules)``: the rules that may fit a host, longest first, found
    by an equi-join on the host's suffixes."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    order = F.struct((-F.length("rule")).alias("n"), "rule", "verdict", "rule_path")
    return fits.groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("rules"))


def site_edges(hosts: DataFrame) -> DataFrame:
    """A host and the parent domain it is part of link to each other."""
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    up = hosts.select(F.col("host").alias("src"), parent.alias("dst")).filter("dst <> ''")
    return up.unionAll(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def link_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` for every link of a page to a named host, as often as it
    occurs; relative links stay on their host and are no edges."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), 1)
    named = F.filter(found, lambda h: h.rlike(r"^(?i)(https?:)?//"))
    return (pages.select(url_host(F.col("url")).alias("src"), F.explode(named).alias("href"))
            .select("src", url_host(F.regexp_replace("href", r"^(?i:https?:)?//", "x://")).alias("dst"))
            .filter("src <> '' AND dst <> '' AND src <> dst"))


def host_ranks(hosts: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING,
               most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` for ``hosts(host, trusted, blocked)``
    (seeds: true, or a weight above 0) and ``edges(src, dst, weight)``.

    Both rankings restart at their seeds, in proportion to the weights; what
    reaches a host without further edges restarts too.  So a ranking is the
    solution of ``y = seeds + damping * moved(y)``, scaled to the sum 1, and
    rounds of that equation only add to ``y``.  They go on until they add
    less than ``tolerance`` of it; what a round adds shrinks by ``damping``,
    so they end, and if they have not after ``most_rounds`` it raises.
    Without seeds a ranking is 0 everywhere.

    Trust moves along the edges and distrust against them, as two kinds of
    rows of one table; every ``STEP_ROUNDS`` rounds it is written, so lineage
    stays short, and the one before it deleted.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("in"))
    shares = edges.join(out, "src").join(into, "dst")
    way = lambda kind, a, b, total: shares.select(
        F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"),
        (F.col("weight") / F.col(total) * damping).alias("share"))
    moves = written(way(0, "src", "dst", "out").unionAll(way(1, "dst", "src", "in")), "rank-moves")
    weight = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), weight("trusted").alias("y")),
                    F.struct(F.lit(1).alias("kind"), weight("blocked").alias("y")))
    seeds = written(hosts.select("host", F.inline(kinds)).filter("y > 0").select("kind", "host", "y"), "rank-seeds")
    ranks, sums = seeds, _mass(seeds)
    for _ in range(0, most_rounds, STEP_ROUNDS):
        moved = ranks
        for _ in range(STEP_ROUNDS):
            told = moved.join(moves, ["kind", "host"]).select("kind", F.col("to").alias("host"),
                                                              (F.col("y") * F.col("share")).alias("y"))
            moved = seeds.unionAll(told).groupBy("kind", "host").agg(F.sum("y").alias("y"))
        after = written(moved, "rank-round")
        if ranks is not seeds:
            forget(ranks)
        ranks, before, sums = after, sums, _mass(after)
        if all(sums[k] - before.get(k, 0.0) <= tolerance * sums[k] for k in sums):
            break
    else:
        raise RuntimeError(f"ranks still grow from {before} to {sums} after {most_rounds} rounds")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("y") / float(sums.get(kind) or 1)))
    known = ranks.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))
    return hosts.select("host").join(known, "host", "left").select(
        "host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")])


def _mass(ranks: DataFrame) -> dict[int, float]:
    return {r["kind"]: r["y"] for r in ranks.groupBy("kind").agg(F.sum("y").alias("y")).collect()}


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], tolerance: float = TOLERANCE,
                margin: float = MARGIN) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the host's ``trust`` and
    ``distrust``, one row per row of ``pages``.

    A host is a seed of trust by the share of its pages that rules allow, and
    one of distrust by the share that they block.  Edges are the
    links of the pages, weighted by the logarithm of their number, and the
    bonds of hosts with their parent domains.  A NULL url or one without
    ``://`` has an empty host and path, no rule and rank 0, and is allowed;
    NULL html has no links; repeated rows are judged one by one; extra
    columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    own = written(rows.groupBy("host").agg(F.count("*").alias("n")), "url-hosts")
    fitting = written(host_rules(own, rules_table(spark, rules)), "url-rules")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    # One rule decides; without one both are NULL.
    ruled = rows.join(fitting, "host", "left").withColumn("hit", F.get(fits, F.lit(0)))
    by_host = written(ruled.groupBy("host").agg(F.count_if(F.col("hit.verdict") == "allow").alias("allowed"),
                                                F.count_if(F.col("hit.verdict") == "block").alias("blocked"),
                                                F.count("*").alias("n")), "url-seeds")
    bonds = written(site_edges(own.filter("host <> ''")), "url-bonds")
    links = link_edges(pages).groupBy("src", "dst").agg(F.log1p(F.count("*")).alias("weight"))
    edges = written(links.unionAll(bonds.select("src", "dst", F.lit(1.0).alias("weight")))
                    .groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "url-edges")
    named = edges.select(F.col("src").alias("host")).unionAll(edges.select("dst")).unionAll(
        own.filter("host <> ''").select("host")).distinct()
    hosts = written(named.join(by_host, "host", "left").select(
        "host", F.coalesce(F.col("allowed") / F.col("n"), F.lit(0.0)).alias("trusted"),
        F.coalesce(F.col("blocked") / F.col("n"), F.lit(0.0)).alias("blocked")), "url-graph")
    n = hosts.count()
    # Ranks in shares of an even distribution, rounded there: sums of doubles
    # depend on their order in the last digits.
    excess = F.round((F.col("distrust") - F.col("trust")) * n, 6)
    verdicts = written(host_ranks(hosts, edges, tolerance).select("host", "trust", "distrust",
                                                                  (excess > margin).alias("bad")), "url-verdicts")
    judged = own.select("host").join(fitting, "host", "left").join(verdicts, "host", "left")
    lookup = written(judged, "url-lookup")
    out = rows.join(lookup, "host").withColumn("hit", F.get(fits, F.lit(0)))
    return out.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
