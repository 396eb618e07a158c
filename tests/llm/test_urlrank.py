"""URL filters: rules, link graph and ranks against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from trendlens.llm import urlrank as U
from trendlens.llm.queries import URL_RULES


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]


def rule_of(host, path, rules):
    fits = [(len(r), r, v) for v, r in rules for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return rule, verdict


def naive(rows, rules):
    """Verdicts of all pages by dense power iteration."""
    judged, marks, weight = [], {}, {}
    for _, url, html in rows:
        host, path = split_url(url)
        judged.append((host, path, *rule_of(host, path, rules)))
        for href in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", html or ""):
            if m := re.match(r"(?i)(https?:)?//([^/?#]*)", href):
                to = m[2].lower()
                if host and to and to != host:
                    weight.setdefault((host, to), [0])[0] += 1
    from math import log1p

    edges = {e: log1p(n[0]) for e, n in weight.items()}
    for host, _, _, verdict in judged:
        own = marks.setdefault(host, [0, 0, 0])
        own[2] += 1
        own[0] += verdict == "allow"
        own[1] += verdict == "block"
    for host in list(marks):
        if m := re.match(r"[^.]+\.(.+\..+)$", host):
            for e in ((host, m[1]), (m[1], host)):
                edges[e] = edges.get(e, 0) + 1.0
    nodes = sorted({h for h in marks if h} | {h for e in edges for h in e})
    scores = []
    for seed, forward in ((0, True), (1, False)):
        share = {h: marks[h][seed] / marks[h][2] if h in marks else 0.0 for h in nodes}
        start = {h: share[h] / (sum(share.values()) or 1) for h in nodes}
        rank, total = dict(start), {}
        for (a, b), w in edges.items():
            k = a if forward else b
            total[k] = total.get(k, 0) + w
        for _ in range(300):
            moved = dict.fromkeys(nodes, 0.0)
            for (a, b), w in edges.items():
                s, d = (a, b) if forward else (b, a)
                moved[d] += rank[s] * w / total[s]
            lost = 1 - U.DAMPING * sum(moved.values())
            rank = {h: U.DAMPING * moved[h] + lost * start[h] for h in nodes}
        scores.append(rank)
    out = []
    for (i, _, _), (host, path, rule, verdict) in zip(rows, judged):
        trust, distrust = scores[0].get(host, 0.0), scores[1].get(host, 0.0)
        bad = host != "" and (distrust - trust) * len(nodes) > U.MARGIN
        out.append((i, host, path, rule, verdict or ("block" if bad else "allow"), trust, distrust))
    return out


def corpus():
    rng = random.Random(8)
    hosts = [f"{p}{n}.{tld}" for n in ("alpha", "beta", "gamma", "delta") for p in ("", "www.", "blog.")
             for tld in ("example.com", "example.net", "example.org", "spam.net")]
    rows = []
    for i in range(250):
        host = rng.choice(hosts)
        links = "".join(f"<a class=x href='{rng.choice(['https://', '//', 'HTTP://'])}{rng.choice(hosts)}/p'>l</a>"
                        for _ in range(rng.randint(0, 3)))
        lang = rng.choice(["en", "es", "fr", "de"]) if "spam" not in host else rng.choice(["es", "fr"])
        rows.append((i, f"http://{host.upper() if i % 9 == 0 else host}/{lang}/{i}{rng.choice(['', '?q=/es/', '#top'])}",
                     f"<a href='/own'>own</a><A HREF=//{host}/x>self</A>{links}"))
    rows += [(900, None, None), (901, "no scheme", "<a href='http://x.org'>"), (902, "http://", ""),
             (903, "http://a.net?x=/es/", ""), (904, "ftp://net/es/1", ""), (905, "http://www.example.com/en/x", ""),
             (906, "http://example.com/en/x", ""), (907, "http://notexample.com/en/", ""), (908, "x://com", ""),
             (909, "http://ÄÖ.example.com/en/\n1", ""), (None, "http://a.com/", ""), (905, "http://www.example.com/en/x", ""),
             (910, "http://b.net/es" + "x" * 20_000, "")]
    return rows


def test_verdicts_match_power_iteration(spark):
    rows = corpus()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "host", F.lit("clash")).withColumn("rules", F.lit(1)).withColumn("trust", F.lit(0))
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted((tuple(r) for r in U.filter_urls(pages, URL_RULES, tolerance=1e-10).collect()), key=key)
    expect = sorted(naive(rows, URL_RULES), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expect]
    for g, e in zip(got, expect):
        assert abs(g[5] - e[5]) < 1e-8 and abs(g[6] - e[6]) < 1e-8
    by_method = {r[4] for r in expect if r[3] is None}
    assert by_method == {"allow", "block"}


def test_a_chain_of_thirty_hosts_gets_its_rank(spark):
    """Ranks go on until they settle, however far a host is from the seeds."""
    names = [f"h{k:02d}" for k in range(31)]
    hosts = spark.createDataFrame([(n, float(k == 0), 0.0) for k, n in enumerate(names)],
                                  "host string, trusted double, blocked double")
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in zip(names, names[1:])], "src string, dst string, weight double")
    got = {r.host: r.trust for r in U.host_ranks(hosts, edges).collect()}
    first = (1 - U.DAMPING) / (1 - U.DAMPING ** 31)  # what falls off the end restarts at the seed
    for k, name in enumerate(names):
        assert abs(got[name] - first * U.DAMPING ** k) < 2 * U.TOLERANCE and got[name] > 0
    with pytest.raises(RuntimeError):
        U.host_ranks(hosts, edges, tolerance=1e-12, most_rounds=4)


def test_half_blocked_hosts_and_links_decide(spark):
    """Distrust in proportion to what rules block, carried by links between
    hosts to hosts that no rule knows; all by the query's own parameters."""
    pages = [(k, f"http://bad.net/{'es' if k % 2 else 'it'}/{k}", "") for k in range(6)]    # half of it blocked
    pages += [(10, "http://good.com/a", "<a href='http://friend.org/'>x</a>")]
    pages += [(20 + k, f"http://feeder{k}.org/", "<a href='http://bad.net/x'>x</a>") for k in range(2)]
    pages += [(30, "http://friend.org/", ""), (31, "http://stranger.org/", "")]
    pages += [(40 + k, f"http://plain{k}.org/", "") for k in range(8)]
    got = {r.page_id: r for r in U.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"),
                                               URL_RULES).collect()}
    assert [got[k].verdict for k in (0, 1)] == ["block", "block"]  # by the method, and by its rule
    assert got[0].rule is None and got[1].rule == "net/es/"
    assert {got[20 + k].verdict for k in range(2)} == {"block"} and got[20].rule is None
    assert {got[k].verdict for k in (30, 31, *range(40, 48))} == {"allow"} and got[30].trust > 0


def test_distrust_runs_against_the_links(spark):
    """What links to a blocked host is distrusted; what it links to is not."""
    hosts = spark.createDataFrame([("in", False, False), ("bad", False, True), ("out", False, False),
                                   ("good", True, False)], "host string, trusted boolean, blocked boolean")
    edges = spark.createDataFrame([("in", "bad", 1.0), ("bad", "out", 1.0), ("good", "out", 1.0)],
                                  "src string, dst string, weight double")
    got = {r.host: (r.trust, r.distrust) for r in U.host_ranks(hosts, edges).collect()}
    assert got["in"][1] > 0 == got["in"][0] and got["out"][0] > 0 == got["out"][1]
    assert abs(sum(t for t, _ in got.values()) - 1) < 1e-9 and abs(sum(d for _, d in got.values()) - 1) < 1e-9


def test_empty_table(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).collect() == []


def test_plan_is_native(spark):
    pages = spark.createDataFrame(corpus(), "page_id long, url string, html string")
    plan = U.link_edges(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
