"""URL rules against plain Python, propagation against numpy."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from postloom.llm import host_graph
from postloom.llm.storage import table
from tests.llm.brute import lower

SCHEMA = "page_id long, url string, html string"


def _split(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (lower(found.group(1)), found.group(2)) if found else ("", "")


def _rule(host, path):
    fits = [
        (len(d + p), d + p, v)
        for v, d, p in host_graph.RULES
        if (host == d or host.endswith("." + d)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def _check(pages):
    urls = {r.page_id: r.url for r in pages.collect()}
    found = host_graph.judged_pages(pages).collect()
    assert len(found) == pages.count()
    for r in found:
        assert (r.host, r.path) == _split(urls[r.page_id])
        rule, verdict = _rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
    return found


def test_whole_table(spark):
    _check(table(spark, "/root/testdata/sf0.01", "pages"))


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.NET", "x://a.Example.NET/en/", "a://b://c/d?e://f",
        "http://example.com/de/#x", "http://xexample.com/de/", "http://ÄB.ORG/fr/1", "http://net/",
        "http://a.net?q/", "//a.net/x", "http://h\nx.org/fr/\n?", "http://u@v.net:80/",
    ]
    rows = [(i, u, None if i % 2 else "<a href='//b.net/'>") for i, u in enumerate(urls)]
    rows += [(5, urls[5], ""), (None, "http://a.com/", "")]
    made = spark.createDataFrame(rows, SCHEMA)
    found = _check(made.where("page_id IS NOT NULL").selectExpr("*", "'h' AS host", "1 AS rule"))
    assert len(found) == len(rows) - 1
    assert host_graph.judged_pages(made).where("page_id IS NULL").first().verdict == "allow"
    assert host_graph.judged_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_distrust_goes_against_links(spark):
    def page(links):
        return "".join(f'<A HREF="http://{h}/x">' for h in links)

    rows = [(i, "http://bad.example.com/de/1", "") for i in range(5)]
    rows += [(10, "http://friend.com/a", page(["bad.example.com"])), *((11 + i, "http://friend.com/b", page(["bad.example.com"])) for i in range(6))]
    rows += [(20, "http://plain.com/a", page(["neutral.com"])), (21, "http://neutral.com/", "")]
    rows += [(30, "http://good.org/fr/1", page(["liked.com"])), (31, "http://liked.com/", "")]
    found = {r.page_id: r for r in host_graph.judged_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[10].verdict == "block" and found[10].distrust > 0
    assert found[20].verdict == "allow" and found[21].verdict == "allow"
    assert found[31].trust > 0 and found[30].rule == "org/fr/"


def test_propagation_against_numpy(spark):
    draw = np.random.default_rng(4)
    edges = {(int(a), int(b)): float(w) for a, b, w in zip(draw.integers(0, 30, 90), draw.integers(0, 30, 90), draw.random(90)) if a != b}
    matrix = np.zeros((30, 30))
    for (a, b), w in edges.items():
        matrix[a, b] = w
    matrix /= np.maximum(matrix.sum(axis=1, keepdims=True), 1e-300)
    seed = np.zeros(30)
    seed[:3] = [1.0, 0.5, 0.25]
    score = (1 - host_graph.DAMPING) * np.linalg.solve(
        np.eye(30) - host_graph.DAMPING * matrix.T, seed
    )
    table = spark.createDataFrame(
        [(f"h{a}", f"h{b}", w) for (a, b), w in edges.items()],
        "source string, target string, weight double",
    )
    seeds = spark.createDataFrame(
        [(f"h{i}", float(s)) for i, s in enumerate(seed)], "host string, seed double"
    )
    lost = table.select("source", F.lit("end").alias("target"), "weight")
    found = host_graph.propagated((table, seeds), (lost, seeds.limit(0)), (lost, seeds)).collect()
    assert {r.graph for r in found} == {0, 2}
    own, end = np.zeros(30), 0.0
    for r in found:
        if r.graph == 0:
            own[int(r.host[1:])] = r.score
        elif r.host == "end":
            end = r.score
    # All that is missing from the solved system is what was still on its way.
    missing = score - own
    assert missing.min() > -1e-12 and 0 <= missing.sum() <= host_graph.REST * seed.sum()
    # A graph has its own edges and seeds: here all is passed on once, to a host that ends it.
    linked = [a for a in range(30) if matrix[a].any()]
    share = host_graph.DAMPING * (1 - host_graph.DAMPING)
    assert abs(end - share * seed[linked].sum()) < 1e-12


def test_hosts_of_many_labels_reach_their_domain(spark):
    host = "a.b.c.d.e.f.g.plain.com"
    hosts = spark.createDataFrame([(host,), ("x.y.z.plain.com",), ("plain.com",), ("com",), ("",)], "host string")
    found = {(r.source, r.target) for r in host_graph._family(hosts).collect()}
    labels = host.split(".")
    chain = [".".join(labels[i:]) for i in range(len(labels) - 1)]
    other = ["x.y.z.plain.com", "y.z.plain.com", "z.plain.com", "plain.com"]
    expected = {p for c in (chain, other) for p in zip(c, c[1:])}
    assert found == expected | {(b, a) for a, b in expected}
    pages = spark.createDataFrame(
        [(1, "http://s.com/", '<a href="http://q.r.t.far.org/x">l</a>')], SCHEMA
    ).select("page_id", host_graph.host_of(F.col("url")).alias("host"), "html")
    edges = host_graph.edges_between(pages, pages.select("host"))
    # Hosts that are only linked to have domains above them too.
    assert ("r.t.far.org", "t.far.org") in {(r.source, r.target) for r in edges.collect()}
