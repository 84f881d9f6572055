"""URL filter: fixed rules, and beside them link-graph propagation between hosts.

Hosts are nodes. A link in a page is an edge from its host to the linked one, and
a host and the domain above it are joined both ways. Trust starts from hosts
with allowed pages and follows the edges (personalised PageRank); distrust starts
from hosts with blocked pages and goes against them, from the linked host to those
that link to it. A host is blocked when its distrust outweighs its trust and what
its unjudged pages are worth. DataFrame functions only; edges are summed up by
pair of hosts before anything is joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postloom.llm.storage import stored

# Verdict, domain and path of each rule; the longest that fits wins.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
DAMPING = 0.85
REST = 0.02  # share of the seeds that is not passed on any more, at most
ROUNDS = 4  # rounds between two tables of scores
THRESHOLD = 0.5  # share of distrust beyond which a host is blocked
UNJUDGED = 0.5  # what a host's pages that no rule fits are worth beside allowed ones

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*+:)?//[^\s"'<>]++)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, ``?`` or ``#``, A-Z as a-z; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*+)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def matched(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def first(values: list[str]) -> Column:
        cases = [
            (((host == d) | host.endswith("." + d)) & path.startswith(p), v)
            for (_, d, p), v in zip(ordered, values)
        ]
        return reduce(lambda done, c: done.when(*c), cases[1:], F.when(*cases[0]))

    return first([d + p for _, d, p in ordered]), first([v for v, _, _ in ordered])


def _family(hosts: DataFrame) -> DataFrame:
    """Edges (source, target) both ways between each domain of a host and the next above it.

    A host with any number of labels is taken apart at all its dots, down to two labels.
    """
    labels = F.split("host", "[.]")
    domain = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.size("labels") - 1),
            lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."),
        )
    )
    above = F.regexp_extract("domain", r"^[^.]+[.]([^.]+[.].+)$", 1)
    each = (
        hosts.select(labels.alias("labels"))
        .where(F.size("labels") > 2)
        .select(domain.alias("domain"))
        .distinct()
        .select(F.col("domain").alias("a"), above.alias("b"))
        .where((F.col("a") != "") & (F.col("b") != ""))
    )
    pair = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    return each.select(F.explode(F.array(*pair)).alias("e")).select(
        F.col("e.a").alias("source"), F.col("e.b").alias("target")
    )


def edges_between(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """source, target and weight of the edges between different hosts."""
    links = pages.select(
        F.col("host").alias("source"),
        F.explode(F.regexp_extract_all(F.col("html"), F.lit(_HREF), F.lit(1))).alias("link"),
    )
    whole = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    linked = links.select("source", host_of(whole).alias("target"))
    known = hosts.select("host").union(linked.select(F.col("target").alias("host"))).distinct()
    family = _family(known)
    return (
        linked.union(family)
        .where((F.col("source") != "") & (F.col("target") != "") & (F.col("source") != F.col("target")))
        .groupBy("source", "target")
        .agg(F.log2(F.count("*") + 1).alias("weight"))
    )


def propagated(*graphs: tuple[DataFrame, DataFrame]) -> DataFrame:
    """graph, host and score: PageRank of each graph, personalised to its seeds.

    A graph is its edges (source, target and weight) and its seeds (host, seed); all are
    worked out in the same jobs, and ``graph`` is the place of one in the arguments. A host
    keeps a part of what reaches it and passes the rest on, in rounds, until what is still
    on its way is ``REST`` of the graph's seeds at most. It shrinks by ``DAMPING`` in each
    round at least, so that 24 rounds are enough for any graph; the scores are written and
    looked at after every fourth. What hosts without edges would pass on is lost; the sum of
    scores is bounded by that of the seeds.
    """

    def together(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, (f.select(F.lit(i).alias("graph"), "*") for i, f in enumerate(frames)))

    edges = together([e.select("source", "target", "weight") for e, _ in graphs])
    seeds = together([s.select("host", "seed") for _, s in graphs])
    out = edges.groupBy("graph", "source").agg(F.sum("weight").alias("total"))
    shares = stored(
        edges.join(out, ["graph", "source"]).select(
            "graph", "source", "target", (F.col("weight") / F.col("total")).alias("share")
        ),
        "host-shares",
    )

    def kept(scores: DataFrame) -> tuple[DataFrame, list[float]]:
        seen = Observation()
        each = (F.when(F.col("graph") == i, F.col("score")) for i in range(len(graphs)))
        sums = (F.sum(score).alias(f"sum_{i}") for i, score in enumerate(each))
        table = stored(scores.observe(seen, *sums), "host-scores")
        return table, [seen.get[f"sum_{i}"] or 0.0 for i in range(len(graphs))]

    own = seeds.where(F.col("seed") > 0).select(
        "graph", "host", (F.col("seed") * (1 - DAMPING)).alias("score")
    )
    own, first = kept(own)
    scores, before, new = own, first, first
    # A round that adds ``new`` leaves DAMPING / (1 - DAMPING) of it for all later ones.
    while any(n * DAMPING > REST * f for n, f in zip(new, first)):
        for _ in range(ROUNDS):
            passed = shares.join(scores.withColumnRenamed("host", "source"), ["graph", "source"])
            passed = passed.select(
                "graph",
                F.col("target").alias("host"),
                (F.col("share") * F.col("score") * DAMPING).alias("score"),
            )
            scores = own.union(passed).groupBy("graph", "host").agg(F.sum("score").alias("score"))
        scores, sums = kept(scores)
        # Each round adds more than the next, so that the last added this much at most.
        new = [(s - b) / sum(DAMPING**-i for i in range(ROUNDS)) for s, b in zip(sums, before)]
        before = sums
    return scores


def judged_pages(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page.

    ``pages`` has page_id, url and html; other columns are left alone. A url that is
    null or has no ``://`` has an empty host and path, fits no rule and is allowed;
    null pages have no links; repeated rows are judged each (and count each as
    pages of their host); an empty table gives no rows.
    """
    url = F.col("url").cast("string")
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col("html").cast("string").alias("html"),
    )
    rule, verdict = matched(rules, F.col("host"), F.col("path"))
    ruled = source.withColumns({"rule": rule, "ruling": verdict})
    hosts = stored(
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count(F.when(F.col("ruling") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("ruling") == "block", 1)).alias("blocked"),
        ),
        "hosts",
    )
    edges = stored(edges_between(source.select("host", "html"), hosts), "host-edges")
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    seeds = (
        hosts.select("host", (F.col(c) / F.col("pages")).alias("seed")) for c in ("allowed", "blocked")
    )
    scores = propagated(*zip((edges, back), seeds))
    trust, distrust = (
        scores.where(F.col("graph") == i).select("host", F.col("score").alias(c))
        for i, c in enumerate(("trust", "distrust"))
    )
    free = (F.col("pages") - F.col("allowed") - F.col("blocked")) / F.col("pages")
    free = free * UNJUDGED * (1 - DAMPING)
    weighed = (
        hosts.join(trust, "host", "left")
        .join(distrust, "host", "left")
        .select(
            "host",
            free.alias("free"),
            *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")),
        )
    )
    share = F.col("distrust") / (F.col("distrust") + F.col("trust") + F.col("free"))
    weighed = stored(
        weighed.select(
            "host", "trust", "distrust", F.coalesce(share > THRESHOLD, F.lit(False)).alias("bad")
        ),
        "host-verdicts",
    )
    method = F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")
    return ruled.join(weighed, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruling", method).alias("verdict"),
        "trust",
        "distrust",
    )
