"""URL verdicts: explicit host and path rules first, link-graph trust for the rest.

Trust starts at hosts whose pages a rule allows and flows along links; distrust
starts at hosts whose pages a rule blocks and flows against them (who links to a
bad host is suspect).  Both are personalised PageRanks over host edges, computed
by joins and sums in Spark until no host's score moves any more, and a host is
blocked when its distrust outweighs its trust.  Host edges are the hyperlinks
between hosts and, both ways, the step from a host to its parent domain; only
edge counts per pair of hosts are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.llm.common import written

DAMPING = 0.85
#: The walk ends when no score has grown by more than this share of itself over ``LOOK`` rounds.
TOLERANCE = 1e-3
LOOK = 5
#: A host is blocked if distrust exceeds so many times its trust.
RATIO = 1.0


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)

#: Numbers between dots, with or without a port, and whatever stands in brackets.
ADDRESS = r"^([0-9.]+(:[0-9]*)?$|\[)"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Longest rule that fits, or NULL."""
    choice = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        choice = F.when(fits, F.lit(rule.text)).otherwise(choice)
    return choice


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    url = F.col("url")
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return split.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))


def link_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: hyperlinks from the pages of one host to another host.

    Absolute and scheme-relative links name their host; relative links stay on
    their own host and are no edges.
    """
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1))
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(found).alias("dst"))
    return (
        links.withColumn("dst", F.translate("dst", CAPITALS, SMALL))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("links"))
    )


def domain_edges(hosts: DataFrame, column: str = "host") -> DataFrame:
    """Each host and its parent domains of at least two labels, one step apart, in both directions; addresses have no parents."""
    labels = F.split(column, r"\.")
    named = ~F.col(column).rlike(ADDRESS)
    steps = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 2)),
        lambda k: F.struct(
            F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("a"),
            F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("b"),
        ),
    )
    up = hosts.where(named & (F.size(labels) > 2)).select(F.explode(steps).alias("s")).select("s.a", "s.b").where("a <> '' AND b <> '' AND a <> b").distinct()
    one = F.lit(1.0).alias("links")
    return up.select(F.col("a").alias("src"), F.col("b").alias("dst"), one).union(up.select("b", "a", one))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``node, kind, score`` of personalised PageRank: after ``rounds`` steps, or without a number when scores stand still.

    ``edges`` (``kind, src, dst, share``) carry each node's score to its
    neighbours in shares that sum to one; ``seeds`` (``kind, node, mass``) are
    where the walk restarts, with mass one per kind.  Both kinds run together.
    Scores begin with the restarts alone, so they only grow, a node at any
    distance is reached in so many rounds, and one that has just been reached
    keeps the walk going.  Each round's scores are a table: the plan stays short,
    and as both sides of the join have an exchange of their own, adaptive
    execution can split the edges of a hub.
    """
    restart = seeds.select("kind", "node", (F.col("mass") * (1 - damping)).alias("part"))
    score = written(restart.withColumnRenamed("part", "score"), "url-trust-scores")
    earlier, number = score, 0
    while rounds is None or number < rounds:
        number += 1
        moved = score.withColumnRenamed("node", "src").join(edges, ["kind", "src"]).select(
            "kind", F.col("dst").alias("node"), (F.col("score") * F.col("share") * damping).alias("part")
        )
        score = written(moved.unionByName(restart).groupBy("kind", "node").agg(F.sum("part").alias("score")), "url-trust-scores")
        if rounds is None and number % LOOK == 0:
            before = earlier.withColumnRenamed("score", "before")
            grown = score.join(before, ["kind", "node"], "left").where(
                F.col("score") - F.coalesce("before", F.lit(0.0)) > F.col("score") * tolerance
            )
            if grown.isEmpty():
                break
            earlier = score
    return score


def host_trust(pages: DataFrame, rules=RULES, damping: float = DAMPING) -> DataFrame:
    """``host, trust, distrust`` of every host that either walk reaches."""
    judgements = judged(pages, rules)
    verdicts = {r.text: r.verdict for r in rules}
    verdict = F.coalesce(*[F.when(F.col("rule") == t, F.lit(v)) for t, v in verdicts.items()]) if verdicts else F.lit(None).cast("string")
    counts = written(
        judgements.where("host <> ''").groupBy("host", verdict.alias("verdict")).agg(F.count("*").cast("double").alias("pages")), "url-hosts"
    )
    kind = F.when(F.col("verdict") == "allow", "trust").when(F.col("verdict") == "block", "distrust")
    seeded = counts.withColumn("kind", kind).where(F.col("kind").isNotNull())
    totals = {r["kind"]: r["pages"] for r in seeded.groupBy("kind").agg(F.sum("pages").alias("pages")).collect()}
    total = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in totals.items()], F.lit(1.0))
    seeds = seeded.select("kind", F.col("host").alias("node"), (F.col("pages") / total).alias("mass"))
    links = written(link_edges(pages), "url-links")
    hosts = counts.select("host").union(links.select("src")).union(links.select("dst")).distinct()
    pairs = links.union(domain_edges(hosts)).groupBy("src", "dst").agg(F.sum("links").alias("links"))
    both = pairs.select(F.lit("trust").alias("kind"), "src", "dst", "links").union(pairs.select(F.lit("distrust"), "dst", "src", "links"))
    leaving = both.groupBy("kind", "src").agg(F.sum("links").alias("out"))
    edges = written(both.join(leaving, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("out")).alias("share")), "url-edges")
    scores = propagate(edges, seeds, damping)
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
    return scores.groupBy(F.col("node").alias("host")).agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def url_verdicts(pages: DataFrame, rules=RULES, damping: float = DAMPING, ratio: float = RATIO) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id, url, html``).

    The longest rule that fits decides; without one, a host is blocked if its
    distrust exceeds ``ratio`` times its trust and allowed otherwise, also when
    neither walk reaches it.  A missing url and one without ``://`` have an empty
    host and path and are allowed.  Missing html has no links.  Repeated rows
    give repeated results; further columns are ignored; an empty table gives no rows.
    """
    bad = host_trust(pages, rules, damping).where(F.col("distrust") > F.col("trust") * ratio).select("host", F.lit(True).alias("bad"))
    verdicts = [F.when(F.col("rule") == r.text, F.lit(r.verdict)) for r in rules]
    by_method = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return judged(pages, rules).join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(*verdicts, by_method).alias("verdict")
    )
