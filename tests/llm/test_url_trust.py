import duckdb
import pytest

from marketlane.llm import url_trust
from marketlane.llm.sql import CHECKS


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, 1.0, "x") for i, u, h in rows], "page_id long, url string, html string, score double, host string")


CASES = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("https://M.Example.COM/en/1?q#t", "m.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("https://badexample.com/en/a", "badexample.com", "/en/a", "com/", "allow"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("http://a.net/esx", "a.net", "/esx", None, "block"),
    ("http://b.org?x/en/", "b.org", "", None, "allow"),
    ("HTTP://ÀB.com#/", "Àb.com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://u.org/a://b.com/c", "u.org", "/a://b.com/c", None, "allow"),
    ("x://c.com:80/", "c.com:80", "/", None, "allow"),
    ("://\nd.com/\n/y", "\nd.com", "/\n/y", "com/", "allow"),
]


def test_hosts_paths_rules_and_verdicts(spark):
    got = url_trust.url_verdicts(frame(spark, [(k, c[0], None) for k, c in enumerate(CASES)])).collect()
    assert sorted(tuple(r) for r in got) == [(k, *c[1:]) for k, c in enumerate(CASES)]
    assert url_trust.url_verdicts(frame(spark, []).limit(0)).count() == 0


def test_trust_and_distrust_flow_along_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    pages = [
        (1, "http://good.com/", link("liked.org")),
        (2, "http://bad.net/es/", "<a href='//sink.info/'>"),
        (3, "http://shady.org/", link("bad.net") + '<A HREF = http://bad.net/2>'),
        (4, "http://liked.org/", '<a href="/own">'),
        (5, "http://alone.org/", None),
        (5, "http://alone.org/", None),
    ]
    got = {r["host"]: r["verdict"] for r in url_trust.url_verdicts(frame(spark, pages)).collect()}
    assert got["liked.org"] == "allow" and got["shady.org"] == "block" and got["alone.org"] == "allow"
    trust = {r["host"]: r for r in url_trust.host_trust(frame(spark, pages)).collect()}
    assert trust["liked.org"]["trust"] > 0 and trust["shady.org"]["distrust"] > 0 and trust["shady.org"]["trust"] == 0
    assert "sink.info" not in trust or trust["sink.info"]["distrust"] == 0


@pytest.mark.parametrize("rounds", [3, 12])
def test_propagation_equals_plain_iteration(spark, rounds):
    edges = [("trust", "a", "b", 0.25), ("trust", "a", "c", 0.75), ("trust", "b", "c", 1.0), ("trust", "c", "a", 1.0)]
    seeds = {"a": 0.5, "c": 0.5}
    score = {k: 0.15 * m for k, m in seeds.items()}
    for _ in range(rounds):
        new = {k: 0.15 * m for k, m in seeds.items()}
        for _, s, d, w in edges:
            new[d] = new.get(d, 0) + 0.85 * w * score.get(s, 0)
        score = new
    got = url_trust.propagate(
        spark.createDataFrame(edges, "kind string, src string, dst string, share double"),
        spark.createDataFrame([("trust", k, m) for k, m in seeds.items()], "kind string, node string, mass double"),
        rounds=rounds,
    )
    assert {r["node"]: pytest.approx(r["score"]) for r in got.collect()} == score


def test_walk_goes_on_to_the_last_host_and_leaves_addresses_whole(spark):
    chain = [(k, f"http://h{k}.org/", f'<a href="http://h{k - 1}.org/">' if k > 1 else '<a href="http://bad.net/">') for k in range(1, 31)]
    numbers = [(101, "http://10.0.0.1/x", '<a href="http://bad.net/">'), (102, "http://9.0.0.1:80/", None), (103, "http://[::0.0.0.1]/", None)]
    pages = frame(spark, [(0, "http://bad.net/es/", None), *chain, *numbers])
    got = {r["page_id"]: r["verdict"] for r in url_trust.url_verdicts(pages).collect()}
    assert all(got[k] == "block" for k in (0, *range(1, 31), 101)) and got[102] == got[103] == "allow"
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(CHECKS["op5_url_filters"]).df()
    assert dict(zip(want["page_id"], want["verdict"])) == got


def test_scores_stand_still_where_a_cycle_holds_them(spark):
    edges = [("trust", "a", "b", 1.0), ("trust", "b", "a", 1.0), ("trust", "x", "y", 1.0)]
    got = url_trust.propagate(
        spark.createDataFrame(edges, "kind string, src string, dst string, share double"),
        spark.createDataFrame([("trust", "a", 1.0)], "kind string, node string, mass double"),
    )
    assert {r["node"]: r["score"] for r in got.collect()} == pytest.approx({"a": 1 / 1.85, "b": 0.85 / 1.85}, rel=2e-3)
