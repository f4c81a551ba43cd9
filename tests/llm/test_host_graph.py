import numpy as np
import pytest
from fixtures import SF

from tidegate.llm import host_graph as hg
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES, URL_RULES

PAGES = "page_id long, url string, html string"


def power(links, seeds, damping=hg.DAMPING):
    hosts = sorted({h for s, d, _ in links for h in (s, d)} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    out = np.zeros(len(hosts))
    for s, _, w in links:
        out[at[s]] += w
    base = np.zeros(len(hosts))
    for h, w in seeds.items():
        base[at[h]] = w / sum(seeds.values())
    r = base * (1 - damping)
    for _ in range(300):
        new = base * (1 - damping)
        for s, d, w in links:
            new[at[d]] += damping * r[at[s]] * w / out[at[s]]
        r = new
    return {h: r[at[h]] / r.sum() for h in hosts}


def link(*urls):
    return "".join(f'<p><a class="x" href="{u}">t</a>' for u in urls)


GRAPH = [
    ("https://good.org/a", link("https://friend.net/x", "//other.net/y", "/own", "https://good.org/b")),
    ("https://friend.net/x", link("https://second.net/", "https://SECOND.net/q")),
    ("https://spam.example.org/en/1", link("https://good.org/a")),
    ("https://farm.net/1", link("https://spam.example.org/en/1")),
    ("https://farm.net/2", link("https://spam.example.org/en/1", "https://friend.net/z")),
    ("https://ring.net/", link("https://farm.net/1")),
    ("https://lonely.net/", ""),
]


def test_scores_agree_with_power_iteration(spark, monkeypatch):
    monkeypatch.setattr(hg, "TOLERANCE", 1e-7)
    monkeypatch.setattr(hg, "ROUNDS", 80)
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(GRAPH)], PAGES)
    links = hg.host_links(pages)
    rows = [(r.src, r.dst, r.weight) for r in links.collect()]
    assert ("good.org", "friend.net", 1.0) in rows and ("farm.net", "spam.example.org", 2.0) in rows and not [r for r in rows if r[0] == r[1]]
    seeds = spark.createDataFrame([("trust", "good.org", 1.0), ("distrust", "spam.example.org", 0.5), ("distrust", "good.org", 0.25)], "kind string, host string, weight double")
    got = {(r.kind, r.host): r.score for r in hg.propagated(links, seeds).collect()}
    want = {("trust", h): s for h, s in power(rows, {"good.org": 1.0}).items()}
    want |= {("distrust", h): s for h, s in power([(d, s, w) for s, d, w in rows], {"spam.example.org": 0.5, "good.org": 0.25}).items()}
    for k, s in want.items():
        assert got.get(k, 0.0) == pytest.approx(s, abs=1e-5)


def test_verdicts(spark):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(GRAPH)], PAGES)
    got = {r.url: (r.rule, r.verdict) for r in hg.judged(pages, URL_RULES).collect()}
    assert got["https://good.org/a"] == ("org/", "allow") and got["https://spam.example.org/en/1"] == ("example.org/en/1", "block")
    assert got["https://farm.net/1"] == (None, "block") and got["https://friend.net/x"] == (None, "allow") and got["https://lonely.net/"] == (None, "allow")


def test_hosts_paths_and_rules(spark):
    urls = {"HTTP://A.Example.ORG/es/?q": ("a.example.org", "/es/", "example.org/es/"), "https://example.org": ("example.org", "", None),
            "x://example.org/en/12#f": ("example.org", "/en/12", "example.org/en/1"), "https://notexample.org/en/1": ("notexample.org", "/en/1", "org/"),
            "https://a.com/fr/x": ("a.com", "/fr/x", "com/fr/"), "https://a.com/en/": ("a.com", "/en/", None), "no scheme": ("", "", None), None: ("", "", None),
            "": ("", "", None), "https://?x": ("", "", None), "https://ÄB.org:8080/a://b/c": ("Äb.org:8080", "/a://b/c", None), "https:///p": ("", "/p", None)}
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES).selectExpr("*", "1 as rule", "'h' as host", "0 as kind", "2 as score")
    out = hg.judged(pages, URL_RULES)
    assert {r.url: (r.host, r.path, r.rule) for r in out.collect()} == urls
    assert out.columns == ["page_id", "url", "html", "kind", "score", "host", "path", "rule", "verdict", "trust", "distrust"]


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "https://a.org/", None)] * 3, PAGES)
    assert [r.verdict for r in hg.judged(pages, URL_RULES).collect()] == ["allow"] * 3
    assert hg.judged(pages.where("page_id < 0"), URL_RULES).count() == 0


def test_the_rules_by_brute_force_on_the_smallest_table(spark):
    for r in QUERIES["op2_host_graph"](spark, SF).join(table(spark, SF, "pages"), "page_id").collect():
        _, sep, rest = (r.url or "").partition("://")
        host = rest[: min([len(rest), *[rest.index(c) for c in "/?#" if c in rest]])] if sep else ""
        path = rest[len(host) :]
        path = path[: min([len(path), *[path.index(c) for c in "?#" if c in path]])]
        fits = [(len(rule), rule, verdict) for rule, verdict in URL_RULES for name, _, start in [rule.partition("/")]
                if (host.lower() == name or host.lower().endswith("." + name)) and path.startswith("/" + start)]
        assert (r.host, r.path, r.rule) == (host.lower(), path, max(fits)[1] if fits else None)
        assert not fits or r.verdict == max(fits)[2]


def test_hosts_of_one_domain_are_joined_without_a_page_on_it(spark):
    urls = ["https://bad.example.org/en/1", "https://a.b.example.org:80/", "https://www.shop.co.uk/", "https://shop.de./", "http://10.0.0.1/", "http://[::1]/", "https://localhost/", "x", None]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    rows = [(r.src, r.dst, r.weight) for r in hg.host_links(pages).collect()]
    up = {("bad.example.org", "example.org"), ("a.b.example.org:80", "a.b.example.org"), ("a.b.example.org", "b.example.org"),
          ("b.example.org", "example.org"), ("www.shop.co.uk", "shop.co.uk"), ("shop.de.", "shop.de")}
    assert sorted(rows) == sorted((s, d, 1.0) for a, b in up for s, d in ((a, b), (b, a)))
    rules = [("bad.example.org/", "block")]
    got = {r.host: (r.rule, r.distrust > 0) for r in hg.judged(pages, rules).collect()}
    assert got["a.b.example.org:80"] == (None, True) and got["www.shop.co.uk"] == (None, False)


def test_the_given_pages_have_edges(spark):
    links = hg.host_links(table(spark, SF, "pages")).collect()
    assert len(links) >= len({r.src for r in links}) > 0
    scored = QUERIES["op2_host_graph"](spark, SF).where("host <> ''").collect()
    assert all(r.trust > 0 for r in scored if r.host.endswith(".example.org"))
