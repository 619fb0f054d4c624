from collections import defaultdict

from obsvar.llm import urlgraph
from obsvar.llm.urlgraph import Rule

RULES = [Rule("allow", "good.org", "/"), Rule("block", "bad.net", "/"), Rule("allow", "ok.bad.net", "/en/"), Rule("block", "good.org", "/ads/")]
PAGES = [
    (1, "https://good.org/a", '<a href="https://friend.io/x">f</a> <a href=\'//Friend.IO/y\'>f</a>'),
    (2, "http://www.Good.org/ads/1", '<a href="/local">no</a>'),
    (3, "https://friend.io/?q", '<a href="https://pal.io/">p</a>'),
    (4, "https://pal.io#top", None),
    (5, "https://spam.biz/x", '<a href="http://bad.net/y">b</a>'),
    (6, "https://farm.biz", '<a href="http://spam.biz">s</a><img src="http://bad.net/i.png">'),
    (7, "http://bad.net/y", ""),
    (8, "http://ok.bad.net/en/z", '<a href="https://lone.com">l</a>'),
    (9, "http://ok.bad.net/fr/z", ""),
    (10, None, '<a href="http://bad.net">b</a>'),
    (11, "no scheme", "x"),
    (12, "x://", ""),
    (13, "https://far.example.com/path?x#y", ""),
    (13, "https://far.example.com/path?x#y", ""),
    (None, "ftp://lone.com/?a://b", ""),
]


def test_rules_hosts_paths_and_the_walk(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = urlgraph.judged(pages, RULES).collect()
    assert len(found) == len(PAGES) and found[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "verdict"}
    by = {r.page_id: r for r in found}
    assert [(by[k].host, by[k].path) for k in (2, 3, 4, 10, 11, 12, 13)] == [
        ("www.good.org", "/ads/1"), ("friend.io", "/"), ("pal.io", ""), ("", ""), ("", ""), ("", ""), ("far.example.com", "/path"),
    ]
    assert [by[k].rule for k in (1, 2, 7, 8, 9, 13)] == ["good.org/", "good.org/ads/", "bad.net/", "ok.bad.net/en/", "bad.net/", None]
    verdicts = {k: r.verdict for k, r in by.items()}
    assert [k for k, v in verdicts.items() if v == "block"] == [2, 5, 6, 7, 9]  # 5 and 6 link to blocked hosts
    assert by[None].host == "lone.com"


def test_propagation_equals_brute_force(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 4.0), ("d", "c", 1.0), ("e", "d", 3.0)]
    seeds = [("a", 0.7, 0.0), ("b", 0.3, 0.2), ("c", 0.0, 0.8)]
    ranks = urlgraph.propagate(spark.createDataFrame(edges, "a string, b string, w double"), spark.createDataFrame(seeds, "host string, trust double, distrust double"))
    out, into = defaultdict(float), defaultdict(float)
    for a, b, w in edges:
        out[a] += w
        into[b] += w
    now = {h: (t, d) for h, t, d in seeds}
    for _ in range(urlgraph.ROUNDS):
        new = defaultdict(lambda: [0.0, 0.0])
        for h, t, d in seeds:
            new[h][0] += 0.15 * t
            new[h][1] += 0.15 * d
        for a, b, w in edges:
            new[b][0] += 0.85 * w / out[a] * now.get(a, (0, 0))[0]
            new[a][1] += 0.85 * w / into[b] * now.get(b, (0, 0))[1]
        now = {h: tuple(v) for h, v in new.items()}
    for r in ranks.collect():
        assert abs(r.trust - now[r.host][0]) < 1e-9 and abs(r.distrust - now[r.host][1]) < 1e-9


def test_edges(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urlgraph.judged(pages, RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.b/c", None, "x", "y")], "page_id long, url string, html string, host string, verdict string")
    assert [(r.host, r.verdict, r.rule) for r in urlgraph.judged(some, []).collect()] == [("a.b", "allow", None)]
