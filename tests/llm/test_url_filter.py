"""URL rules and redirect equivalence against a plain version and the SQL."""

import duckdb
import pytest

from kiln.llm import oracles, url_filter
from kiln.llm.queries import URL_RULES
from tests.llm.helpers import find

SCHEMA = "page_id long, url string, html string, u string, v string, key string, alias string, row string, node string"


def canonical(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


PAGES = [
    (1, "https://a.example.net/x/1", canonical("https://b.example.com/de/1")),  # to a blocked page
    (2, "http://c.example.net/2", '<META HTTP-EQUIV=refresh CONTENT="0; URL=\'https://A.example.net/x/1#top\'">'),  # a chain
    (3, "https://b.example.com/de/1", "<p>blocked by its rule</p>"),
    (4, "https://ok.org/4", canonical("https://b.example.com/de/1")),  # allowed by its rule; its class is not blocked
    (5, "https://d.example.net/5", canonical("https://e.example.com/de/9")),  # blocked target without a page
    (6, "https://d.example.net/5#frag", None),  # an alias by its fragment
    (7, "https://d.example.net/7", "<!-- " + canonical("https://e.example.com/de/9") + " --><script>" + canonical("https://e.example.com/de/9") + "</script>"),
    (8, "https://d.example.net/a/b/8", '<link href="../../5" rel="alternate canonical">'),  # relative, dot segments
    (9, "https://d.example.net/9?x=1&y=2", ""),
    (10, "https://d.example.net/10", canonical("/9?x=1&amp;y=2")),
    (11, "https://d.example.net/9?x=1&y=2", '<meta http-equiv="refresh" content="5;url=//e.example.com/de/9">'),  # a shared URL
    (12, None, canonical("https://e.example.com/de/9")),
    (13, "no scheme /de/", canonical("https://e.example.com/de/9")),
    (14, "HTTPS://EXAMPLE.ORG", None),
    (15, "https://sub.Example.Org/en/12?u=https://x.com/de/", None),
    (16, "https://notexample.org/en/1", None),
    (17, "https://example.com/fr/1", canonical("https://e.example.com/de/9")),  # explicit allow
    (18, "https://f.example.net/18", canonical("https://example.com/fr/1")),  # its class holds an allow: nothing passed on
    (19, "https://g.example.net/19", '<link rel="stylesheet" href="https://e.example.com/de/9"><meta name="refresh" content="0;url=https://e.example.com/de/9">'),
    (20, "https://h.example.net/20", canonical("mailto:x@example.com")),
    (21, "https://h.example.net/21", canonical("")),
    (22, "https://z.example.net/5", canonical("https://z.example.com/de/")),
    (23, "https://z.example.net/dir/q", canonical("?page=1")),
    (24, "https://z.example.net/dir/q?page=1", canonical("../5")),
    (25, "ftp://com/de/", None),
    (26, "://com/de/x", None),
    (9, "https://d.example.net/9?x=1&y=2", ""),  # a row repeated as a whole
]
WANT = {
    1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "allow", 11: "allow", 12: "allow", 13: "allow",
    14: "allow", 15: "block", 16: "allow", 17: "allow", 18: "allow", 19: "allow", 20: "allow", 21: "allow", 22: "block", 23: "block", 24: "block", 25: "block", 26: "block",
}


def frame(spark, pages, parts=3):
    return spark.createDataFrame([(*p, "u", "v", "k", "a", "r", "n") for p in pages], SCHEMA).repartition(parts)


def verdicts(df):
    out = {}
    for r in df.collect():
        assert out.setdefault(r.page_id, r.verdict) == r.verdict
    return out


def test_aliases_and_precedence(spark):
    got = url_filter.filter_urls(frame(spark, PAGES), URL_RULES)
    assert got.count() == len(PAGES) and got.columns[-4:] == ["host", "path", "rule", "verdict"]
    assert verdicts(got) == WANT
    # without the explicit allows (4 and 17) the classes of 1 and of 5 are blocked as a whole
    free = [p for p in PAGES if p[0] not in (4, 17, 18)]
    blocked = {1, 2, 5, 6, 8, 9, 10, 11}
    assert verdicts(url_filter.filter_urls(frame(spark, free), URL_RULES)) == {p[0]: "block" if p[0] in blocked else WANT[p[0]] for p in free}


def test_parts_and_rules(spark):
    rows = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.filter_urls(frame(spark, PAGES), URL_RULES).collect()}
    assert rows[12] == ("", "", None) and rows[13] == ("", "", None)
    assert rows[14] == ("example.org", "", None)  # an empty path starts with no rule's
    assert rows[15] == ("sub.example.org", "/en/12", "example.org/en/1")
    assert rows[16] == ("notexample.org", "/en/1", "org/")
    assert rows[26] == ("com", "/de/x", "com/de/")
    assert rows[25] == ("com", "/de/", "com/de/")


@pytest.mark.parametrize("drop", [(), (4, 17, 18)])
def test_sql_agrees(spark, drop):
    pages = [p for p in PAGES if p[0] not in drop]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({oracles.op13(URL_RULES)})").fetchall()
    got = url_filter.filter_urls(frame(spark, pages), URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_hub_and_long_chain(spark):
    """A third of all pages redirect to one page, and a chain of 40 leads there; the classes are those of a plain union-find."""
    hub = "https://hub.example.net/"
    pages = [(k, f"https://s{k}.example.net/p", canonical(hub)) for k in range(100)]
    pages += [(100 + k, f"https://c.example.net/{k}", canonical(f"https://c.example.net/{k + 1}") if k < 39 else canonical(hub)) for k in range(40)]
    pages += [(200, hub, canonical("https://bad.example.com/de/")), (201, "https://alone.example.net/", canonical("https://c.example.org/fine"))]
    parent = {}
    edges = [(r.u, r.v) for r in url_filter.page_links(frame(spark, pages)).collect()]
    for u, v in edges:
        a, b = find(parent, parent.setdefault(u, u) and u), find(parent, parent.setdefault(v, v) and v)
        parent[a] = b
    bad = find(parent, "https://bad.example.com/de/")
    want = {k: "block" if find(parent, u) == bad else "allow" for k, u, _ in pages}
    assert sum(v == "block" for v in want.values()) == 141
    assert verdicts(url_filter.filter_urls(frame(spark, pages), URL_RULES)) == want



def test_given_redirects_long_pages_and_empty_tables(spark):
    big = "<p>" + "refresh canonical text " * 200_000 + "</p>" + canonical("https://b.example.com/de/1")
    pages = [(1, "https://a.example.net/1", big), (2, "https://a.example.net/2", None)]
    moved = spark.createDataFrame([("https://a.example.net/2", "/1"), (None, "https://b.example.com/de/1"), ("https://a.example.net/2", None)], "from_url string, to_url string")
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert verdicts(url_filter.filter_urls(df, URL_RULES, moved)) == {1: "block", 2: "block"}
    assert verdicts(url_filter.filter_urls(df, URL_RULES, html=None)) == {1: "allow", 2: "allow"}
    assert url_filter.filter_urls(df.limit(0), URL_RULES, moved.limit(0)).count() == 0
    assert verdicts(url_filter.filter_urls(df, [])) == {1: "allow", 2: "allow"}
    with pytest.raises(ValueError):
        url_filter.filter_urls(df.withColumnRenamed("html", "rule"), URL_RULES, html="rule")


def test_main_path_is_native(spark):
    """No Python on the main path: the plans of links and verdicts hold none."""
    for df in (url_filter.page_links(frame(spark, PAGES)), url_filter.filter_urls(frame(spark, PAGES), URL_RULES)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
