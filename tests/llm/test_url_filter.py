import re

import duckdb

from tablefit.llm import url_filter

SF001 = "/root/testdata/sf0.001"


def plain(url, listed):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")

    def form(h, p):
        return re.sub(r"\.html?$", "", re.sub("/+$", "", re.sub(r"^(www|m)\.", "", h) + p)) if h else None

    fits = [(r, v) for r, v in url_filter.RULES
            if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    rule, verdict = max(fits, key=lambda r: len(r[0])) if fits else (None, None)
    forms = {form(*re.search(r"://([^/?#]*)([^?#]*)", x).groups()) for x in listed if x and "://" in x}
    return host, path, rule, verdict or ("block" if host and form(host, path) in forms else "allow")


URLS = ["http://A.Org/x", "org://org/", "http://xorg/", "http://example.org/es/1?x", "http://www.example.org/es", "http://b.example.org/en/12#f",
        "http://example.org", "http://x.com/fr/", "http://com/de/q.html", "http://x.com/de", "http://www.bad.net/p/", "https://m.bad.net/p.html?q=1#z",
        "http://bad.net/p2", "HTTP://BAD.net/P", None, "", "no scheme", "http://", "http:///p", "a://b://c/d", "http://bad.net/p", "http://bad.net/p",
        "http://é.net/ü", "http://u@bad.net:80/p", "x" * 100_000 + "://long.net/" + "y" * 100_000]


def test_rules_list_and_odd_urls(spark):
    listed = ["https://bad.net/p", None, "", "nothing", "http://www.long.net/q"]
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "1 AS form", "2 AS block")
    got = url_filter.judge(pages, spark.createDataFrame([(x,) for x in listed], "url string")).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: plain(u, listed) for i, u in enumerate(URLS)}
    assert len(got) == len(URLS)


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF001}/pages.parquet'")
    rel = con.sql(url_filter.OP5_SQL)
    got = sorted(map(tuple, url_filter.op5_url_filter(spark, SF001).select(*rel.columns).collect()))
    assert got == sorted(rel.fetchall(), key=lambda r: r[0])
    assert len({r[4] for r in got}) == 2


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(3000).selectExpr("concat('l', id) AS form")
    forms = listed.union(spark.range(20_000).selectExpr("concat('o', id) AS form"))
    for bound in (10**6, 0):
        kept, url_filter.BROADCAST_BLOCKS = url_filter.BROADCAST_BLOCKS, bound
        passed = [r.form for r in url_filter.possible(forms, listed).collect()]
        url_filter.BROADCAST_BLOCKS = kept
        assert sum(f[0] == "l" for f in passed) == 3000
        assert sum(f[0] == "o" for f in passed) < 400


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string")
    assert url_filter.judge(pages, pages.limit(0).select("url")).first().verdict == "allow"
    assert url_filter.judge(pages.limit(0), pages.select("url")).count() == 0


def test_the_join_decides_verdicts(spark, monkeypatch):
    """A small filter passes many unlisted URLs; the exact join takes them out again."""
    urls = [f"http://www.host{i % 7}.net/page/{i}" for i in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = pages.where("page_id % 8 = 0").selectExpr("replace(url, 'www.', 'm.') || '.html?x=1' AS url")
    monkeypatch.setattr(url_filter, "BITS_PER_ENTRY", 1)
    forms = pages.select(url_filter.canonical(url_filter.host_of("url"), url_filter.path_of("url")).alias("form"))
    short = listed.select(url_filter.canonical(url_filter.host_of("url"), url_filter.path_of("url")).alias("form"))
    assert url_filter.possible(forms, short).count() > 400
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, listed).collect()}
    assert got == {i: "block" if i % 8 == 0 else "allow" for i in range(2000)}  # of one host, some and some not


def test_the_query_lists_some_urls_of_a_host(spark):
    rows = [r for r in url_filter.op5_url_filter(spark, SF001).collect() if r.rule is None]
    shares = {}
    for r in rows:
        shares.setdefault(r.host, set()).add(r.verdict)
    assert any(len(v) == 2 for v in shares.values())
    assert 0.03 < sum(r.verdict == "block" for r in rows) / len(rows) < 0.3
