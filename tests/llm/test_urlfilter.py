import pytest

from reelrank.llm import urlfilter as uf


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = [None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.COM/en/a?x#y", "https://www.example.com/en", "https://a.www.example.com/en/",
        "https://notexample.com/en/x", "https://example.com", "https://example.com?q=/en/", "https://example.com#/en/", "https://example.com/EN/",
        "ftp://x.net/es/", "ftp://x.net/fr", "ftp://x.net/fr/a://b.com/en/", "ftp://net/es/1", "http://user@example.com:80/en/", "http://example.com./en/",
        "http://é.example.com/en/ü", "http://com/", "http://.com/", "http://a..com//en/", "http://example.com/en/\n/x", "http://x.org/en/",
        "http://a.b.c.d.e.example.com/" + "en/" * 5000, "http://" + "a." * 3000 + "example.com/en/"]
MORE = uf.RULES + [("example.com", "/en/secret", "block"), ("a.b.c.d.e.example.com", "", "allow"), ("", "", "block"), ("org", "/e", "block"),
                   ("org", "/en/", "allow"), ("c.d.e.example.com", "/en/en/e", "block"), ("user@example.com:80", "/", "block"), ("x.net", "es", "block")]


def pages(spark, urls):
    rows = [(i, u, "h", "p", 1) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, row int")


@pytest.mark.parametrize("rules", [uf.RULES, MORE], ids=["contract", "more"])
@pytest.mark.parametrize("limit", [uf.BROADCAST_BYTES, 0], ids=["broadcast", "salted"])
def test_against_brute_force(spark, monkeypatch, rules, limit):
    monkeypatch.setattr(uf, "BROADCAST_BYTES", limit)
    urls = URLS + ["https://example.com/en/secrets", "https://www.example.com/en/secret/", "http://x.org/english"]
    got = uf.filter_urls(pages(spark, urls), uf.rule_frame(spark, rules)).collect()
    want = [(i, *brute(u, [r for r in rules if not r[1] or r[1][0] == "/"])) for i, u in enumerate(urls)]
    assert sorted(tuple(r) for r in got) == want


def test_repeats_nulls_empty_and_conflicts(spark):
    rows = [(1, "http://a.com/x")] * 3 + [(None, "http://a.com/x"), (1, "http://b.net/es/"), (None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((tuple(r) for r in uf.op11_url_filters(df).collect()), key=str)
    a, b = ("a.com", "/x", "com/", "allow"), ("b.net", "/es/", "net/es/", "block")
    assert got == sorted([(1, *a)] * 3 + [(None, *a), (1, *b), (None, "", "", None, "allow")], key=str)
    assert uf.op11_url_filters(df.where("false")).count() == 0
    none = spark.createDataFrame([("com", "/", "maybe")], "host string, path string, verdict string")
    assert {(r.rule, r.verdict) for r in uf.filter_urls(df, none, "block").collect()} == {(None, "block")}
    both = uf.rule_frame(spark, [("A.com", "/", "allow"), ("a.com", "/", "block"), ("a.com", "/", "allow")])
    assert {r.verdict for r in uf.filter_urls(df.where("url LIKE '%a.com%'"), both).collect()} == {"block"}


def test_whole_table_and_no_python(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    got = uf.op11_url_filters(table)
    plan = got._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    want = [(r.page_id, *brute(r.url, uf.RULES)) for r in table.select("page_id", "url").collect()]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
