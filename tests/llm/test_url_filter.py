from odometer.llm.url_filter import RULES, judge_urls

RULE_SCHEMA = "host string, path string, verdict string"


def judge(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, digest string")
    found = judge_urls(pages, spark.createDataFrame(rules, RULE_SCHEMA)).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    "http://Example.ORG/es/1", "https://a.b.example.org/en/1", "https://example.org/en/2?x=/es/", "http://example.org", "http://org/es/",
    "http://notexample.org/es/x", "ftp://x.com/fr/a#b", "http://x.com/de/", "http://com/de/q", "no scheme", None, "", "://", "http:///es/",
    "http://a..org/x", "http://x.com:80/de/", "http://x.com?/de/", "HTTP://É.com/fr/", "a\nb://x.com/de/", "http://org./x",
    "http://" + "a." * 30_000 + "com/de/" + "x" * 100_000, "http://x.com/de", "x://y.org/z://x.com/de/",
]


def test_against_brute_force(spark):
    found = judge(spark, URLS + URLS[:3])
    assert found == {i: brute(u, RULES) for i, u in enumerate(URLS + URLS[:3])}


def test_ties_go_to_the_longer_host_then_to_block(spark):
    rules = [("b.org", "/", "allow"), ("org", "/x/", "block"), ("net", "/", "allow"), ("net", "/", "block")]
    found = judge(spark, ["http://b.org/x/", "http://net/"], rules)
    assert found[0][2:] == ("b.org/", "allow") and found[1][2:] == ("net/", "block")


def test_empty_tables(spark):
    assert judge(spark, []) == {}
    assert judge(spark, ["http://a.org/"], [])[0] == ("a.org", "/", None, "allow")
    assert judge(spark, ["http://a.org/"], [(None, "/", "block")])[0][3] == "allow"
