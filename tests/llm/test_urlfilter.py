"""URL rules against a plain loop over the rules."""

import random

from cairn.llm import urlfilter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((k for k in (rest.find(c) for c in "/?#") if k >= 0), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((k for k in (rest.find(c) for c in "?#") if k >= 0), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def verdict(url, rules):
    host, path = parts(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


ODD = [
    None, "", "no scheme", "http://", "http://example.net", "http://EXAMPLE.net/en/x?y#z", "http://example.net/EN/", "x://a.b.example.com/de/1",
    "ftp://net/", "http://net?x", "http://net.net/#/", "a://b://net/", "http://u@example.com:80/de/", "http://.org/fr/", "http://org./fr/",
    "http://ÄÖ.org/fr/ü", "http://a..net/\n/x", "http://notexample.net/en/", "http://x.org/f", "//net/", "http://net/" + "p/" * 20_000, "http://" + "a." * 60 + "net/",
]


def judged(spark, urls, rules):
    rows = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, hit string")
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judge(rows, urlfilter.rule_frame(spark, rules)).collect()}
    assert len(got) == len(urls)
    return [got[k] for k in range(len(urls))]


def test_fixed_rules(spark):
    assert judged(spark, ODD, urlfilter.RULES) == [verdict(u, urlfilter.RULES) for u in ODD]


def test_many_rules_and_colliding_short_hashes(spark, monkeypatch):
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("x/") for _ in range(rng.randint(0, 4)))
    rules = list({(host(), path()[: rng.randint(0, 4)]): rng.choice(["allow", "block"]) for _ in range(150)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("", "/", "block")]
    urls = [f"http://{host()}{path()}{rng.choice(['', '?q=/', '#f'])}" for _ in range(400)]
    for digits in (urlfilter.SHORT, 1):  # with one digit nearly all prefixes collide
        monkeypatch.setattr(urlfilter, "SHORT", digits)
        assert judged(spark, urls, rules) == [verdict(u, rules) for u in urls]


def test_repeated_rules_and_rows(spark):
    rules = [("net", "/", "allow"), ("net", "/", "block")]
    assert judged(spark, ["http://net/"] * 3, rules) == [("net", "/", "net/", "block")] * 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(none, urlfilter.rule_frame(spark)).count() == 0
    assert judged(spark, ["http://net/"], []) == [("net", "/", None, "allow")]
