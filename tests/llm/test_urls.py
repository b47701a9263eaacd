import random

from pelagia.llm.url_rules import RULES, judge

UPPER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(UPPER.get(c, c) for c in rest[:end]), rest[end:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def brute(url, rules):
    host, path = split(url)
    fits = [(-len(h) - len(p), -len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)]
    best = min(fits) if fits else None
    return host, path, best and best[2], best[3] if best else "allow"


def frames(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "a", "b", "c") for i, u in enumerate(urls)], "page_id long, url string, host string, key string, verdict string")
    return pages, spark.createDataFrame(rules, "host string, path string, verdict string")


def test_rules_match_brute_force(spark):
    rng = random.Random(3)
    hosts = ["net", "example.net", "EXAMPLE.Net", "www.example.net", "example-x.net", "a.example.net.", "x..net", "org", "m.org", "example.com", "com", "examplenet", "ünï.net", "b.a.example.com", "example.com:80", ""]
    tails = ["", "/", "/en/", "/en/x?y=/de/", "/de", "/de/?", "#/en/", "?a://b/en/", "/fr/\n/z", "/EN/", "/" + "p" * 30_000]
    urls = [f"{rng.choice(('http', 'https', ''))}://{rng.choice(hosts)}{rng.choice(tails)}" for _ in range(600)] + [None, "", "no scheme/en/", "://", "a://b://c/en/"]
    rules = [*RULES, ("example.net", "/en/x", "block"), ("www.example.net", "/", "block"), ("a.example.com", "", "allow"), ("net", "/", "block"), ("", "/zz", "block"), ("b.a.example.com", "/de/", "allow")]
    for given in (list(RULES), rules):
        pages, table = frames(spark, urls, given)
        got = {r.page_id: tuple(r)[1:] for r in judge(pages, table).collect()}
        assert got == {i: brute(u, given) for i, u in enumerate(urls)}


def test_one_hot_url_is_spread_and_empty_tables_work(spark):
    pages, rules = frames(spark, ["http://a.example.net/en/1"] * 4000 + ["http://z.org/"] * 50, list(RULES))
    out = judge(pages, rules)
    assert out.filter("rule = 'example.net/en/' AND verdict = 'allow'").count() == 4000
    held = [len(p) for p in out.rdd.glom().collect()]
    assert max(held) < 4000 * 0.75
    assert judge(pages.limit(0), rules).count() == 0
    assert judge(pages, rules.limit(0)).filter("rule IS NULL AND verdict = 'allow'").count() == 4050
    nulls = spark.createDataFrame([(None, None, "block")], rules.schema)
    assert judge(pages, nulls).filter("verdict = 'block'").count() == 4050
