import random
import re

from fareflow.llm.url_rules import judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.example.com", "/de/x", "allow"), ("Example.COM", "", "allow"), ("example.com", "/de/", "allow"), (None, "/", "block"),
         ("", "/", "block"), ("b.org", None, "block")]


def plain(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})), m[2]) if m else ("", "")
    best = None
    for h, p, v in rules:
        h, p = (h or "").lower(), p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h) + len(p), len(h), v)
            if best is None or key > best[0]:
                best = (key, h + p, v)
    return host, path, best and best[1], best[2] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, table, salts=3).collect()}
    assert out == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_hand_made_urls(spark):
    check(spark, [None, "", "no scheme", "http://", "https://NET/", "http://net", "http://x.net/?a://b", "http://xnet/", "http://a.example.net/en/1#t",
                  "http://example.com/de/x", "http://a.example.com/de/xy", "http://q.a.example.com/de", "http://org/fr/", "http://b.org", "x\n://b.org/\n",
                  "http://example.com:80/de/", "http://a://b.org/"] * 2, RULES)


def test_random_urls(spark):
    rng = random.Random(2)
    hosts = [".".join(rng.choices(["a", "b", "c", "com"], k=rng.randint(1, 5))) for _ in range(60)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/b"]
    rules = sorted({(rng.choice(hosts), rng.choice(paths)) for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    check(spark, [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '?q'])}" for _ in range(400)], rules)


def test_empty_sides_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "x", "y")], "page_id long, url string, Rule string, key string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    row = judge_urls(pages, none, default="block").collect()[0]
    assert (row.rule, row.verdict, row.key) == (None, "block", "y")
    assert judge_urls(pages.limit(0), none).count() == 0
