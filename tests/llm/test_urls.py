import random
import re

from pyspark.sql import functions as F

from strataquarry.llm import urls


def plain(url, listed=frozenset(), rules=urls.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, None)
    return host, path, rule, verdict or ("block" if plain_key(url) in listed else "allow")


def plain_key(url):
    if not url or "://" not in url:
        return None
    rest = url.split("://", 1)[1]
    host, path = plain_parts(rest)
    host = re.sub(r"^www\.|:(?:80|443)\Z", "", re.sub(r"^[^@]*@", "", host, count=1))
    if not host:
        return None
    path = re.sub(r"/+\Z", "", re.sub(r"(?:/index)?\.html?\Z", "", path))
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    args = sorted(p for p in (query[1] if query else "").split("&") if p and p.split("=")[0] not in ("ref", "gclid", "fbclid") and not p.startswith("utm_"))
    return host + path + ("?" + "&".join(args) if args else "")


def plain_parts(rest):
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


CASES = [
    None, "", "no scheme", "http://", "http:///en/x", "HTTP://A.Example.NET/en/1", "http://example.net/en", "http://example.net/en/", "http://badexample.net/en/1", "http://net", "http://net/", "http://x.net?a/b", "http://x.net#/y",
    "https://u:p@www.b.example.com:443/de/a/index.html?b=2&utm_source=x&a=1&ref=q#z", "https://b.example.com/de/a?a=1&b=2", "http://c.org/fr/", "http://c.org/frx/", "http://org/fr/x", "x://y://z.net/", "http://ÄB.Net/É", "http://s.info/a.html\n", "http://s.info/a/\nb/",
    "http://s.info/" + "long/" * 20_000, "http://www.www.s.info/index.htm", "http://s.info/?&&=&utm_x", "http://S.INFO:80//",
]


def test_equals_plain_version(spark):
    rng = random.Random(2)
    hosts = ["a.example.net", "www.example.com", "q.org", "shop.info", "m.shop.info:80", "u@shop.info"]
    made = CASES + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{rng.randrange(30)}{rng.choice(['', '/', '.html', '?b=1&a=2', '?utm_z=1', '#t'])}" for _ in range(400)]
    rows = [(i, u, "h") for i, u in enumerate(made)] + [(3, made[3], "h"), (None, made[-1], None)]
    listed = [u for i, u in enumerate(made) if i % 3 == 0] + [made[30], None]
    keys = {plain_key(u) for u in listed} - {None}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("key", "block", "words", "listed", "r", "possible")})
    want = sorted(((i, *plain(u, keys), plain_key(u) in keys) for i, u, _ in rows), key=repr)
    for largest in (urls.LARGEST, 0):  # the filter as a broadcast and as a join on its blocks
        got = urls.judge_urls(df, spark.createDataFrame([(u,) for u in listed], "url string"), largest=largest).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(w[4] == "block" and w[3] is None for w in want) and {w[3] for w in want} == {None, "net/", "example.net/en/", "example.com/de/", "org/fr/"}


def test_filter_loses_nothing_and_passes_few(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("in"), "id").alias("key"))
    filtered, blocks = urls.bloom(keys, 20_000)
    assert filtered.count() <= blocks
    assert urls.possible(keys, filtered, blocks, True).where("not possible").count() == 0
    out = spark.range(50_000).select(F.concat(F.lit("out"), "id").alias("key"))
    assert 0 < urls.possible(out, filtered, blocks, True).where("possible").count() < 0.015 * 50_000


def test_no_python_worker_and_hot_urls(spark):
    """Every step is native; false positives of a filter of one bit a URL go in the exact join, hot URLs included."""
    rows = [(i, "http://hot.info/x") for i in range(3000)] + [(3000 + i, f"http://cold.info/{i}") for i in range(3000)]
    listed = spark.createDataFrame([(f"http://cold.info/{i}/",) for i in range(0, 600, 2)] + [("http://hot.info/x#y",)], "url string")
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), listed, bits=1)
    blocked = {r.page_id for r in out.where("verdict = 'block'").select("page_id").collect()}
    assert blocked == set(range(3000)) | {3000 + i for i in range(0, 600, 2)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables_and_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, none.select("url")).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/x")], none.schema)
    assert [tuple(r) for r in urls.judge_urls(some, none.select("url")).collect()] == [(1, "a.net", "/x", "net/", "block", False)]
    assert [tuple(r) for r in urls.judge_urls(some, some.select("url"), rules=()).collect()] == [(1, "a.net", "/x", None, "block", True)]
    tie = (("allow", "b.a.net", "/"), ("block", "a.net", "/x/"))
    two = spark.createDataFrame([(1, "http://b.a.net/x/y")], none.schema)
    assert urls.judge_urls(two, none.select("url"), rules=tie).first().rule == "b.a.net/"
