"""URL rules against a check of every rule, and the cascade's exactness with far too small filters."""

import random
import re

import pytest

from tests.compare import difference, oracle_connection
from yieldstone.llm import url_filter as uf
from yieldstone.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.key), r.action == "block"), default=None)
    return host, path, best.key if best else None, best.action if best else default


def test_query_matches_sql(spark):
    assert difference(QUERIES["op2_url_filter"](spark, FOLDER), oracle_connection(FOLDER), ORACLE["op2_url_filter"]) is None


@pytest.mark.parametrize("bits", [2, 8])
def test_cascade_is_exact(spark, bits):
    """Two bits a key let a large share pass by error on every level."""
    listed = spark.range(0, 300).selectExpr("concat('k', id) AS key")
    universe = spark.range(0, 6000).selectExpr("concat('k', id) AS key")
    levels = uf.build_cascade(listed, universe, bits)
    assert len(levels) > 1
    from pyspark.sql import functions as F

    kept = universe.where(uf.is_listed(F.col("key"), levels)).collect()
    assert {r["key"] for r in kept} == {f"k{i}" for i in range(300)}


def test_random_urls_and_rules(spark):
    rnd = random.Random(1)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "x.y.") for b in ("one", "two", "wone") for c in ("net", "co.uk", "org")]
    urls = [f"http://{rnd.choice(hosts)}{rnd.choice(['', '/', '/a', '/a/b', '/ab?x=/a', '#/a', '/A/'])}" for _ in range(300)]
    rules = [uf.Rule(rnd.choice(["block", "allow"]), h, p) for h in ("net", "one.net", "co.uk", "wone.org", "y.two.net") for p in ("/", "/a", "/a/", "")]
    rules += [uf.Rule("allow", "one.net", "/a"), uf.Rule("block", "one.net", "/a")]
    frame = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.filter_urls(frame, rules).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_edge_cases(spark):
    rules = [uf.Rule("block", "net", "/")]
    long = "http://" + "a." * 20_000 + "net/" + "p" * 50_000
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.NET/x", "http://a.net", "http://a.net?/x", "x://net/", "http://ä.NET/é", long, "http://a.net/", "http://a.net/"]
    frame = spark.createDataFrame([(i, u, 5) for i, u in enumerate(urls)], "page_id long, url string, rule int")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.filter_urls(frame, rules).orderBy("page_id").collect()]
    assert got == [brute(u, rules) for u in urls]
    assert uf.filter_urls(frame.limit(0), rules).count() == 0
    assert {r["verdict"] for r in uf.filter_urls(frame, [], default="block").collect()} == {"block"}


def test_more_keys_than_a_filter_may_hold(spark):
    """Parts of a list that is too large for one filter, and passes over the table, give what one filter gives."""
    rnd = random.Random(2)
    rules = [uf.Rule(rnd.choice(["block", "allow"]), f"h{i}.net", rnd.choice(["/", "/a"])) for i in range(60)] + [uf.Rule("block", "net", "/b")]
    urls = [f"http://{rnd.choice(['', 'w.'])}h{rnd.randint(0, 90)}.net{rnd.choice(['/', '/a/b', '/b', ''])}" for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.filter_urls(frame, rules, max_bits=512).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}
    listed = uf._key_frame(spark, [r.key for r in rules])
    with pytest.raises(uf.TooManyKeys):
        uf.build_cascade(listed, listed, max_bits=512)
    assert len(uf.build_cascades(listed, listed, max_bits=512)) > 1
