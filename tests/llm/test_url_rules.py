from __future__ import annotations

import re

import pytest

from ledgerlens.llm import url_rules as ur

URLS = [
    (1, "http://a.example.net/en/1?x#y"),
    (2, "https://EXAMPLE.com/de/"),
    (3, "https://example.com/De/"),
    (4, "http://x.org/fr/"),
    (5, "http://x.org/fr"),
    (6, "ftp://net/"),
    (7, "http://net"),
    (8, "http://example.net?u=http://example.net/en/"),
    (9, "no scheme/en/"),
    (10, None),
    (11, ""),
    (12, "https://www.spam-farm.example.org/en/1"),
    (13, "https://notexample.net/en/1"),
    (14, "https://cheap-pills.example.net/en/1"),
    (15, "https://roads.example.com/"),
    (16, "://"),
    (16, "://"),
    (17, "http://a.com/x/LOGIN"),
    (18, "http://a.com/login-help/"),
    (19, "http://a.com/x?page=1&SessionId=7#sid=1"),
    (20, "http://a.com/x#?sid=1"),
    (21, "http://a.com/x?y=1;replytocom=2"),
    (22, "http://order-viagra-pharmacy.com"),
    (23, "http://viagra/"),
    (24, "http://a.com/wp-admin?a=1"),
    (25, "http://a.com?aff_id=9"),
    (26, "http://example.net/en/checkout/"),
    (27, "http://my.torrents.co/fr/"),
    (None, "http://ads.example.com/x"),
]


def plain(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(str.maketrans(ur.UPPER, ur.LOWER))
    fits = [
        r
        for r in ur.SITE_RULES
        if f".{host}".endswith("." + r.rule.split("/", 1)[0]) and path.startswith("/" + r.rule.split("/", 1)[1])
    ]
    best = max(fits, key=lambda r: len(r.rule), default=None)
    lower = str.maketrans(ur.UPPER, ur.LOWER)
    query = re.match(r"(?:\?[^#]*)?", rest[len(host) + len(path) :])[0].translate(lower)
    read = {"host": host + path, "path": path.translate(lower) + "/", "query": query}
    blocked = any(re.search(r.pattern, read[r.part]) for r in ur.PATTERN_RULES)
    return host, path, best.rule if best else None, best.verdict if best else "block" if blocked else "allow"


def test_matches_plain_rules(spark):
    pages = spark.createDataFrame([(i, u, "taken", "taken") for i, u in URLS], "page_id long, url string, host string, rule string")
    rows = ur.judge(pages).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, [(i, u, *plain(u)) for i, u in URLS])) == sorted(str(tuple(r)) for r in rows)
    assert ur.judge(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in ur.judge(pages, site_rules=(), pattern_rules=()).collect()} == {"allow"}


def test_same_rows_without_broadcast(spark, monkeypatch):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    want = sorted(map(str, ur.judge(pages).collect()))
    monkeypatch.setattr(ur, "BROADCAST_RULES", 0)
    assert sorted(map(str, ur.judge(pages).collect())) == want


def test_only_fetched_rules_run(spark):
    """A rule is filed under its rarest literal, and must name one."""
    urls = ur.with_host_and_path(spark.createDataFrame([(f"http://a.com/{i}/",) for i in range(5)] + [("http://a.com/rare/",)], "url string"))
    index = ur.rule_index(urls, (), (ur.PatternRule("r", "a.com/rare", ("com", "rare")),)).collect()
    assert [r["literal"] for r in index] == ["rare"]
    with pytest.raises(ValueError):
        ur.rule_index(urls, (), (ur.PatternRule("bare", ".*", ()),))


def test_plan_has_no_python(spark, small):
    df = ur.judge(spark.read.parquet(f"{small}/pages.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "ExistingRDD", "Cartesian", "SortMergeJoin LeftOuter"))


def test_several_hundred_rules_and_what_they_read(spark):
    assert len(ur.PATTERN_RULES) > 250 and len({r.rule for r in ur.PATTERN_RULES}) == len(ur.PATTERN_RULES)
    verdicts = {i: plain(u)[3] for i, u in URLS if i}
    assert [verdicts[i] for i in range(17, 28)] == [
        "block", "allow", "block", "allow", "block", "block", "allow", "block", "block", "allow", "block",
    ]


def test_matches_the_statement(spark, small):
    import duckdb

    from ledgerlens.llm import queries

    pages = spark.createDataFrame([(k, u) for k, (_, u) in enumerate(URLS)], "page_id long, url string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.execute(queries.ORACLES["op6_url_rules"]).fetchall()
    got = ur.judge(pages, keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
