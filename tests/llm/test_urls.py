import random

import duckdb

from shelfscope.llm import urls as u

PAGES = "page_id long, url string, html string, host int, rule int, _url string, token string, _at int"


def slow(url, rules=u.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for r in rules:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            key = (-len(r.host + r.path), r.action != "block", r.host + r.path)
            best = min(best or (key, r), (key, r), key=lambda x: x[0])
    return host, path, best and best[1].host + best[1].path, best[1].action if best else "allow"


URLS = [None, "", "x", "http:/a.org/", "http://", "://org/", "HTTP://A.ORG/x", "http://org/", "http://org", "http://xorg/", "http://a.b.example.org/es/1",
        "http://example.org/es", "http://example.org/en/1", "http://example.org/en/19?x", "http://EXAMPLE.ORG/en/2", "http://example.com/fr/a#b",
        "http://x.com/de/", "http://x.com/DE/", "http://x.com?q=/fr/", "http://y.com#/fr/", "http://com/fr/a\nb", "http://a:80@com/fr/", "http://é.com/fr/é",
        "http://org:80/", "a://b://c.org/d", "http://e.org/" + "a" * 50000]


def test_urls_by_definition(spark):
    rnd = random.Random(3)
    made = ["".join(rnd.choice(["http://", "example", ".", "org", "com", "/", "es", "en", "fr", "de", "1", "?", "#", "X"]) for _ in range(9)) for _ in range(400)]
    rows = list(enumerate(URLS + made)) + [(None, URLS[10]), (3, URLS[10]), (3, URLS[10])]
    df = spark.createDataFrame([(i, x, "h", 1, 2, "c", "t", 3) for i, x in rows], PAGES)
    got = sorted(((r.page_id is None, r.page_id or 0), r.host, r.path, r.rule or "", r.verdict) for r in u.query(df).collect())
    want = sorted(((i is None, i or 0), h, p, r or "", v) for i, x in rows for h, p, r, v in [slow(x)])
    assert got == want
    kept = u.judge(df)
    assert set(PAGES.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")) - {"host", "rule"} <= set(kept.columns)
    assert kept.columns.count("host") == kept.columns.count("rule") == 1
    assert u.query(spark.createDataFrame([], PAGES)).count() == 0


def test_rules_of_other_shapes(spark):
    rules = (u.Rule("block", "a.b-c.com", ""), u.Rule("allow", "com", "/x.y/"), u.Rule("block", "net", "/(a+b)/"), u.Rule("block", "日", "/"))
    urls = ["http://a.b-c.com", "http://z.a.b-c.com/q", "http://aXb-c.com/", "http://com/x.y/1", "http://com/xzy/1", "http://q.net/(a+b)/", "http://q.net/aab/",
            "http://日/x", "http://a.日/x", "http://a.b-c.com\n"]
    df = spark.createDataFrame([(i, x, "h", 1, 2, "c", "t", 3) for i, x in enumerate(urls)], PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in u.judge(df, rules).collect()}
    assert got == {i: slow(x, rules) for i, x in enumerate(urls)}


def test_tokens_are_whole_runs_of_every_fitting_url():
    assert u.rule_tokens(u.Rule("block", "example.org", "/en/1")) == ["en", "example", "org"]
    assert u.rule_tokens(u.Rule("allow", "org", "/")) == ["org"]


def test_sql_gives_the_same(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(map(str, con.sql(u.ORACLE).fetchall()))
    got = sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in u.query(spark.read.parquet(f"{sf}/pages.parquet")).collect())
    assert got == want
