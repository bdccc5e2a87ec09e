from turnloom.llm import urlrules as U

SCHEMA = "page_id bigint, url string, html string"


def test_hosts_paths_and_fixed_rules(spark):
    cases = [
        (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://A.COM/X?q#f", "a.com", "/X", "com/", "allow"), ("http://a.com", "a.com", "", None, "allow"),
        ("https://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"), ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("https://x.www.example.com/en/2", "x.www.example.com", "/en/2", "www.example.com/en/", "allow"), ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("ftp://b.net/es/x", "b.net", "/es/x", "net/es/", "block"), ("//b.net/es/", "", "", None, "allow"), ("x://net/fr/?a=http://c.com/", "net", "/fr/", "net/fr/", "block"), ("http://É.org?x", "É.org", "", None, "allow"), ("http://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(cases)] + [(None, "http://a.com/", None)], SCHEMA)
    none = spark.createDataFrame([], "page_id bigint, blocked int")
    got = {r["page_id"]: r for r in U.judge_urls(pages, none).collect()}
    for i, c in enumerate(cases):
        assert tuple(got[i])[1:5] == c[1:], c
    assert got[None]["rule"] == "com/" and U.judge_urls(pages.limit(0), none).collect() == []


def test_mined_rules_block_what_labels_show(spark):
    # pages of one host with one query key are bad; the host alone and the key alone are not
    rows, bad = [], []
    for i in range(1200):
        host, key = ("evil.org" if i % 3 == 0 else "good.org"), ("ref" if i % 2 == 0 else "page")
        rows.append((i, f"http://{host}/a/{i}?{key}=1", None))
        if i < 900:
            bad.append((i, int(host == "evil.org" and key == "ref")))
    pages, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bad, "page_id bigint, blocked int")
    rules = U.mine(pages, marks)
    assert ("host=evil.org", "key=ref") in rules and all({"key=ref", "host=evil.org"} <= set(r) for r in rules)
    got = {r["page_id"]: r["verdict"] for r in U.judge_urls(pages, marks).collect()}
    assert all((got[i] == "block") == (i % 6 == 0) for i in range(1200))


def test_chance_makes_no_rule(spark):
    rows = [(i, f"http://h{i % 40}.org/p{i % 7}", None) for i in range(800)]
    marks = [(i, int(i * 2654435761 % 97 < 25)) for i in range(800)]
    assert U.mine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "page_id bigint, blocked int")) == []


def test_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert {tuple(r) for r in U.blocked_ids(labels).collect()} == {(1, 1), (2, 1), (3, 0), (4, 0)}


def test_index_needs_all_tokens():
    index = U.Index([("a", "b"), ("c",)])
    assert index.fires(["a", "b", "x"]) and index.fires(["c"]) and not index.fires(["a", "x"]) and not index.fires([])
