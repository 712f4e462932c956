from peakloom.llm import urlrules

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def _judge(spark, urls, **options):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id bigint, url string, tokens string")
    out = urlrules.judge(pages, rules, **options)
    assert out.columns == ["page_id", "url", "tokens", "host", "path", "rule", "verdict"]
    rows = {r.page_id: r for r in out.collect()}
    assert len(rows) == len(urls)
    return [rows[i] for i in range(len(urls))]


def test_list_rules_and_parts(spark):
    urls = [
        "https://WWW.Example.com/en/1?q=/x#y",
        "http://a.example.com/en/",
        "http://a.example.com/de/",
        "http://example.net/es/7",
        "http://example.net",
        "http://notexample.com/en/",
        "http://com/",
        "no scheme",
        None,
        "",
        "x://y://z/en/",
        "http://Ä.net/es/#",
        "http://a.example.com/en/",
    ]
    rows = _judge(spark, urls, min_support=1.0)
    assert [r.rule for r in rows] == [
        "www.example.com/en/", "example.com/en/", "com/", "net/es/", None, "com/", "com/", None, None, None, None, "net/es/", "example.com/en/",
    ]
    assert (rows[0].host, rows[0].path) == ("www.example.com", "/en/1")
    assert (rows[10].host, rows[10].path) == ("y:", "//z/en/")
    assert [(rows[i].host, rows[i].path) for i in (4, 7, 8, 9)] == [("example.net", "")] + [("", "")] * 3
    assert [r.verdict for r in rows][:5] == ["allow", "block", "allow", "block", "allow"]


def test_mined_rules_judge_the_rest(spark):
    urls = [f"http://h{i}.example.net/es/{i}" for i in range(30)] + [f"http://h{i}.other.com/fr/{i}" for i in range(30)]
    urls += ["http://q.example.org/es/5", "http://q.test.org/fr/5", "http://q.test.org/it/5"] + ["http://h1.example.net/es/1"] * 40
    rows = _judge(spark, urls)
    assert [(r.rule, r.verdict) for r in rows[60:63]] == [(None, "block"), (None, "allow"), (None, "allow")]


def test_empty_table(spark):
    assert _judge(spark, []) == []
    assert [r.verdict for r in _judge(spark, [None, "http://x.org/"])] == ["allow", "allow"]
