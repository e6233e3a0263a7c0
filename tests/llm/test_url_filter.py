from velomart.llm import url_filter as u


def judged(spark, urls):
    df = spark.createDataFrame([(k, url, "h") for k, url in enumerate(urls)], "page_id long, url string, host string")
    out = u.judge(df)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    return {r.page_id: r for r in out.collect()}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://A.Org/x?y#z", "a.org", "/x", "org/"),
        ("https://example.org/es/1", "example.org", "/es/", "example.org/es/"),
        ("https://www.Example.ORG/en/17#t", "www.example.org", "/en/17", "example.org/en/1"),
        ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/"),
        ("x://org", "org", "", None),
        ("x://org?a=/b", "org", "", None),
        ("x://a.com/fr/", "a.com", "/fr/", "com/fr/"),
        ("x://acom/fr/", "acom", "/fr/", None),
        ("x://a.com/FR/", "a.com", "/FR/", None),
        ("x://a.com/de/b://org/", "a.com", "/de/b://org/", "com/de/"),
        ("no scheme", "", "", None),
        (None, "", "", None),
        ("", "", "", None),
        ("x://Ä.com/é?q", "Ä.com", "/é", None),
        ("a\nb://h/p\nq", "h", "/p\nq", None),
    ]
    got = judged(spark, [c[0] for c in cases])
    for k, (_, host, path, rule) in enumerate(cases):
        if rule == "example.org/es/":
            path = "/es/1"
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), cases[k]
        verdict = {"org/": "allow", "com/fr/": "allow", None: got[k].verdict}.get(rule, "block")
        assert got[k].verdict == verdict and verdict in ("allow", "block")


def test_the_models_tell_the_classes_apart(spark):
    urls = [f"http://site{k}.org/news/good-{k}" for k in range(150)]
    urls += [f"http://shop{k}.com/de/cheap-pills-{k}" for k in range(150)]
    new = ["http://site7.net/news/good-3", "http://shop8.net/de/cheap-pills-4"]
    got = judged(spark, urls + new + new)
    assert [got[len(urls) + k].verdict for k in range(4)] == ["allow", "block"] * 2
    assert got[len(urls)].score > 0 > got[len(urls) + 1].score


def test_empty_table_long_urls_and_no_rules(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert u.judge(df).collect() == []
    got = judged(spark, ["x://a.net/" + "b" * 50_000, None, None, "x://a.net/"])
    assert len(got) == 4 and got[1].score == got[2].score == 0.0
