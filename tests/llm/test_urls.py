from macroloom.llm.urls import judge_urls

RULES = [("org", "/", "allow"), ("b.org", "/x/", "block"), ("com", "/a", "allow"), ("a.com", "", "block"), ("x.net", "/p", "allow"), ("x.net", "/p", "block"), (None, "/", "block")]


def fits(host, path, rule):
    return bool(rule[0]) and (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def test_agrees_with_every_rule_tried(spark):
    hosts = ["org", "b.org", "ab.org", "c.b.org", "com", "a.com", "z.a.com", "x.net", "net", ".org", "b.org:80", "a" + ".q" * 3000 + ".org", ""]
    paths = ["", "/", "/x", "/x/", "/x/y", "/a", "/ab", "/p/q", "/" + "x" * 20000]
    urls = [f"http://{h.upper()}{p}{t}" for h in hosts for p in paths for t in ("", "?q=1", "#f")]
    urls += [None, "", "no scheme", "://", "http://org/x://b.org/x/", urls[5], urls[5]]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(None, urls[9], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        fitting = [(len(x[0] + x[1]), len(x[0]), x[2], x[0] + x[1]) for x in RULES if fits(r.host, r.path, x)]
        best = max(fitting, default=(0, 0, "allow", None))
        assert (r.rule, r.verdict) == (best[3], best[2]), r
    by_id = {r.page_id: r for r in got}
    assert (by_id[len(urls) - 3].host, by_id[len(urls) - 3].path) == ("org", "/x://b.org/x/")
    assert by_id[len(urls) - 7].host == by_id[len(urls) - 5].host == ""


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, none).collect()] == [(1, "a.org", "/", None, "allow")]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge_urls(pages.where("false"), rules).count() == 0
