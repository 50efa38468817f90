import re

from eventlake.llm import url_filter
from eventlake.llm.queries import URL_RULES, op1_url_filter
from tests.conftest import SF01


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]


def rule_of(url, rules):
    host, path = parts(url)
    fit = [r for r in rules for h, _, p in [r.partition("/")]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return min(fit, key=lambda r: (-len(r), r)) if fit else None


def test_query_matches_brute_force(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = op1_url_filter(spark, SF01).collect()
    assert len(got) == len(pages)
    free = 0
    for r in got:
        rule = rule_of(pages[r.page_id], URL_RULES)
        assert (r.host, r.path, r.rule) == (*parts(pages[r.page_id]), rule)
        assert r.verdict == URL_RULES[rule] if rule else r.verdict in ("allow", "block")
        assert (r.score is None) == (rule is not None)
        free += rule is None
    assert free > 20
    again = op1_url_filter(spark, SF01).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_parts_and_rules(spark):
    urls = [None, "", "nothing", "http://", "HTTP://Example.ORG/es/x", "a://b.example.org/en/1x?q=/es/", "://x.com/de/",
            "x://org", "x://org/", "x://notexample.org/es/", "x://a.com?/fr/", "x://a.com#/fr/", "x://com/fr/?a",
            "x://É.ÉCOM/fr/", "x://h/p\nq?z", "a://b://c/d", "x://user@a.org:80/", "x://example.org/ES/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(df, URL_RULES).collect()}
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path) == parts(u), u
        assert got[i].rule == rule_of(u, URL_RULES), u


def labelled_urls(n, bad=lambda i: i % 2):
    return [(f"http://{'xx-cheap-pills9' if bad(i) else 'news'}{i % 7}.example.{'net' if i % 3 else 'com'}/"
             f"{'a/b/c/d/' * bad(i)}{i}{'?u=1&v=2' * bad(i)}", bad(i)) for i in range(n)]


def test_trees_learn_lexical_features(spark):
    train = spark.createDataFrame(labelled_urls(300), "url string, label int")
    test = labelled_urls(400)[300:]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(test)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df, {}, labelled=train).collect()}
    right = sum(got[i] == ("block" if y else "allow") for i, (_, y) in enumerate(test))
    assert right / len(test) >= 0.95


def test_edges(spark):
    df = spark.createDataFrame([(1, "x://a.net/"), (1, "x://a.net/"), (None, None)], "page_id long, url string")
    got = [tuple(r)[:5] for r in url_filter.judge(df, URL_RULES).collect()]
    assert sorted(got, key=str) == sorted([(1, "a.net", "/", None, "allow")] * 2 + [(None, "", "", None, "allow")], key=str)
    assert url_filter.judge(df.limit(0), URL_RULES).collect() == []


def test_suffix_statistics_leave_out_the_own_fold(spark):
    rows = [("a.net", 1, 0), ("b.net", 0, 0), ("c.net", 1, 1)]
    known = spark.createDataFrame([(h, y, f, "x://" + h) for h, y, f in rows], "host string, label int, fold int, url string")
    stats = url_filter.suffix_statistics(known, 1)
    out = {r.host: r for r in url_filter._with_suffix(known, stats, 1, 0.5).collect()}
    s = url_filter.SMOOTHING
    assert out["c.net"].suffix1_share == (1 + s * 0.5) / (2 + s)
    assert out["a.net"].suffix1_share == (1 + s * 0.5) / (1 + s)


def test_copies_of_one_url_are_one_training_row(spark, monkeypatch):
    tables, whole = {}, url_filter.stage

    def kept(df, name):
        tables[name] = whole(df, name)
        return tables[name]

    monkeypatch.setattr(url_filter, "stage", kept)
    rows = labelled_urls(200)
    copies = spark.createDataFrame([tuple(r)[:2] for r in rows] + [tuple(rows[0])[:2]] * 300, "url string, label int")
    urls = spark.createDataFrame([(1, rows[0][0])], "page_id long, url string")
    url_filter.judge(urls, {}, labelled=copies).collect()
    train = tables["url_training"].collect()
    assert len(train) == 200 and sum(r.n for r in train) == 500
