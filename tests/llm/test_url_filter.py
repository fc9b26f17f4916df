import pytest

from orderdw.llm import url_filter as U


def brute_rule(host, path):
    fits = [(len(r), r, v) for v, r in U.RULES
            if (host == r[:r.index("/")] or host.endswith("." + r[:r.index("/")]))
            and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    m = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:m]


URLS = ["http://A.Example.NET/en/1?x", "https://x.net/a", "http://net/", "http://net", "http://x.org/fr/",
        "http://org/fr", "http://example.com/de/x#y", "http://badexample.com/de/x", None, "", "no url",
        "http://", "ftp://h?q/z", "http://a.b/c://d", "HTTP://É.example.com/de/é", "http://x.example.net/En/",
        "http://www.casinowin.example.org/en/3", "http://thehousebook.example.org/en/5"]


def test_rules_and_parts(spark):
    rows = [(i, u, f"<p>the house book the house the book win casino</p>") for i, u in enumerate(URLS)]
    rows += [rows[0], (None, URLS[1], None)]
    pages = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                  "page_id long, url string, html string, host int, count int, word int")
    got = U.judge(pages).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, url in enumerate(URLS):
        host, path = brute_parts(url)
        rule, verdict = brute_rule(host, path)
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")
    assert by_id[16].verdict == "block"
    assert U.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name, want", [("thehousebook", ["the", "house", "book"]),
                                        ("qq", ["qq"]), ("thethe", ["the", "the"])])
def test_segments(spark, name, want):
    pages = spark.createDataFrame([("<b>the</b> house<i>book</i> THE <x the the> " * 50,)], "html string")
    names = spark.createDataFrame([(name,)], "name string")
    assert [tuple(r) for r in U.segmented(names, pages).collect()] == [(name, want)]


def test_words_decide(spark):
    rows = [(i, f"http://good{i % 3}.x.org/fr/tea/{i}", None) for i in range(30)]
    rows += [(100 + i, f"http://s{i}.x.net/spin/{i}", None) for i in range(30)]
    rows += [(200, "http://q.x.com/spin/9", None), (201, "http://q.x.com/tea/9", None)]
    got = {r.page_id: r.verdict for r in
           U.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[200] == "block" and got[201] == "allow"


def test_registered_names_are_words(spark):
    text = "<p>cheap casino bonus garden tea house</p>" * 50
    rows = [(i, f"http://s{i}.x.net/spin/{i}", text) for i in range(30)]
    rows += [(100 + i, f"http://s{i}.x.org/fr/tea/{i}", text) for i in range(30)]
    rows += [(200 + i, f"http://gardenhouse{'' if i % 2 else i}.org/fr/{i}", text) for i in range(30)]
    rows += [(300, "http://cheapcasinobonus.com", text), (301, "http://gardenhouse.com/", text),
             (302, "http://cheapcasinobonus.co.uk/", text), (303, "http://casino/", text)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for suffixes in ((), ("co.uk", "uk")):
        got = {r.page_id: r.verdict for r in U.judge(pages, suffixes=suffixes).collect()}
        assert [got[300 + i] for i in range(4)] == ["block", "allow", "block", "allow"]


def test_labels_that_the_rule_names_are_no_words(spark):
    rows = [(i, f"http://s{i}.tea.org/fr/{i}", None) for i in range(20)]
    rows += [(100 + i, f"http://s{i}.tea.org/de/{i}", None) for i in range(10)]
    rows += [(200, "http://tea.com/", None)]
    rules = [("block", "tea.org/fr/"), ("allow", "org/de/")]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(
        rows, "page_id long, url string, html string"), rules).collect()}
    assert got[200] == "allow"


def test_evidence_outweighs_listed_words(spark):
    text = "<p>family farm casino win free</p>" * 50
    rows = [(i, f"http://family-farm{i}.x.org/fr/{i}", text) for i in range(60)]
    rows += [(100 + i, f"http://s{i}.x.net/spin/{i}", text) for i in range(60)]
    rows += [(200, "http://family-farm.x.com/", text), (201, "http://familyfarm.x.com/", text),
             (202, "http://farm.x.com/", text), (203, "http://casino-win.x.com/", text)]
    got = {r.page_id: r.verdict for r in
           U.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in (200, 201, 202, 203)] == ["allow", "allow", "allow", "block"]


def test_classes_count(spark):
    rows = [(i, f"http://a{i}.x.org/fr/tea", None) for i in range(10)]
    rows += [(100 + i, f"http://a{i}.x.net/tea", None) for i in range(40)]
    rows += [(200, "http://q.x.com/unseen", None)]
    frame = "page_id long, url string, html string"
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, frame)).collect()}
    # Twice as many words a url under fr/: an unseen word speaks for block, as the classes do.
    assert got[200] == "block"
    urls = spark.createDataFrame([("block", 40), ("allow", 10), (None, 7)],
                                 "rule_verdict string, count long")
    assert U.class_ratio(urls) == pytest.approx(U.math.log(41 / 11))
    assert U.class_ratio(urls.limit(0)) == 0
