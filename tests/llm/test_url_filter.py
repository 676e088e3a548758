import math
from collections import Counter, defaultdict

from shoplake.llm import url_filter

URLS = [(1, "http://A.Example.ORG/es/x?y"), (2, "https://example.org/en/12#t"), (3, "ftp://www.example.com/fr/q"),
        (4, "x.com/de/1"), (5, None), (6, "http://b.com/de/1"), (7, "http://org/"), (8, "http://myorg/"), (9, "http://a.org"),
        (10, "http://example.org/en/2"), (11, "://"), (12, ""), (13, "http://b.com/de/1"), (None, "http://c.net/fr/é\n"),
        (14, "http://" + "a" * 3000 + ".net/" + "b" * 3000)]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'x' AS score", "'y' AS rule", "1 AS address")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(URLS)
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (got[2]["path"], got[2]["rule"], got[2]["verdict"]) == ("/en/12", "example.org/en/1", "block")
    assert (got[3]["rule"], got[3]["verdict"]) == ("com/fr/", "allow")
    assert (got[4]["host"], got[4]["path"], got[4]["rule"]) == ("", "", None)
    assert (got[5]["host"], got[5]["rule"]) == ("", None)
    assert (got[6]["rule"], got[13]["verdict"]) == ("com/de/", "block")
    assert (got[7]["rule"], got[8]["rule"], got[9]["rule"], got[10]["rule"]) == ("org/", None, None, "org/")
    assert got[11]["host"] == "" and got[12]["path"] == "" and got[None]["path"] == "/fr/é\n"
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_ratios_by_hand(spark):
    good, bad = ["abc", "abd", "xbc"], ["abb", "zz"]
    labelled = spark.createDataFrame([(a, True) for a in good] + [(a, False) for a in bad], "address string, accepted boolean")
    wanted = spark.createDataFrame([("abc",), ("zq",)], "address string")
    grams, contexts = url_filter.train(labelled)
    got = {r["window"]: r["ratio"] for r in url_filter.window_ratios(
        url_filter.windows(wanted).distinct(), grams, contexts, 9).collect()}

    def model(texts):
        counts = defaultdict(Counter)
        for t in texts:
            t = url_filter.START * 4 + t + url_filter.END
            for i in range(4, len(t)):
                for k in range(5):
                    counts[t[i - k:i]][t[i]] += 1
        return counts

    def probability(counts, window):
        p = 1 / 9
        for k in range(5):
            seen = counts.get(window[4 - k:4])
            if seen:
                p = (seen[window[4]] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    a, r = model(good), model(bad)
    assert got
    for window, ratio in got.items():
        assert abs(ratio / 1e9 - math.log(probability(a, window) / probability(r, window))) < 1e-8


def test_threshold_separates(spark):
    rows = [(True, 0.5)] * 5 + [(True, 0.1)] + [(False, -0.4)] * 5
    held = spark.createDataFrame(rows, "accepted boolean, score double")
    assert -0.4 < url_filter.calibrate(held) <= 0.1
    assert url_filter.calibrate(held.filter("accepted")) == 0.0
