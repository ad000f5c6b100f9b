"""Mined URL rules against a brute-force search over all token combinations."""

import time
from itertools import combinations, product

from homeload.llm import url_filter


def plain_blocked(labelled, urls, least=5, confidence=0.5):
    counts = {}
    for url, bad in labelled:
        for k in range(1, 9):
            for c in combinations(sorted(split(url)), k):
                n, m = counts.get(c, (0, 0))
                counts[c] = (n + 1, m + bad)
    rules = [set(c) for c, (n, m) in counts.items() if m >= least and m >= confidence * n]
    return {u for u in urls if any(r <= split(u) for r in rules)}


def split(url):
    return {t for t in url.lower().replace(":", "/").replace(".", "/").split("/") if t}


def test_common_tokens_cost_nothing(spark):
    """Thirty tokens in every URL: no rule needs them, and their combinations are not mined."""
    shared = "/".join(f"c{i}" for i in range(30))
    labelled = [(f"http://{'bad' if i % 3 == 0 else 'good'}{i % 2}.net/{shared}/p{i}", i % 3 == 0) for i in range(300)]
    made = spark.createDataFrame(labelled, "url string, bad boolean")
    start = time.time()
    rules = {tuple(r.tokens) for r in url_filter.mine_rules(made).collect()}
    assert rules == {("bad0",), ("bad1",)} and time.time() - start < 30
    # tokens that all pages hold count where half of all pages are bad
    half = spark.createDataFrame([(f"http://x.net/{i}", i % 2 == 0) for i in range(40)], "url string, bad boolean")
    assert {tuple(r.tokens) for r in url_filter.mine_rules(half).collect()} == {("http",), ("x",), ("net",)}


def test_rules_of_three_tokens(spark):
    labelled = []
    for host, section, tag in product("ab", "cd", "ef"):
        # bad where an even number of the second choices meet: no token or pair is bad in half its pages
        own = (host, section, tag) in (("a", "c", "e"), ("b", "d", "e"))
        labelled += [(f"http://{host}.net/{section}/{tag}", own and i < 6) for i in range(10)]
    urls = sorted({u for u, _ in labelled}) + ["http://a.net/x/e", "http://c.a.org/e"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(pages, spark.createDataFrame(labelled, "url string, bad boolean"), []).collect()
    want = plain_blocked(labelled, urls)
    assert {urls[r.page_id] for r in got if r.verdict == "block"} == want
    assert want == {"http://a.net/c/e", "http://b.net/d/e", "http://c.a.org/e"}
    assert {len(r.tokens) for r in url_filter.mine_rules(spark.createDataFrame(labelled, "url string, bad boolean")).collect()} >= {3}
