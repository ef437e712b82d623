"""URL filters: rules and models against plain Python, verdicts on made-up sites."""

import math
import random
from collections import Counter

import pytest

from rillflow.llm import urls as U

SCHEMA = "page_id bigint, url string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path, rules=U.RULES):
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q=1", "http://example.net", "http://example.net/EN/", "http://net/",
        "http://xnet/", "https://a.b.org/fr/", "http://org/fr", "http://Ä.Org/fr/ü#x", "http://example.com/de/a://b", "x://y://z.net/",
        "http://a.net?x/", "http://a.net#/", "http://example.com/de", "http://u\nv.net/\n?x", "http://example.org:80/fr/", "://n.net/a"]


def test_rules_equal_plain_python(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "'x' AS verdict", "2 AS difference")
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(pages, U.RULES).collect()), key=repr)
    assert len(got) == len(rows)
    for page, url, host, path, rule, verdict in got:
        assert (host, path) == split(url), url
        want = rule_of(host, path)
        assert rule == want[0] and verdict in ("allow", "block") and (rule is None or verdict == want[1]), url


def test_the_models_part_two_kinds_of_sites(spark):
    r = random.Random(2)
    word = lambda letters: "".join(r.choice(letters) for _ in range(7))
    rows = []
    for i in range(600):
        good = i % 3 > 0  # ruled by the host; the words differ as well
        rows.append((i, f"http://{'good' if good else 'bad'}.site/{word('abcde') if good else word('vwxyz')}/{i}"))
    rows += [(1000 + i, f"http://other.site/{word('abcde')}/{i}") for i in range(50)]
    rows += [(2000 + i, f"http://other.site/{word('vwxyz')}/{i}") for i in range(50)]
    rules = [("allow", "good.site", "/"), ("block", "bad.site", "/")]
    got = {x.page_id: x.verdict for x in U.filter_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()}
    assert sum(got[1000 + i] == "allow" for i in range(50)) > 47
    assert sum(got[2000 + i] == "block" for i in range(50)) > 47


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = U.op8_url_filters(spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path) == split(urls[r.page_id])
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and (rule is None or r.verdict == verdict)
    free = [r for r in got if r.rule is None]
    assert {r.verdict for r in free} == {"allow", "block"}


def test_no_rules_fit_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (2, None)], SCHEMA)
    assert [r.verdict for r in U.filter_urls(pages, U.RULES).collect()] == ["allow", "allow"]
    assert U.filter_urls(pages.filter("false"), U.RULES).count() == 0
    only = spark.createDataFrame([(1, "http://a.net/c"), (2, "http://x.y/z")], SCHEMA)
    assert [r.verdict for r in U.filter_urls(only, U.RULES).orderBy("page_id").collect()] == ["block", "allow"]


def test_counts_and_scores_stay_exact_beyond_the_slots(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyzé漢0123456789") for _ in range(9))
    rows = [(i, f"http://{('good', 'bad', 'other')[i % 3]}.site/{word()}/{word()}") for i in range(6000)]
    rows += [(7, ""), (8, None), (9, "x"), *[(None, rows[2][1])] * 3, *[(1, rows[1][1])] * 2]
    rules = [("allow", "good.site", "/"), ("block", "bad.site", "/")]
    grams = {"allow": Counter(), "block": Counter()}
    for _, u in rows:
        verdict = rule_of(*split(u), rules)[1]
        if verdict:
            m = "\0" + u + "\0"
            grams[verdict].update(m[i - k:i + 1] for i in range(len(m)) for k in range(min(i, U.ORDER) + 1))
    assert all(sum(len(g) == U.ORDER + 1 for g in c) > 1 << U.BITS for c in grams.values())

    def likelihood(u, c):
        m, out, total = "\0" + u + "\0", 0.0, sum(n for g, n in c.items() if len(g) == 1)
        for i in range(1, len(m)):
            p = (c[m[i]] + 0.5) / (total + 0.5 * (1 << U.BITS))
            for k in range(1, min(i, U.ORDER) + 1):
                p = (c[m[i - k:i + 1]] + U.SMOOTH * p) / (c[m[i - k:i]] + U.SMOOTH)
            out += math.log(p)
        return out

    got = U.filter_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()
    assert Counter((x.page_id, x.url) for x in got) == Counter(rows)
    for x in r.sample(got, 300) + [x for x in got if x.page_id in (None, 7, 8, 9)]:
        want = (likelihood(x.url, grams["allow"]) - likelihood(x.url, grams["block"])) / (len(x.url) + 1) if x.url else 0.0
        assert x.difference == pytest.approx(want, abs=1e-9), x.url
