"""Url verdicts against plain string rules, the cascade against a set."""

import random
import re

import numpy as np
import pytest

from airledger.llm import bloom, queries, url_cascade
from airledger.llm.url_cascade import ALLOW, BLOCK, RULES


def parsed(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]


def plain(url, rules=RULES, default=ALLOW):
    host, path = parsed(url)
    fitting = []
    for verdict, rule in rules:
        own, _, rest = rule.partition("/")
        own, rest = re.sub("[A-Z]", lambda m: m[0].lower(), own), rule[len(own):]
        if (host == own or host.endswith("." + own)) and path.startswith(rest):
            fitting.append((len(own + rest), len(own), verdict, own + rest))
    if not fitting:
        return host, path, None, default
    *_, verdict, rule = max(fitting)
    return host, path, rule, verdict


ODD = [
    None, "", "no scheme", "http://", "://", "HTTP://EXAMPLE.Net/en/x", "http://example.net", "http://example.net/",
    "http://example.net/en", "http://example.net/en/", "http://notexample.net/en/", "http://a.example.com/de/1?x=/fr/",
    "http://org/fr/", "http://x.org/fr/#top", "http://example.net?/en/", "http://example.net:80/en/", "net/", "a://b://c.net/",
    "http://ÉXAMPLE.net/EN/", "http://.net/", "http://net./", "http://x\n.net/y\n", "http://net/" + "a/" * 100_000,
    "http://" + "a." * 50_000 + "net/", "http://x.org/FR/", "http://x.org/fr/?q", "http:///en/", "http://a..net/b",
]


def frame_of(spark, urls):
    rows = [(None if i % 9 == 4 else i // 2, u, "h", "r", "v") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string, verdict string").repartition(3)


def rules_of(spark, rules):
    return spark.createDataFrame(rules, "verdict string, rule string")


def check(spark, urls, rules, **options):
    got = url_cascade.judged(frame_of(spark, urls), rules_of(spark, rules), **options).drop("page_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain(u, rules, options.get("default", ALLOW))) for u in urls)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = queries.op11_url_cascade(spark, "/root/testdata/sf0.01")
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = {r.page_id: plain(r.url) for r in pages.select("page_id", "url").collect()}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert {w[2] for w in want.values()} >= {r for _, r in RULES} | {None}


def test_awkward_urls(spark):
    check(spark, ODD, list(RULES))
    check(spark, ODD * 3, list(RULES), default=BLOCK)
    check(spark, [], list(RULES))
    check(spark, ODD, [])
    check(spark, ODD, [(ALLOW, "net/"), (BLOCK, "net/"), (BLOCK, "net/"), (ALLOW, "/"), (BLOCK, "example.net/e"), (ALLOW, "b/net")])


def test_rules_that_say_nothing_are_left_out(spark):
    rules = rules_of(spark, [(BLOCK, None), (None, "net/"), ("warn", "org/")])
    got = url_cascade.judged(frame_of(spark, ODD), rules).collect()
    assert len(got) == len(ODD) and {(r.rule, r.verdict) for r in got} == {(None, ALLOW)}


@pytest.mark.parametrize("options", [{}, {"few": 0}, {"few": 8, "keys_per_cascade": 150}])
def test_many_rules(spark, options):
    """Long lists, every level built by Spark, and lists in several parts."""
    draw = random.Random(3)
    names, ends = [f"n{i}" for i in range(40)], ["com", "net", "org"]
    urls = [
        f"http://{'.'.join(draw.choices(names, k=draw.randint(0, 3)) + [draw.choice(ends)])}/{'/'.join(draw.choices(names, k=draw.randint(0, 3)))}"
        for _ in range(1500)
    ]
    rules = [
        (draw.choice((BLOCK, ALLOW)), ".".join(draw.choices(names, k=draw.randint(0, 2)) + [draw.choice(ends)]) + "/" + draw.choice(["", *names]))
        for _ in range(600)
    ]
    keys = {}
    for verdict, rule in rules:
        keys[rule] = max(verdict, keys.get(rule, ""))
    got = url_cascade.judged(frame_of(spark, urls), rules_of(spark, rules), **options).drop("page_id").collect()
    want = sorted(str(plain(u, [(v, r) for r, v in keys.items()])) for u in urls)
    assert sorted(map(str, map(tuple, got))) == want


def test_a_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(40_000).selectExpr("cast(id as string) key", "xxhash64(0, id) a", "xxhash64(1, id) b", "id % 7 = 0 own")
    made = url_cascade.build(keys.where("own"), keys, 40_000, few=2000)
    rows = keys.select("a", "b", "own").toArrow()
    got = made.holds(rows["a"].to_numpy(), rows["b"].to_numpy())
    assert (got == rows["own"].to_numpy()).all() and 2 < len(made.levels) < 30


def test_filters_hold_their_keys_whatever_their_size(spark):
    keys = spark.range(5000).selectExpr("xxhash64(0, id) a", "xxhash64(1, id) b")
    rows = keys.toArrow()
    a, b = rows["a"].to_numpy(), rows["b"].to_numpy()
    for bits, most in ((12, 1 << 20), (12, 1 << 10)):
        made, local = bloom.of(keys, 5000, bits, most_bits=most), bloom.Bloom(5000, bits, 0, most)
        local.set(a, b)
        assert (made.words == local.words).all() and made.holds(a, b).all()
    sparse = bloom.of(keys, 5000, 12, salt=3)
    other = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, (2, 20_000))
    assert 0 < sparse.holds(*other).mean() < 0.01
