import random

import pytest

from adloom.llm import urls
from adloom.llm.urls import judge_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, rules, default):
    out = []
    for page, url in rows:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
            host, tail = rest[:end].translate(LOWER), rest[end:]
            path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
        best = None
        for rule, verdict in rules:
            if rule is None or verdict is None:
                continue
            at = rule.index("/") if "/" in rule else len(rule)
            own, start = rule[:at].translate(LOWER), rule[at:]
            if own and (host == own or host.endswith("." + own)) and path.startswith(start):
                best = max(best or (), (len(rule), len(own), rule, verdict))
        out.append((page, host, path, *(best[2:] if best else (None, default))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_per_range", [100_000, 9])
def test_equals_every_rule(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(urls, "RANGE_ROWS", rows_per_range)
    rng = random.Random(rows_per_range)
    labels = ["a", "b", "net", "com", "é", "x-y", "A"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/a/b", "/EN/"]
    rules = [(f"{rng.choice(hosts)}{rng.choice(paths)}", rng.choice(["allow", "block"])) for _ in range(60)]
    rules = [(r, "block") for r in {r for r, _ in rules if r.lower() == r}] + [(None, "allow"), ("a.b/", None), ("/x", "block")]
    tails = ["", "?q=/en/", "#/en/", "x?y#z", "\n"]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}") for i in range(150)]
    rows += [(1000 + i, "https://b.net/en/x") for i in range(60)]
    rows += [(1, None), (2, ""), (3, "no scheme"), (None, "a://net/"), (None, "a://net/"), (4, "://"), (5, "x://y://z/")]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, key int")
    table = spark.createDataFrame(rules, "rule string, verdict string")
    got = sorted(map(tuple, judge_urls(df, table, default="block").collect()), key=repr)
    assert got == brute(rows, rules, "block")


def test_conflict_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    both = spark.createDataFrame([("a.b/", "block"), ("a.b/", "allow")], "rule string, verdict string")
    assert list(map(tuple, judge_urls(df, both).collect())) == [(1, "a.b", "/", "a.b/", "block")]
    assert list(map(tuple, judge_urls(df, both.limit(0)).collect())) == [(1, "a.b", "/", None, "allow")]
    assert judge_urls(df.limit(0), both).collect() == []
