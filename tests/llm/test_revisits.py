from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimflow.llm import revisits
from claimflow.llm.queries import oracle_sql, queries
from tests.compare import connect, differences

SCHEMA = (
    "record_id long, url string, captured timestamp, kind string, status int, headers map<string,string>, digest string, "
    "length long, key string, found int"
)
START = datetime(2024, 1, 1)


def records(spark, *rows):
    return spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA)


def resolved(spark, *rows, **k):
    out = revisits.resolve_revisits(records(spark, *rows), **k).collect()
    return {r.record_id: r for r in out}


def full(i, url, second, tag=None, date=None, **more):
    headers = {"Content-Type": "text/html", **({"ETag": tag} if tag else {}), **({"Last-Modified": date} if date else {}), **more}
    return (i, url, START + timedelta(seconds=second), "response", 200, headers, f"d{i}", i * 10)


def again(i, url, second, headers):
    return (i, url, START + timedelta(seconds=second), "revisit", 304, headers, None, 0)


@pytest.mark.parametrize("url, want", [
    ("HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#top", "example.com/a?a=1&b=2"), ("https://example.com", "example.com/"),
    ("https://u:p@example.com:8443//x//", "example.com:8443//x"), (" http://e.org/q?ref=1 ", "e.org/q"), ("ftp://e.org/", None), ("", None),
    ("http:///x", None), (None, None), ("http://e.org/a b?x", "e.org/a b?x"),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisits.canonical_url(F.col("u"))).first()[0] == want


def test_validators_and_merge(spark):
    u = "http://e.org/"
    got = resolved(
        spark, full(1, u, 0, '"a"', "mon", Server="s1"), again(2, "https://www.e.org/#x", 5, {"etag": 'W/"a"', "Server": "s2", "Content-Length": "0"}),
        again(3, u, 6, {"ETag": '"b"', "Last-Modified": "mon"}), again(4, u, 7, {"Last-Modified": "mon", "X": None}), again(5, u, 8, {}),
        again(6, u, 0, {"ETag": '"a"'}), again(7, None, 9, {}), again(8, u, 9, None),
    )
    assert {i: r.outcome for i, r in got.items()} == {
        2: "resolved", 3: "changed", 4: "resolved", 5: "changed", 6: "unseen", 7: "invalid", 8: "changed"
    }
    assert got[2].response_id == 1 and got[2].digest == "d1" and got[2].length == 10
    assert [tuple(h) for h in got[2].headers] == [
        ("content-type", "text/html"), ("etag", 'W/"a"'), ("last-modified", "mon"), ("server", "s2")
    ]
    assert dict(tuple(h) for h in got[4].headers)["x"] == "" and got[3].headers is None and got[3].response_id == 1


def test_only_full_responses_and_latest(spark):
    u = "http://e.org/p"
    partial = (9, u, START + timedelta(seconds=50), "response", 206, {}, "dx", 1)
    got = resolved(
        spark, full(1, u, 0, '"a"'), full(2, u, 40, '"b"'), full(3, u, 40, '"c"'), partial, again(4, u, 60, {"ETag": '"c"'}),
        again(5, u, 10 * 86_400, {"ETag": '"c"'}), again(6, u, 20, {"ETag": '"a"'}), (10, u, None, "revisit", 304, {}, None, 0),
    )
    assert [got[i].response_id for i in (4, 5, 6)] == [3, 3, 1] and got[10].outcome == "invalid"
    assert all(got[i].outcome == "resolved" for i in (4, 5, 6))


def test_against_brute_force(spark):
    rng, rows = random.Random(8), []
    for i in range(600):
        u, t = f"http://e.org/{min(rng.randrange(12), 4)}", rng.randrange(4000)
        rows.append(full(i, u, t, f'"{rng.randrange(3)}"') if rng.random() < 0.3 else again(i, u, t, {"ETag": f'"{rng.randrange(3)}"'}))
    got = resolved(spark, *rows, bucket_seconds=100)
    n = 0
    for r in rows:
        if r[3] == "revisit":
            before = [(x[2], x[0], x) for x in rows if x[3] == "response" and x[1] == r[1] and x[2] < r[2]]
            want = max(before)[2] if before else None
            outcome = "unseen" if not want else "resolved" if want[5]["ETag"] == r[5]["ETag"] else "changed"
            assert (got[r[0]].outcome, got[r[0]].response_id) == (outcome, want and want[0])
            n += 1
    assert n == len(got)


def test_empty_and_repeated(spark):
    assert revisits.resolve_revisits(records(spark)).count() == 0
    u = "http://e.org/"
    df = records(spark, full(1, u, 0, '"a"'), full(1, u, 0, '"a"'), *[again(2, u, 5, {"ETag": '"a"'})] * 3)
    rows = revisits.resolve_revisits(df).collect()
    assert [(r.record_id, r.response_id) for r in rows] == [(2, 1)] * 3


def test_query_against_sql(spark):
    sf, name = "/root/testdata/sf0.01", "op2_revisit_resolution"
    assert differences(queries()[name](spark, sf), connect(sf), oracle_sql()[name]) is None
