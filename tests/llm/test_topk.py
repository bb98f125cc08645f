from __future__ import annotations

import math

import numpy as np

from claimflow.llm import topk
from claimflow.llm.queries import queries


def brute(rows, k, every, scale):
    """(query, rank, vec, score) in whole Python numbers."""
    fine = []
    for i, v in dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, [math.floor(scale * float(x)) for x in v]))
    out = []
    for q, a in fine:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def check(spark, rows, k=10, every=100, kind="float"):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], f"vec_id long, embedding array<{kind}>, number int, norm2 int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk.top_k(df, k=k, every=every)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, k, every, 1024)


def test_random_vectors_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "TILE", 16)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(900, 12)) * rng.lognormal(size=(900, 1))
    check(spark, [(i, x.tolist()) for i, x in enumerate(v)], every=20)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(i, [0.0, 0.0]) for i in range(300, 330)]
    check(spark, rows, k=4, every=50)


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (1, [3.0, -1.0]), (1, [3.0, -1.0]), (2, [1.0]), (500, [2.0]), (600, []), (3, []), (700, [0.0, 0.0]), (800, [5.0, 5.0, 5.0]),
        (-100, [1.0, 1.0]),
    ]
    check(spark, rows)


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i / 3, -1e6, 2.5e5]) for i in range(120)]
    check(spark, rows, kind="double")


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    v = np.floor(np.array([e for _, e in rows], np.float64) * 1024).astype(np.int64)
    want = []
    for q in np.flatnonzero(ids % 100 == 0):
        scores = v @ v[q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:10]
        want += [(int(ids[q]), n, int(ids[j]), int(scores[j])) for n, j in enumerate(order, 1)]
    got = queries()["op6_norm_sorted_top_k"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(want)
