from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimflow.llm import mixing
from claimflow.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.integers(1, 5000), st.integers(0, 2**63))
def test_permutation(n, key):
    assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))


def test_passes_differ():
    a, b = (mixing.permuted(np.arange(1000), 1000, k).tolist() for k in (1, 2))
    assert a != b and a != list(range(1000))


@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([1.0, 2.0, 3.0])), min_size=1, max_size=12))
def test_targets(sources):
    sizes, weights = zip(*sources)
    targets = mixing.capped_targets(list(sizes), list(weights), 3)
    assert sum(targets) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-6 for t, s in zip(targets, sizes))
    free = [t / w for t, w, s in zip(targets, weights, sizes) if t < 3 * s - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))
    for t, w, s in zip(targets, weights, sizes):
        if free and t >= 3 * s - 1e-6:
            assert t / w <= max(free) + 1e-6


@settings(deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(1, 20))
def test_draws_meet_the_totals(totals, shards):
    draws = mixing.shard_draws(totals, shards, 5)
    assert draws.sum(0).tolist() == totals and draws.min() >= 0
    per_shard = draws.sum(1)
    assert per_shard.max() - per_shard.min() <= 1


@given(st.integers(1, 5000), st.integers(0, 2**63))
def test_permutation_is_undone(n, key):
    index = np.arange(n)
    assert mixing.permuted(mixing.permuted(index, n, key), n, key, back=True).tolist() == index.tolist()


@settings(deadline=None, max_examples=300)
@given(st.integers(0, 3000), st.floats(0, 3), st.integers(1, 200), st.integers(0, 99))
def test_slots_hold_the_target(size, share, block_words, seed):
    source = mixing.Source(2, "s", size, 1, size * share)
    n, cut = mixing.slots_needed(source, block_words, seed, 3)
    blocks = -(-size // block_words)
    sizes, taken = [block_words] * (blocks - 1) + [size - (blocks - 1) * block_words], 0
    for j in range(n):
        block = mixing.permuted(np.array([j % blocks]), blocks, mixing.pass_key(seed, 2, j // blocks))[0]
        assert j < n - 1 or cut > 0
        taken += min(sizes[block], cut if j == n - 1 else block_words)
    assert taken == round(size * share)


def test_draws_beyond_the_sampler(monkeypatch):
    monkeypatch.setattr(mixing, "SAMPLER_ENDS", 0)
    rng, good, bad, n = np.random.default_rng(3), 40, 25, 20
    counts = np.bincount([mixing.drawn(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1) / 20_000
    law = np.array([math.comb(good, k) * math.comb(bad, n - k) for k in range(n + 1)]) / math.comb(good + bad, n)
    assert np.abs(counts - law).max() < 0.015
    huge = [mixing.drawn(rng, 3 * 10**11, 10**11, 10**10) for _ in range(20)]
    assert all(abs(x - 7.5e9) < 8 * (10**10 * 0.75 * 0.25) ** 0.5 for x in huge) and len(set(huge)) > 10


def test_small_targets(spark):
    """Targets of less than a block, and of a block and a part."""
    docs = [(i, "w " * 50, "a") for i in range(20)] + [(100, "v " * 90, "b"), (200, "u " * 7, "c"), (300, "t", "d")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check(mixing.taken_words(mixing.mix(df, mixing.cyclic_weight)).collect(), docs, mixing.cyclic_weight)


def check(rows, docs, weights):
    by_doc, total = {}, sum(len(WORD.findall(t or "")) for _, t, _ in docs)
    sizes, source_of = defaultdict(int), {}
    for d, t, s in docs:
        sizes[s] += len(WORD.findall(t or ""))
        source_of[d] = s
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.capped_targets([sizes[s] for s in order], [weights(i, s) for i, s in enumerate(order)], 3)))
    got = defaultdict(int)
    for r in rows:
        by_doc[r.doc_id] = r
        s = source_of[r.doc_id]
        got[s] += r.taken
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
    assert len(rows) == len(docs)
    for d, t, _ in docs:
        assert by_doc[d].size == len(WORD.findall(t or ""))
    for s in order:
        assert abs(got[s] - targets[s]) <= 0.5 + 1e-6
    assert abs(sum(got.values()) - total) <= 0.5 * len(order) + 1e-6


def test_edge_rows(spark):
    docs = [
        (1, "a b c", "x"), (2, None, "x"), (3, " \n", None), (4, "w " * 3000, None), (5, "a b c", "y"), (6, "a\x1fb c", "y"),
        (7, "v " * 2000, "z"),
    ]
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, source string, size int, block string")
    first = mixing.taken_words(mixing.mix(df, mixing.cyclic_weight)).collect()
    check(first, docs, mixing.cyclic_weight)
    again = mixing.taken_words(mixing.mix(df.repartition(3), mixing.cyclic_weight)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x")] * 5 + [(1, "", "x")] * 3, "doc_id long, text string, source string")
    rows = mixing.taken_words(mixing.mix(df, mixing.cyclic_weight)).collect()
    assert sorted((r.size, r.taken) for r in rows) == [(0, 0)] * 3 + [(2, 2)] * 5
    assert mixing.taken_words(mixing.mix(df.limit(0), mixing.cyclic_weight)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(queries()["op9_mix_sources"](spark, sf).collect(), docs, mixing.cyclic_weight)
