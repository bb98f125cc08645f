from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from tests.compare import connect, differences

from claimflow.llm import collocations
from claimflow.llm.queries import oracle_sql, queries


def brute(rows, least, longest=4, percent=80):
    """(lang, text) -> rows of the result, by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    chosen = {key for key, a in f.items() if a >= least and len(key[1]) > 1}
    for lang, p in chosen:
        a = f[lang, p]
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        holds = [q for m, q in chosen if m == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * f[lang, q] >= percent * a for q in holds):
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted(out)


@pytest.mark.parametrize("chunk_words, unit_pairs", [(1 << 20, 1 << 19), (300, 200), (1, 1 << 20)])
def test_against_every_phrase(spark, chunk_words, unit_pairs):
    rng = random.Random(chunk_words)
    words = [f"w{min(int(rng.paretovariate(0.7)), 200)}" for _ in range(4000)] + ["É", "é", "Z", "z\x85", "\x1cq", "a\tb"]
    fixed = [[rng.choice(words) for _ in range(rng.randint(2, 5))] for _ in range(20)]
    rows = []
    for i in range(250):
        text = []
        for _ in range(rng.randint(0, 30)):
            text += rng.choice(fixed) if rng.random() < 0.5 else [rng.choice(words)]
            text.append(rng.choice(["", "", "", "", ". ", ",", "\n", "\x0b!"]))
        rows.append((rng.choice(["en", "de", None, "und"]), " ".join(text)))
    rows += [("en", None), (None, ""), ("fr", "one two. " * 500), ("fr", "one two. " * 500), ("x", "rare words"), ("en", "a a a a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, chunk string")
    got = collocations.collocations(df, least=6, chunk_words=chunk_words, unit_pairs=unit_pairs).collect()
    want = brute(rows, 6)
    assert sorted(map(tuple, got)) == want and len(want) > 50
    assert ("fr", "one two", 1000, 1000, 1000, 2000, 1_000_000) in want


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(1)
    for size in (0, 1, 500, 40_000):
        row, column = (np.minimum(rng.zipf(1.3, size), 1 << 20).astype(np.int64) for _ in range(2))
        keys, want = row << 32 | column, Counter((row << 32 | column).tolist())
        key, count = collocations.count_keys(keys)
        assert dict(zip(key.tolist(), count.tolist())) == want and (np.diff(key) > 0).all()
        key, total = collocations.count_keys(np.concatenate([key, key]), np.concatenate([count, count]))
        assert dict(zip(key.tolist(), total.tolist())) == {k: 2 * n for k, n in want.items()}


def test_scores_beyond_64_bits(spark):
    big = 1 << 62
    expr = f"cast(2000000 as decimal(18,0)) * cast({big}L as decimal(19,0)) div cast({big}L + 1L as decimal(20,0))"
    assert spark.sql(f"select {expr}").first()[0] == 2_000_000 * big // (big + 1)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.top_per_language(collocations.collocations(df), 2000).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op12_collocations"](spark, sf)
    assert differences(got, connect(sf), oracle_sql()["op12_collocations"]) is None
