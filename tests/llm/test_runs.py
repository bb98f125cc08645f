from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from claimflow.llm import runs
from claimflow.llm.queries import queries


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        best = 1
        for j in range(i + 1, len(s) + 1):
            w = s[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def brute_runs(s, least=6, times=4):
    """Every maximal stretch of every period, kept where no smaller period holds for it."""
    found = {}
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and (i, j + q) not in found:
                found[i, j + q] = q
            i = max(j, i) + 1
    return sorted((i, e - i, q) for (i, e), q in found.items())


def want_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in found), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_lyndon_array(s):
    assert runs.lyndon_array(np.array(s), 3).tolist() == brute_lyndon(s)


def make(rng, n):
    """Words with nested repetitions, some cut off or broken."""
    out = []
    while len(out) < n:
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 6))]
        block = unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        if rng.random() < 0.3:
            block = (block + [rng.choice("xy")]) * rng.randint(1, 6)
        if rng.random() < 0.3 and block:
            block[rng.randrange(len(block))] = rng.choice("abz")
        out += block
    return out[:n]


def test_runs_with_and_without_reduction():
    rng = random.Random(3)
    for _ in range(100):
        words = make(rng, rng.randint(1, 300))
        number = {w: i + 1 for i, w in enumerate(sorted(set(words)))}
        symbols = np.array([number[w] for w in words] + [0])
        for least, times in ((6, 4), (3, 2), (5, 3)):
            want = brute_runs(words, least, times)
            whole = runs.runs_of(symbols, len(number) + 1, 1, least, times)
            assert list(map(tuple, whole.tolist())) == want
            text = " ".join(words).encode()
            view = runs.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            assert sorted(map(tuple, runs.runs_of_words(view, least, times).tolist())) == want


def test_rows_of_every_kind(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a a a a a", "a  a\na\ta a a", "É É É É É É É", "\x85x \x1cx x\xa0x", "w " * 30_000]
    texts += [" ".join(make(rng, rng.randint(1, 200))) for _ in range(300)]
    texts += [" ".join(f"u{i}" for i in range(2000)) + " " + "p q r " * 50 + "tail", "z y " * 3 + "z y"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b b b b b b b"), (3, "c " * 9), (3, "c " * 9)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, words int")
    got = runs.digest(runs.periodic_runs(runs.with_repeated_tails(df))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((want_row(*r) for r in rows), key=repr)
    plain = {(r.doc_id, r.collapsed) for r in runs.periodic_runs(df.where("doc_id is null or doc_id = 5")).collect()}
    assert plain == {(None, "b"), (5, "a")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digest(runs.periodic_runs(runs.with_repeated_tails(df))).count() == 0


def test_query_against_every_period(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op11_periodic_runs"](spark, sf)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    want = sorted(want_row(*r) for r in rows)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(w[1] > 0 for w in want) > 5
