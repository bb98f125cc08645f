from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from claimflow.llm import shingle_join
from claimflow.llm.queries import queries


def shingles(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(docs):
    """Per row: (least id of its group, links)."""
    sets = [shingles(t) for _, t in docs]
    links, root = [0] * len(docs), list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, j in {p for group in by.values() for p in combinations(group, 2)}:
        both = len(sets[i] & sets[j])
        if 5 * both >= 4 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low.setdefault(find(i), []).append((d is not None, d or 0, d))
    return [(d, min(low[find(i)])[2], links[i]) for i, (d, _) in enumerate(docs)]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def check(spark, docs):
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, block string, n int")
    got = [(r.doc_id, r.class_id, r.n_links) for r in shingle_join.link_documents(df).collect()]
    assert sorted(got, key=key) == sorted(brute(docs), key=key)
    return df


def variants(rng, n_docs, family, words=2000):
    base = [[f"w{rng.randrange(words)}" for _ in range(rng.randint(6, 120))] for _ in range(n_docs)]
    docs = [" ".join(b) for b in base]
    for _ in range(family):
        b = list(base[0])
        for _ in range(rng.randint(0, 5)):
            b[rng.randrange(len(b))] = f"v{rng.randrange(10**6)}"
        docs.append(" ".join(b))
    for b in base[1:40]:
        for _ in range(rng.randint(1, 3)):
            c = list(b)
            c[rng.randrange(len(c))] = "changed"
            docs.append(" ".join(c))
    return docs


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_CLASSES", 16)  # many blocks
    rng = random.Random(3)
    check(spark, list(enumerate(variants(rng, 120, 150))))


def test_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c"), (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
        (None, "x y z u v w"), (9, "x y z u v w"), (10, long), (11, long + " more words"), (12, "other words of no kin to any at all"),
    ]
    df = check(spark, docs)
    stay = {(r.doc_id, r.text) for r in shingle_join.one_per_group(df).collect()}
    assert {d for d, _ in stay} == {1, 2, 3, 4, 6, 7, None, 10, 12}
    assert shingle_join.one_per_group(df).columns == df.columns


def test_one_of_each_group_stays(spark):
    """Of repeated rows, and of near copies of one id, one; of unlike texts of one id, each; of texts without words, all."""
    near, other, third = (" ".join(f"{c}{i}" for i in range(80)) for c in "xyz")
    docs = [(1, near), (1, near), (1, near), (1, near + " end"), (2, near), (1, other), (3, other), (None, third), (None, third), (5, " "), (5, " ")]
    df = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, source string")
    rows = shingle_join.one_per_group(df).collect()
    assert sorted((r.doc_id or 0, r.text.split()[:1]) for r in rows) == [
        (0, ["z0"]), (1, ["x0"]), (1, ["y0"]), (5, []), (5, []),
    ]


def test_empty_table(spark):
    assert shingle_join.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pruning_keeps_what_can_reach_the_threshold():
    least = shingle_join.least_matches()
    assert least[0] == 0 and least == sorted(least) and 80 > least[128] > 50
    rng = np.random.default_rng(1)
    for similarity, share in ((0.8, 1.0), (0.2, 0.0)):
        kept = 0
        for _ in range(2000):
            agree = np.cumsum(rng.random(128) < similarity)
            kept += all(agree[n - 1] >= least[n] for n in range(16, 129, 16))
        assert abs(kept / 2000 - share) < 0.001


def test_components_follow_long_chains(spark):
    struct = "struct<low:long,high:long>"
    edges = [((i, 0), (i + 1, 0)) for i in range(60)] + [((100, 1), (100, 2)), ((100, 3), (100, 2))]
    df = spark.createDataFrame(edges, f"a {struct}, b {struct}")
    got = {tuple(r.node): tuple(r.label) for r in shingle_join.components(df).collect()}
    assert {got[i, 0] for i in range(61)} == {(0, 0)} and {got[100, i] for i in (1, 2, 3)} == {(100, 1)}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries()["op4_ngram_jaccard_join"](spark, sf).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == sorted(brute(docs))
