from __future__ import annotations

import random

from claimflow.llm import line_join
from claimflow.llm.queries import queries


def brute(docs):
    """(doc_id, text) -> numbers of removed lines, by comparing every line with all before it."""
    keys = {(d, t): i for i, (d, t) in enumerate(docs)}
    lines = []
    for d, t in keys:
        for n, line in enumerate((t or "").split("\n")):
            if words := set(line.encode().split()):
                lines.append((d, t, n, words))
    return keys, lines


def expected(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    order = {(r.doc_id, r.text): r.hash for r in line_join.keyed(df, "doc_id", "text").collect()}
    keys, lines = brute(docs)
    lines.sort(key=lambda x: (x[0] is not None, x[0] or 0, order[x[0], x[1]], x[2]))
    gone, by_token = {k: [] for k in keys}, {}
    for i, (d, t, n, words) in enumerate(lines):
        near = {j for w in words for j in by_token.get(w, ())}
        if any(5 * len(words & lines[j][3]) >= 4 * len(words | lines[j][3]) for j in near):
            gone[d, t].append(n)
        for w in words:
            by_token.setdefault(w, []).append(i)
    return {(k[0], order[k]): sorted(v) for k, v in gone.items()}


def got(df):
    rows = line_join.removed_lines(df).collect()
    out = {(r.doc_id, r.hash): list(r.removed) for r in rows}
    assert len(out) == len(rows)
    return out


def test_random_lines_against_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(3000)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 40))] for _ in range(150)]
    docs = []
    for d in range(400):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        docs.append((d, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = expected(spark, docs)
    assert got(df) == want
    assert sum(map(len, want.values())) > 200


def test_edge_rows(spark):
    long_line = " ".join(f"t{i}" for i in range(20_000))
    docs = [
        (1, None), (2, ""), (3, "\n \n"), (4, "a b c d\na b c d e\n\na b c"), (4, "another text"), (None, "a b c d"),
        (5, long_line), (6, long_line + " more"), (7, "x y"), (7, "x y"), (8, "x y"),
    ]
    df = spark.createDataFrame([(d, t, "q", 3) for d, t in docs], "doc_id long, text string, hash string, size int")
    assert got(df) == expected(spark, docs)
    cleaned = sorted(map(str, line_join.remove_lines(df).select("doc_id", "text", "hash", "size").collect()))
    assert len(cleaned) == len(docs)
    texts = {(r.doc_id, r.text) for r in line_join.remove_lines(df).collect()}
    assert {(1, None), (None, "a b c d"), (4, "\na b c"), (6, ""), (8, "")} <= texts


def test_empty_table(spark):
    assert line_join.removed_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: v for (d, _), v in expected(spark, docs).items()}
    rows = queries()["op10_line_dedup"](spark, sf).collect()
    assert {r.doc_id: list(r.removed) for r in rows} == want
