from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from claimflow.llm import line_rules, mixing
from claimflow.llm.queries import queries
from claimflow.session import freeze
from tests.llm import test_line_join, test_packing, test_shingle_join

SF = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, freeze(stage(spark, docs, SF), "stage-test")
        seen[name] = (before, docs)
        if name != "best-fit packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in docs.collect())

    before, after = seen["quality rules"]
    rules = {r.doc_id: r.rules for r in line_rules.clean_lines(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()} == {d: r.text for d, r in rules.items() if r.kept}

    before, after = seen["line dedup"]
    texts = [(r.doc_id, r.text) for r in before.collect()]
    gone = {d: set(v) for (d, _), v in test_line_join.expected(spark, texts).items()}
    want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) for d, t in texts}
    assert {r.doc_id: r.text for r in after.collect()} == want and any(gone.values())

    before, after = seen["n-gram Jaccard join"]
    groups = test_shingle_join.brute([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {least for _, least, _ in groups}
    # here line dedup has already emptied what was near; raw documents do hold near copies
    assert after.count() == len({least for _, least, _ in groups})
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.near_duplicates(spark, raw, SF).count() < raw.count()

    before, after = seen["mixing sources to target weights"]
    rows = before.collect()
    sizes, taken, source = defaultdict(int), defaultdict(int), {}
    words = {r.doc_id: r.text.encode().split() for r in rows}
    for r in rows:
        source[r.doc_id] = r.source
        sizes[r.source] += len(words[r.doc_id])
    passes = defaultdict(int)
    for r in after.collect():
        got = r.text.encode().split()
        assert set(got) <= set(words[r.doc_id]) and len(got) <= len(words[r.doc_id]) and got
        taken[r.source] += len(got)
        passes[r.doc_id] += 1
    assert max(passes.values()) <= 3
    order = sorted(sizes)
    targets = mixing.capped_targets([sizes[s] for s in order], [1.0 + i % 3 for i in range(len(order))], 3)
    assert all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in zip(order, targets))

    before, after = seen["best-fit packing"]
    lengths = [len(TOKENIZER.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()]
    rows = after.collect()
    assert sum(r.length for r in rows) == sum(lengths)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length for r in rows)
    bins, counts = defaultdict(list), defaultdict(int)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        counts[r.length] += 1
    test_packing.assert_whole(bins, counts, 1024)


def test_mixed_documents_edge_rows(spark):
    rng = random.Random(1)
    long = " \n".join(f"w{rng.randrange(99)}" for _ in range(5000))
    rows = [(1, long, "a"), (2, None, "a"), (3, " ", None), (None, "x y", None), (4, "p q", "b"), (4, "p q", "b"), (5, "é  ü", "b")]
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], "doc_id long, text string, source string, block string, n_chars long")
    out = mixing.mixed_documents(df, mixing.cyclic_weight, most=3).collect()
    texts = defaultdict(set)
    for r in out:
        texts[r.doc_id].add(r.text)
        assert r.n_chars == len(r.text) and r.block == "k"
    assert texts[None] == {"x y"} and texts.get(2) is None and texts.get(3) is None
    assert sum(len(r.text.encode().split()) for r in out) >= 4000
    assert mixing.mixed_documents(df.limit(0), mixing.cyclic_weight, most=3).count() == 0


def test_registered(spark):
    rows = queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and np.isin(["doc_id", "sequence_id"], rows.columns).all()


def test_columns_of_any_name(spark):
    """Helper columns of the stages do not meet columns of the input."""
    names = ["_id", "_hash", "_removed", "_n", "_spans", "_key", "ROW", "_text", "_words", "label", "gone", "block", "start", "size"]
    text = "\n".join(f"Line {i} holds plain words number {i} and also {i * 7} more." for i in range(30))
    rows = [(i, text if i < 3 else text.replace("plain", f"p{i}"), "en", "s", len(text), *range(len(names))) for i in range(6)]
    kinds = ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {kinds}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        assert all(tuple(r)[5:] == tuple(range(len(names))) for r in got.collect()), name
    assert corpus_pipeline.near_duplicates(spark, docs, SF).count() == 4
