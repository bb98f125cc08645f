from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimflow.llm import packing
from claimflow.llm.queries import queries

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def bins_of(runs):
    """Sequence -> its (offset, length), written out."""
    bins, numbers = defaultdict(list), defaultdict(list)
    for r in runs:
        numbers[r.length] += range(r.low, r.high)
        for i in range(r.high - r.low):
            bins[r.sequence + i // r.per_sequence].append((r.offset + i % r.per_sequence * r.length, r.length))
    return bins, numbers


def assert_whole(bins, counts, capacity):
    got = Counter()
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
            got[length] += 1
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in items) <= 2
    assert got == Counter(counts)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30)))))
def test_plan_places_every_piece_once(case):
    capacity, counts = case
    bins, numbers = bins_of(packing.plan(counts, capacity))
    assert_whole(bins, counts, capacity)
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(n)) for k, n in counts.items()}
    # No two pieces above half the capacity share a sequence: seven pieces of 6 of 11 need seven.
    least = max(-(-sum(k * n for k, n in counts.items()) // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    assert len(bins) <= max(least * 1.7, least + 1)


def test_plan_is_near_the_bound_and_small():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(1, 1025, 200_000).tolist())
    runs = packing.plan(counts, 1024)
    bins, _ = bins_of(runs)
    assert len(bins) <= 1.01 * sum(k * n for k, n in counts.items()) / 1024
    assert len(runs) < 20_000


def test_plan_refuses_other_lengths():
    for length in (0, 11):
        with pytest.raises(ValueError):
            packing.plan({length: 1}, 10)


def check_rows(rows, docs, capacity, end_id):
    tok, by_doc, bins = Tokenizer.from_file(BYTE), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        at = 0
        for n, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert n == 0 or r.length == capacity
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    counts = Counter(length for items in bins.values() for _, length in items)
    assert_whole(bins, counts, capacity)


def test_pack_small_tables(spark):
    docs = {1: None, 2: "", 3: "a b c d e f g", 4: "x " * 5000, 5: "a b c d e f g", None: "hello"}
    df = spark.createDataFrame([(k, t, 0, 0) for k, t in docs.items()], "doc_id long, text string, offset int, ids int")
    packed = packing.pack(df, BYTE, 2, 16).cache()
    check_rows(packed.collect(), docs, 16, 2)
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packed).collect()}
    assert max(whole.values()) <= 16 and sum(whole.values()) == sum(r.length for r in packed.collect())
    assert packing.pack(df.limit(0), BYTE, 2, 16).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries()["op5_best_fit_packing"](spark, sf).collect()
    check_rows(rows, docs, 1024, 2)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 1024) + 1
