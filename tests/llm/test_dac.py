from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimflow.llm import dac
from claimflow.llm.queries import queries
from claimflow.llm.tokens import Encoder
from claimflow.session import scratch_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from("ab .,'s\n\t\r ! 1é́ß\x85\xa0\x1c　ΑΣ<|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(name, text):
    encoder = Encoder.shared(public_tokenizers.path(name))
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text, None])[0], "<u4").tolist() == want


@pytest.mark.parametrize("name", FILES)
def test_every_letter_before_every_ascii_sign(name):
    """With and without a character beyond Latin, which decides how a text is cut."""
    encoder = Encoder.shared(public_tokenizers.path(name))
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    texts = [f"a{chr(c)}{s}b {end}" for c in [*range(1, 0x250), 0x307, 0x338, 0x3A3, 0x1E9E, 0xFB01] for s in signs for end in ("", "“")]
    texts += ["TÜRKİ, “evet”", "RESMİ: 5 – 6", "İ", "İİ.", "Iİi, ı“"]
    want = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    wrong = [t for t, ids, w in zip(texts, encoder.encode(texts), want) if np.frombuffer(ids, "<u4").tolist() != w.ids]
    assert not wrong, wrong[:20]


@pytest.mark.parametrize("name", FILES)
def test_words_by_the_model_alone(name):
    """New words skip the library's steps before the model, which leave them as they are; texts beyond Latin too."""
    encoder = Encoder(public_tokenizers.path(name))
    assert encoder.word is not None
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = [f"{a}b {b}{a} {a}{b}{end}" for a, b in zip(letters, letters[7:]) for end in ("", " 字", " don't", ", 12")]
    want = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [w.ids for w in want]


@pytest.mark.parametrize("name", FILES)
def test_memory_of_pieces_is_bounded_and_keeps_the_first(name):
    encoder = Encoder(public_tokenizers.path(name), most_pieces=100)
    early = [f" early{i}" for i in range(40)]
    encoder.encode(early)
    for k in range(30):
        encoder.encode([f" w{k}x{i} " + "long" * 20 for i in range(50)])
        assert len(encoder.ids) <= 100 + 200
    encoder._forget()
    assert len(encoder.number) <= 50
    met = len(encoder.ids)
    encoder.encode(early)
    assert len(encoder.ids) - met < len(early)  # some are remembered
    want = encoder.tokenizer.encode_batch_fast(early, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(early)] == [w.ids for w in want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=900), max_size=4))
def test_image_round_trip_and_random_access(docs):
    ids = np.array([i for d in docs for i in d], np.uint32)
    names = [None if n == 0 else -n for n in range(len(docs))]
    reader = dac.Reader(dac.encode(ids, names, np.cumsum([len(d) for d in docs])))
    assert reader.doc_ids == names and reader.n_tokens == len(ids)
    assert reader.tokens(0, len(ids)).tolist() == ids.tolist()
    for i in range(0, len(ids), 97):
        assert reader.token(i) == ids[i]
        assert reader.tokens(i, min(len(ids), i + 700)).tolist() == ids[i : i + 700].tolist()
    with pytest.raises(IndexError):
        reader.token(len(ids))


def test_documents_come_back_whole(spark):
    rows = [(5, "b b"), (None, "x"), (3, None), (3, None), (4, ""), (2, "word " * 30_000), (7, "b b")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, ids string")
    path = scratch_path(spark, "dac-test")
    dac.write_dac(df, path, public_tokenizers.path(FILES[1]), end_id=1, segment_tokens=50)
    starts = {(r.part, r.segment): r.start for r in dac.segment_starts(spark.read.parquet(path)).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path(FILES[1]))
    got = sorted((starts[r.part, r.segment] + r.start_in_segment, r.doc_id, bytes(r.ids)) for r in dac.read_dac(spark, path).collect())
    at = 0
    for start, _, ids in got:
        assert start == at
        at += len(ids) // 4
    assert [d for _, d, _ in got] == [None, 2, 3, 3, 4, 5, 7]
    texts = {None: "x", 2: "word " * 30_000, 3: "", 4: "", 5: "b b", 7: "b b"}
    for _, d, ids in got:
        assert np.frombuffer(ids, "<u4").tolist() == [*tok.encode(texts[d], add_special_tokens=False).ids, 1]


def test_empty_table(spark):
    path = scratch_path(spark, "dac-test")
    dac.write_dac(spark.createDataFrame([], "doc_id long, text string"), path, public_tokenizers.path(FILES[1]), 1)
    assert dac.read_dac(spark, path).count() == 0


def test_query_against_plain_encoding(spark):
    sf = "/root/testdata/sf0.001"
    tok, want, at = Tokenizer.from_file(public_tokenizers.path(FILES[1])), [], 0
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = queries()["op8_directly_addressable_codes"](spark, sf)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
