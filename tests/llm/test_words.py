from __future__ import annotations

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from claimflow.llm.tokens import word_batches, words_of

TEXT = st.text(st.one_of(st.sampled_from("ab \n\t\r\x0b\x0c\x1c\x85\xa0é"), st.characters(exclude_categories=["Cs"])), max_size=20)


@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40), st.integers(0, 2))
def test_words_of_a_column(texts, portion, skip):
    column = pa.array([None] * skip + texts, pa.string()).slice(skip)
    got, hashes, rows = [], {}, 0
    for first, last, words in word_batches(column, portion):
        assert first == rows
        rows = last
        cuts = words.first_words()
        assert words.of_text().tolist() == [i for i in range(last - first) for _ in range(cuts[i], cuts[i + 1])]
        for i in range(last - first):
            got.append([words.data[a:b].tobytes() for a, b in zip(words.starts[cuts[i] : cuts[i + 1]], words.ends[cuts[i] : cuts[i + 1]])])
        for a, b, h in zip(words.starts, words.ends, words.hashes.tolist()):
            assert hashes.setdefault(words.data[a:b].tobytes(), h) == h
    assert rows == len(texts) and got == [words_of(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)
