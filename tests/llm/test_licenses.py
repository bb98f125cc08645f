from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from claimflow.llm import licenses
from claimflow.llm.license_texts import BASE_PHRASES, TEMPLATES
from claimflow.llm.queries import queries


def words_of(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def base_of(words):
    return sorted(
        (i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    )


def brute_anchors(symbols, sequences, least):
    """Runs that a document and a template share and that no word before or after extends."""
    out = set()
    for t, s in enumerate(sequences):
        for i in range(len(symbols)):
            for j in range(len(s)):
                if symbols[i] != s[j] or (i and j and symbols[i - 1] == s[j - 1]):
                    continue
                n = 0
                while i + n < len(symbols) and j + n < len(s) and symbols[i + n] == s[j + n]:
                    n += 1
                if n >= least:
                    out.add((t, i, j, n))
    return out


def test_anchors_against_all_shared_runs():
    rng = random.Random(2)
    for _ in range(150):
        texts = {f"t{i}": (f"l{i}", " ".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))) for i in range(4)}
        scanner = licenses.Scanner(texts, {"a b": "x"})
        text = " ".join(rng.choice("abcabcabcz") for _ in range(rng.randint(0, 60)))
        symbols = scanner.symbols(licenses.words_of(text.encode()))
        for least in (2, 4):
            got = [(a.template, a.doc_start, a.start, a.size) for a in scanner.anchors(symbols, least)]
            assert len(set(got)) == len(got)
            assert set(got) == brute_anchors(symbols.tolist(), scanner.sequences, least)


def test_chain_covers_as_much_as_any():
    rng = random.Random(4)
    for _ in range(200):
        anchors = [licenses.Anchor(0, rng.randint(0, 30), rng.randint(0, 30), rng.randint(2, 6)) for _ in range(rng.randint(1, 7))]

        def best(a):
            out = a.size
            for b in anchors:
                gaps = (a.doc_start - b.doc_start - b.size, a.start - b.start - b.size)
                if b.doc_start < a.doc_start and b.start < a.start and max(gaps) <= 5 and a.size + min(*gaps, 0) > 0:
                    out = max(out, best(b) + a.size + min(*gaps, 0))
            return out

        chains = licenses._chains(anchors, 5)
        assert chains[0][0] == max(map(best, anchors))
        spans = sorted((first, last) for _, first, last in chains)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.fixture
def scanned(spark):
    def run(*texts):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return {r.doc_id: r for r in licenses.scan_licenses(df).collect()}

    return run


def test_templates_are_found_whole_changed_and_cut(scanned):
    rng = random.Random(6)
    names = [n for n, (_, t) in TEMPLATES.items() if len(words_of(t)) >= 40]
    texts = []
    for n in names:
        whole = words_of(TEMPLATES[n][1])
        changed = [rng.choice(["xx", "yy zz", ""]) if i % 25 == 12 else w for i, w in enumerate(whole)]
        half = whole[: len(whole) // 2]
        texts += [" ".join(["Intro"] * 5 + w + ["outro"] * 9) for w in (whole, changed, half)]
    got = scanned(*texts)
    for i, n in enumerate(names):
        whole, changed, half = (got[3 * i + k] for k in range(3))
        span = [s for s in whole.spans if s.template == n]
        size = len(words_of(TEMPLATES[n][1]))
        assert [(s.first_word, s.last_word, s.covered, s.size) for s in span] == [(5, 4 + size, size, size)]
        # A short template may stand whole in a long one, so the share is looked at per template.
        assert whole.best_share == 1 and [s.covered < size for s in changed.spans if s.template == n] == [True]
        assert n not in {s.template for s in half.spans} and 0.4 < half.best_share


def test_words_of_a_licence_in_another_order_are_not_one(scanned):
    words = words_of(TEMPLATES["mit-text"][1])
    random.Random(1).shuffle(words)
    texts = [" ".join(words), "the software is provided for any use of the work and the work is free", "a license of MIT"]
    assert all(not r.spans and not r.base for r in scanned(*texts).values())


def test_rows_of_every_kind(spark):
    mit = TEMPLATES["mit-text"][1]
    rows = [
        (0, None), (1, ""), (2, " .,\n"), (3, "MIT License"), (4, "mit\x00license"), (5, "mit licensé"), (6, "ＭＩＴ License"),
        (7, "Apache-License; GNU general/public\nLICENSE mit license"), (None, "the mit license"), (3, "MIT License"),
        (8, "word " * 20_000 + mit + " Word" * 20_000), (9, (mit + " ") * 300), (10, "mit mit license license"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, base string, words int")
    got = licenses.summary(licenses.scan_licenses(df)).collect()
    assert len(got) == len(rows)
    for (doc_id, text), r in zip(sorted(rows, key=repr), sorted(got, key=lambda r: repr((r.doc_id, dict(rows).get(r.doc_id))))):
        words = words_of(text)
        places = base_of(words)
        at = [i for i, _ in places]
        assert (r.doc_id, r.n_words, r.n_base) == (doc_id, len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].labels == by_id[9].labels == "mit-text" and by_id[8].score == by_id[9].score == 1
    assert by_id[7].base_labels == "apache,gpl,mit"
    spans = licenses.scan_licenses(df.where("doc_id = 9")).select(F.size("spans")).first()[0]
    assert spans == 300


def test_empty_table(spark):
    assert licenses.summary(licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_query_against_search(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: words_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries()["op13_license_scan"](spark, sf)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        places = base_of(docs[r.doc_id])
        assert (r.n_words, r.n_base) == (len(docs[r.doc_id]), len(places))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        text = " ".join(docs[r.doc_id])
        for name in ("mit-reference", "apache-2.0-reference", "gpl-reference", "cc-by-nc-reference"):
            label, template = TEMPLATES[name]
            if f" {' '.join(words_of(template))} " in f" {text} ":
                assert label in r.labels.split(",") and r.score == 1
    assert sum(r.n_base > 0 for r in rows) > 10 and any("cc-by-nc" in r.labels for r in rows)
