from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimflow.llm import line_rules
from claimflow.llm.queries import oracle_sql, queries
from tests.compare import connect, differences

GOOD = "This is a plain line of some words, and it ends as lines do.\n"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def judged(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, rules string, _n int")
    rows = line_rules.clean_lines(df).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return [r.rules for r in rows]


def test_counts_against_brute_force(spark):
    texts = [
        None, "", " \n\t", "one", "a b c", "a b c a b c", "a b c a b", "x y z\x1cw", "a\nb\n\na\n b\nb", "é# <&>|",
        "w " * 5000, " ".join(str(i % 700) for i in range(3000)), " ".join(map(str, range(400))) * 2, "a\r\nb\x0bc\x0cd",
    ]
    for text, r in zip(texts, judged(spark, texts)):
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(text), text


@pytest.mark.parametrize("line", [
    "De%%% êeux*** ouier### onaiaux%%% réeaution*** ouqueaux.", "Home | About us | News | Contact | Help.", "Main menu",
    "GO!! AND!! BUY!! IT!! NOW!!", "Copyright 2020 A. All rights reserved.", "Licensed under CC BY-NC 4.0.",
])
def test_lines_that_go(spark, line):
    text = " ".join(f"word{i}" for i in range(60)) + " end.\n"
    r = judged(spark, [text + line + "\n\n" + GOOD])[0]
    assert r.kept and r.text == text + "\n" + GOOD and r.lost_chars == len(line)


def test_documents_that_lose_much_go(spark):
    text = " ".join(f"word{i}" for i in range(60)) + " end.\n"
    junk = "\n".join(" ".join(f"j{i}{n}***" for i in range(10)) + "." for n in range(20))
    kept, lost, null = judged(spark, [text + GOOD, text + junk, None])
    assert kept.kept and not lost.kept and not lost.base_failed and not null.kept and null.text is None


def test_no_python_and_no_shuffle(spark):
    plan = queries()["op3_line_first_cleaning"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_rules.clean_lines(df).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op3_line_first_cleaning"
    assert differences(queries()[name](spark, sf), connect(sf), oracle_sql()[name]) is None


def test_labels(spark):
    """Documents labelled bad go, good ones of enough words stay."""
    sf = "/root/testdata/sf0.1"
    rows = queries()["op3_line_first_cleaning"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = {(r.quality, r.kept): r["count"] for r in rows.filter("n_words >= 50").groupBy("quality", "kept").count().collect()}
    assert got.get((1, False), 0) <= 0.01 * got[(1, True)]
    assert got.get((0, True), 0) <= 0.05 * got[(0, False)]


def test_other_columns_may_have_any_name_and_ansi_be_off(spark):
    names = ["_words", "_lines", "_windows", "_full", "_left", "_sorted", "_repeat", "_chars", "_kept_chars", "_n", "_text", "row"]
    rows = [(1, "one two three.\nfour five six.", *range(12)), (2, "a b c " * 40, *range(12)), (None, None, *range(12))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got = line_rules.clean_lines(df)
            assert got.columns == [*df.columns, "rules"] and [tuple(r)[2:14] for r in got.collect()] == [tuple(range(12))] * 3
            assert {r.doc_id: r.rules.n_repeat_words for r in got.collect()} == {1: 0, 2: 120, None: 0}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
