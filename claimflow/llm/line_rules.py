"""Line-first cleaning: rules per line, failing lines removed, documents that lose too much rejected.

DataFrame functions only: a document is one row from scan to result, so nothing is shuffled, and no group of copies
or sources matters. Arrays that several expressions read are columns of their own projection, so each is made once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

# Lines that fail: share of symbols in percent of the line's characters, and patterns.
MOST_SYMBOLS = 8
SHOUTING = r"(?:[!?]{2,}[^!?]+){3}"
NAVIGATION = r"(?:[|»›•][^|»›•]{0,40}){3}"
FIVE_WORDS = rf"(?:{NOT_SPACE}+{SPACE}+){{4}}{NOT_SPACE}"
ENDS = rf"[.!?…。:;\x22”’»)\]]{SPACE}*$"
BOILERPLATE = (
    r"(?i)all rights reserved|privacy policy|terms of (?:use|service)|cookie policy|uses cookies|accept cookies"
    r"|lorem ipsum|enable javascript|licensed under|skip to content|sign up for|subscribe to our|click here"
)
# Of the characters of lines with words, percent that a kept document may lose.
MOST_LOST = 30
# Fewest words, and most words in repeated 3-word windows in percent of all.
FEWEST_WORDS = 50
MOST_REPEATED = 50


def symbols(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS + "+", ""))


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(NOT_SPACE))


def line_fails(line: Column) -> Column:
    """A line with a word that breaks a punctuation, navigation or boilerplate rule."""
    punctuation = (100 * symbols(line) > MOST_SYMBOLS * F.char_length(line)) | F.rlike(line, F.lit(SHOUTING))
    unended = ~F.rlike(line, F.lit(ENDS)) & ~F.rlike(line, F.lit(FIVE_WORDS))
    navigation = F.rlike(line, F.lit(NAVIGATION)) | unended
    return has_word(line) & (punctuation | navigation | F.rlike(line, F.lit(BOILERPLATE)))


def total_length(lines: Column) -> Column:
    return F.char_length(F.array_join(lines, ""))


def clean_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs`, and `rules`: a struct with the cleaned text, the counts and the verdict.

    rules: text (failing lines removed), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars,
    base_failed, kept. Counts are of the whole text as it came: word_chars are the characters of its words,
    n_dup_lines its lines with a word that equal an earlier line, n_repeat_words the words in 3-word windows found
    twice or more. Null text counts as empty and stays null; it and blank texts have no words, so the base fails.
    Rows are judged one by one: repeated rows, null ids and an empty table need no care. A column of `docs` named
    `rules` is replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    # The row goes along as one column, so that no name of it meets those of the steps.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "rules"])
    step = docs.select(row.alias("row"), text.alias("_text"), words.alias("_words"), F.split(text, "\n").alias("_lines"))
    given, text = F.col("row").getField(text_col).isNotNull(), F.col("_text")

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))

    n_windows = F.greatest(F.size("_words") - 2, F.lit(0))
    step = step.withColumns({
        "_windows": F.slice(F.transform("_words", window), F.lit(1), n_windows),
        "_full": F.filter("_lines", has_word),
        "_left": F.filter("_lines", lambda line: ~line_fails(line)),
    })
    # Only texts with a repeated window are sorted.
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_sorted", F.when(repeated, F.sort_array(numbered)))

    def covered(entry: Column, n: Column) -> Column:
        same = (entry["h"] == F.get("_sorted", n - 1)["h"]) | (entry["h"] == F.get("_sorted", n + 1)["h"])
        i = entry["i"]
        return F.when(same, F.array(i, i + 1, i + 2))

    spans = F.flatten(F.array_compact(F.transform("_sorted", covered)))
    step = step.withColumns({
        "_repeat": F.when(F.col("_sorted").isNotNull(), F.size(F.array_distinct(spans))).otherwise(0), "_chars": total_length(F.col("_full")),
        "_kept_chars": total_length(F.filter("_left", has_word)), "_n": F.size("_words"),
    })
    base_failed = (F.col("_n") < FEWEST_WORDS) | (100 * F.col("_repeat") > MOST_REPEATED * F.col("_n"))
    lost = F.col("_chars") - F.col("_kept_chars")
    rules = F.struct(
        F.when(given, F.array_join("_left", "\n")).alias("text"),
        F.col("_n").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbols(text).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("lost_chars"),
        base_failed.alias("base_failed"),
        (~base_failed & (100 * lost <= MOST_LOST * F.col("_chars"))).alias("kept"),
    )
    return step.select("row.*", rules.alias("rules"))


# The same in DuckDB. A window is compared as text, not by its hash.
SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS full_lines
  FROM base
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM parts)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id
), good AS (
  SELECT *, list_filter(full_lines, lambda l: NOT (
    100 * (length(l) - length(regexp_replace(l, '{SYMBOLS}+', '', 'g'))) > {MOST_SYMBOLS} * length(l)
    OR regexp_matches(l, '{SHOUTING}') OR regexp_matches(l, '{NAVIGATION}')
    OR (NOT regexp_matches(l, '{ENDS}') AND NOT regexp_matches(l, '{FIVE_WORDS}'))
    OR regexp_matches(l, '{BOILERPLATE}'))) AS good_lines
  FROM parts
), counted AS (
  SELECT g.doc_id, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '{SYMBOLS}+', '', 'g')))::BIGINT AS n_symbols,
    (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    length(array_to_string(full_lines, '')) AS chars,
    length(array_to_string(good_lines, '')) AS good_chars
  FROM good g LEFT JOIN covered c ON g.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (chars - good_chars)::BIGINT AS lost_chars,
  base_failed, NOT base_failed AND 100 * (chars - good_chars) <= {MOST_LOST} * chars AS kept
FROM judged
"""
