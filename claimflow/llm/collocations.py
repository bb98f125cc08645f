"""Phrase collocations: phrases of 2 to 4 words, scored by how rarely their parts occur apart.

A phrase of k + 1 words is a pair: a frequent phrase of k words, and the word after it. So one routine counts pairs of
ids and is applied to its own results:

1. Tasks cut the texts into chunks of one language and store each as a dictionary of its words and an array of their
   places in it. The dictionaries are counted together; words that occur often enough are numbered by falling
   frequency, and each chunk gets the numbers of its words back.
2. Pairs (id of the phrase, id of the next word) are counted per chunk. Ids are dealt to a grid of SIDE x SIDE units by
   their remainders, so that each unit has its share of the frequent ids, and within a unit the quotients are cut into
   square tiles. Tiles near the origin are dense: they are counted with bincount into an array. The sparse others are
   counted as sorted coordinates. A chunk sends one row to each unit it has pairs for.
3. A unit adds up what the chunks sent, tile by tile. Frequent pairs are numbered by falling frequency, the unit answers
   every chunk with the numbers of its pairs, and these are the ids of the next level.

A phrase that is frequent has frequent parts, so nothing is lost on the way. SIDE grows with the number of words; the
pairs of a unit, of a chunk, and the frequent pairs of a unit have a bounded size. One row per range partition and the
numbers of words reach the driver.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.functions.keys import with_dense_key
from claimflow.session import freeze

CHUNK_WORDS = 1 << 20
UNIT_PAIRS = 1 << 19  # pairs of a unit, about
TILE = 64
MERGE_PAIRS = 1 << 20  # entries held before they are added up
DENSE = 4  # a tile is dense if it has an entry for each so many cells, at least
BREAK = b"."
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
CHUNK = "chunk long, lang string, words array<binary>, counts array<long>, places binary"
PAIRS = "chunk long, unit int, keys binary, counts binary"
UNKNOWN = "und"

# Capitals become small letters, the signs that end a piece become full stops, a tab becomes a space.
_FOLD = bytes(
    0x2E if chr(c) in ".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)


def words_and_breaks(text: bytes) -> list[bytes]:
    """The words of a text in order, with BREAK between pieces."""
    return text.translate(_FOLD).replace(BREAK, b" . ").split()


def _next_chunk(counter: Iterator[int]) -> int:
    return TaskContext.get().partitionId() << 32 | next(counter)


def chunks_of(docs: DataFrame, text_col: str, lang_col: str, chunk_words: int) -> DataFrame:
    """The texts as chunks of one language: a dictionary of words with counts, and the words' places in it.

    Place 0 stands for a break, which also ends each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count()
        open_chunks: dict[str, tuple[defaultdict, list[np.ndarray]]] = {}

        def closed(lang: str) -> pa.RecordBatch:
            known, parts = open_chunks.pop(lang)
            places = np.concatenate(parts)
            counts = np.bincount(places, minlength=len(known))
            counts[0] = 0
            columns = [
                pa.array([_next_chunk(numbers)]), pa.array([lang]), pa.array([list(known)], pa.list_(pa.binary())),
                pa.array([counts]), pa.array([_packed(places)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "lang", "words", "counts", "places"])

        held: dict[str, int] = defaultdict(int)
        total = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                if lang not in open_chunks:
                    known = defaultdict(itertools.count().__next__)
                    known[BREAK]
                    open_chunks[lang] = known, []
                known, parts = open_chunks[lang]
                words = words_and_breaks(text.as_py())
                words.append(BREAK)
                places = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                parts.append(places)
                held[lang] += len(places)
                total += len(places)
                # All languages together stay within a bound: the fullest one is let go.
                if total >= chunk_words:
                    fullest = max(held, key=held.get)
                    total -= held.pop(fullest)
                    yield closed(fullest)
        for lang in list(open_chunks):
            yield closed(lang)

    rows = docs.select(
        F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    return rows.mapInArrow(run, CHUNK)


def _units(left: np.ndarray, right: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit, key within the unit) of pairs of ids."""
    unit = left % side * side + right % side
    return unit, (left // side) << 32 | right // side


def count_keys(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, total per key): bincount in dense tiles, sorted coordinates elsewhere."""
    row, column = keys >> 32, keys & 0xFFFFFFFF
    # The tiles that can be dense lie near the origin, since ids are numbered by frequency.
    reach, cells = math.isqrt(len(keys) * DENSE // (TILE * TILE)) + 1, TILE * TILE
    near = (row < reach * TILE) & (column < reach * TILE)
    tile = np.where(near, row // TILE * reach + column // TILE, reach * reach)
    entries = np.bincount(tile, minlength=reach * reach + 1)
    dense = entries * DENSE >= cells
    dense[-1] = False
    out_keys, out_counts = [], []
    if dense.any():
        inside, slot, number = dense[tile], np.cumsum(dense) - 1, np.flatnonzero(dense)
        cell = slot[tile[inside]] * cells + row[inside] % TILE * TILE + column[inside] % TILE
        # Totals below 2^53 are exact as floats too.
        weights = None if counts is None else counts[inside]
        total = np.bincount(cell, weights, len(number) * cells).astype(np.int64)
        cell = np.flatnonzero(total)
        top, start = number[cell // cells] // reach * TILE, number[cell // cells] % reach * TILE
        out_keys.append((top + cell % cells // TILE) << 32 | start + cell % TILE)
        out_counts.append(total[cell])
    rest = ~dense[tile]
    if rest.any():
        sparse = keys[rest]
        order = np.argsort(sparse, kind="stable")
        sparse = sparse[order]
        first = np.flatnonzero(np.concatenate([[True], sparse[1:] != sparse[:-1]]))
        out_keys.append(sparse[first])
        if counts is None:
            out_counts.append(np.diff(np.append(first, len(sparse))))
        else:
            out_counts.append(np.add.reduceat(counts[rest][order], first))
    if not out_keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(out_keys), np.concatenate(out_counts)
    order = np.argsort(all_keys)
    return all_keys[order], all_counts[order]


def _pair_rows(chunk: int, left: np.ndarray, right: np.ndarray, side: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a chunk (both ids 0 or more), counted, one row per unit."""
    unit, key = _units(left, right, side)
    order = np.argsort(unit, kind="stable")
    unit, key = unit[order], key[order]
    edges = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]])) if len(unit) else []
    rows = []
    for low, high in itertools.pairwise(edges):
        keys, counts = count_keys(key[low:high])
        rows.append((chunk, int(unit[low]), _packed_keys(keys), _packed(counts)))
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    chunk, unit, keys, counts = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(unit, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
        ["chunk", "unit", "keys", "counts"],
    )


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, in as many byte planes as the greatest needs; the first byte says how many."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def _unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    data = np.frombuffer(data, np.uint8)
    planes = data[1:].reshape(int(data[0]), -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<i8").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order: the steps between rows, then the columns."""
    rows = _packed(np.diff(keys >> 32, prepend=0))
    return len(rows).to_bytes(8, "little") + rows + _packed(keys & 0xFFFFFFFF)


def _unpacked_keys(data: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(data[:8], "little")
    return np.cumsum(_unpacked(data[8:end])) << 32 | _unpacked(data[end:])


LEFT = -1  # the unit number of the row that holds a chunk's own ids, each plus 1; 0 for none


def _pairs_at(left: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """Places where a frequent phrase of k words starts, one starts at the next word too, and no break lies between.

    Breaks and rare words have no id, so a phrase that starts at a place has none inside.
    """
    n = len(words) - k
    if n <= 0:
        return np.zeros(0, np.int64)
    good = (left[:n] >= 0) & (words[k:] >= 0)
    if k > 1:
        good &= left[1 : n + 1] >= 0
    return np.flatnonzero(good)


def first_pairs(chunks: DataFrame, ids: DataFrame, side: int) -> DataFrame:
    """Pairs of neighbouring words per chunk and unit, and the chunk's word ids under unit LEFT.

    `ids` has (chunk, pairs of place and id) of the frequent words of each chunk's dictionary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, size = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                number = np.full(size, -1, np.int64)
                found = batch.column(3)[i].values
                if found is not None and len(found):
                    number[found.field(0).to_numpy()] = found.field(1).to_numpy()
                words = number[_unpacked(batch.column(2)[i].as_buffer())]
                yield _batch([(chunk, LEFT, _packed(words + 1), b"")])
                at = _pairs_at(words, words, 1)
                yield from _pair_rows(chunk, words[at], words[at + 1], side)

    rows = chunks.select("chunk", F.size("words").alias("size"), "places").join(ids, "chunk", "left")
    return rows.mapInArrow(run, PAIRS)


def next_pairs(pairs: DataFrame, answers: DataFrame, words: DataFrame, k: int, side: int) -> DataFrame:
    """Pairs of a phrase of k words and the next word, from the answers for the chunks' pairs of the level before.

    `pairs` of the level before has each chunk's ids of phrases of k - 1 words under LEFT; `words` those of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch.column(0)[i].as_py()
                left, word = (_unpacked(batch.column(c)[i].as_buffer()) - 1 for c in (1, 2))
                here = _pairs_at(left, word, k - 1)
                unit, key = _units(left[here], word[here + k - 1], side)
                new = np.full(len(here), -1, np.int64)
                order = np.argsort(unit, kind="stable")
                edges = np.searchsorted(unit[order], np.arange(side * side + 1))
                for answer in batch.column(3)[i].values or ():
                    keys, ids = _unpacked_keys(answer["keys"].as_py()), _unpacked(answer["ids"].as_py())
                    u = answer["unit"].as_py()
                    mine = order[edges[u] : edges[u + 1]]
                    place = np.minimum(np.searchsorted(keys, key[mine]), len(keys) - 1)
                    new[mine] = np.where(keys[place] == key[mine], ids[place], -1)
                phrase = np.full(len(word), -1, np.int64)
                phrase[here] = new
                yield _batch([(chunk, LEFT, _packed(phrase + 1), b"")])
                at = _pairs_at(phrase, word, k)
                yield from _pair_rows(chunk, phrase[at], word[at + k], side)

    per_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("unit", "keys", "ids")).alias("answers"))
    lefts = pairs.where(F.col("unit") == LEFT).select("chunk", F.col("keys").alias("ids"))
    rows = lefts.join(words.select("chunk", F.col("ids").alias("words")), "chunk").join(per_chunk, "chunk")
    return rows.select("chunk", "ids", "words", "answers").mapInArrow(run, PAIRS)


def frequent_pairs(pairs: DataFrame, least: int, side: int) -> DataFrame:
    """(left_id, right_id, count) of the pairs with `least` occurrences or more, from the chunks' rows by unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, keys, counts, n, most = None, [], [], 0, 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            return count_keys(np.concatenate(keys), np.concatenate(counts))

        def result() -> pa.RecordBatch:
            key, count = merge()
            key, count = key[count >= least], count[count >= least]
            columns = [(key >> 32) * side + unit // side, (key & 0xFFFFFFFF) * side + unit % side, count]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["left_id", "right_id", "count"])

        for batch in batches:
            for u, k, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if u != unit:
                    if keys:
                        yield result()
                    unit, keys, counts, n, most = u, [], [], 0, MERGE_PAIRS
                keys.append(_unpacked_keys(k))
                counts.append(_unpacked(c))
                n += len(counts[-1])
                if n > most:  # rows of many chunks are added up on the way
                    key, count = merge()
                    keys, counts, n, most = [key], [count], len(key), max(MERGE_PAIRS, 2 * len(key))
        if keys:
            yield result()

    rows = pairs.where(F.col("unit") >= 0).select("unit", "keys", "counts")
    sent = rows.repartition("unit").sortWithinPartitions("unit")
    return sent.mapInArrow(run, "left_id long, right_id long, count long")


def answered(pairs: DataFrame, numbered: DataFrame, side: int) -> DataFrame:
    """(chunk, unit, keys, ids): to each row of a chunk the frequent ones of its pairs, with their ids.

    The numbered pairs of a unit go before the rows of the chunks, so a task holds one unit's pairs and a batch of rows.
    """
    schema = "chunk long, unit int, keys binary, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, known, ids = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                u, chunk = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if u != unit:
                    unit, known, ids = u, np.zeros(0, np.int64), np.zeros(0, np.int64)
                if chunk is None:
                    found = batch.column(3)[i].values
                    known, ids = found.field(0).to_numpy(), found.field(1).to_numpy()
                    order = np.argsort(known)
                    known, ids = known[order], ids[order]
                elif len(known):
                    keys = _unpacked_keys(batch.column(2)[i].as_py())
                    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    here = known[place] == keys
                    if here.any():
                        out.append((chunk, u, _packed_keys(keys[here]), _packed(ids[place[here]])))
            yield _batch(out).rename_columns(["chunk", "unit", "keys", "ids"])

    unit = (F.col("left_id") % side * side + F.col("right_id") % side).cast("int").alias("unit")
    key = F.shiftleft(F.expr(f"left_id div {side}"), 32).bitwiseOR(F.expr(f"right_id div {side}")).alias("key")
    tables = numbered.select(unit, F.struct(key, F.col("id")).alias("pair")).groupBy("unit").agg(
        F.collect_list("pair").alias("known")
    )
    tables = tables.select("unit", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("keys"), "known")
    asked = pairs.where(F.col("unit") >= 0).select(
        "unit", "chunk", "keys", F.lit(None).cast("array<struct<key:long,id:long>>").alias("known")
    )
    sent = tables.unionByName(asked).repartition("unit")
    return sent.sortWithinPartitions("unit", F.col("chunk").asc_nulls_first()).mapInArrow(run, schema)


def numbered_by_frequency(df: DataFrame, order: list[str]) -> DataFrame:
    """Add `id`, 0, 1, 2, ... by falling `count`, then by the other columns."""
    ranked = with_dense_key(df.withColumn("_minus", -F.col("count")), ["_minus", *order], "_id")
    return ranked.select(*df.columns, (F.col("_id") - 1).alias("id"))


@contextmanager
def small_batches(spark: SparkSession):
    """Rows of several MB pass to Python a few at a time."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4,
    chunk_words: int = CHUNK_WORDS, unit_pairs: int = UNIT_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): the phrases of 1 to `longest` words that occur `least` times or more, and words per language.

    phrases has (lang, words, f): the words as an array, and the number of contiguous occurrences within pieces of the
    language's texts, overlaps included. totals has (lang, n). Languages are told apart; a null one is `und`, a null
    text is empty. Other columns are not used.
    """
    with small_batches(docs.sparkSession):
        return _phrases(docs, text_col, lang_col, least, longest, chunk_words, unit_pairs)


def _phrases(
    docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int, chunk_words: int, unit_pairs: int
) -> tuple[DataFrame, DataFrame]:
    chunks = freeze(chunks_of(docs, text_col, lang_col, chunk_words), "chunks")
    listed = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    listed = listed.select("chunk", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n")).where("n > 0")
    all_words = listed.groupBy("lang", "word").agg(F.sum("n").alias("count"))
    totals = freeze(listed.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    side = math.isqrt(max(int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) - 1, 0) // unit_pairs) + 1
    words = freeze(numbered_by_frequency(all_words.where(F.col("count") >= least), ["lang", "word"]), "words")
    ids = listed.select("chunk", "lang", "word", "place").join(words.select("lang", "word", "id"), ["lang", "word"])
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("ids"))
    pairs = freeze(first_pairs(chunks, ids, side), "pairs")
    chunk_words_ids = pairs.where(F.col("unit") == LEFT).select("chunk", F.col("keys").alias("ids"))
    text = F.decode("word", "UTF-8")
    named = words.select("id", "lang", text.alias("word"))
    found = words.select("id", "lang", F.array(text).alias("words"), F.col("count").alias("f"))
    all_found = [found]
    for k in range(2, longest + 1):
        counted = frequent_pairs(pairs, least, side)
        numbered = freeze(numbered_by_frequency(counted, ["left_id", "right_id"]), f"numbered-{k}")
        right = named.select(F.col("id").alias("right_id"), "word")
        left = found.select(F.col("id").alias("left_id"), "lang", "words")
        found = numbered.join(left, "left_id").join(right, "right_id").select(
            "id", "lang", F.concat("words", F.array("word")).alias("words"), F.col("count").alias("f")
        )
        found = freeze(found, f"phrases-{k}")
        all_found.append(found)
        if k < longest:
            answers = answered(pairs, numbered, side)
            pairs = freeze(next_pairs(pairs, answers, chunk_words_ids, k, side), f"pairs-{k}")
    out = all_found[0]
    for f in all_found[1:]:
        out = out.unionByName(f)
    return out.select("lang", "words", "f"), totals


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4,
    scale: int = 2_000_000, covered_percent: int = 80, chunk_words: int = CHUNK_WORDS, unit_pairs: int = UNIT_PAIRS,
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): all phrases of 2 to `longest` words with a = f(phrase) >= `least`.

    Cut after its first words into parts with l and r occurrences a phrase scores floor(scale * a / (l + r)); its
    least-scoring cut counts, the earliest of equal ones. A phrase goes whose words lie contiguously in a longer one
    with covered_percent or more of its occurrences. n is the number of all words of the language. Numbers are exact:
    products are decimals of 38 digits.

    Nulls: a null text is empty, a null language is `und`. Empty texts and tables give nothing. Repeated rows count
    each. Texts of any length are worked through in chunks. Other columns are not read.
    """
    known, totals = phrases(docs, text_col, lang_col, least, longest, chunk_words, unit_pairs)
    longer = known.where(F.size("words") > 1)
    cuts = longer.select("lang", "words", "f", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "*", F.slice("words", F.lit(1), F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    part = known.select("lang", F.col("words").alias("part"), F.col("f").alias("part_f"))
    for side, out in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.withColumnsRenamed({"part": side, "part_f": out}), ["lang", side])
    score = F.expr(f"cast({scale} as decimal(18,0)) * cast(f as decimal(19,0)) div cast(l + r as decimal(20,0))")
    best = cuts.select("*", score.alias("score")).groupBy("lang", "words").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("f").alias("a")
    )
    # A longer phrase holds its parts of 2 words or more; each part needs its most frequent holder only.
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda at: F.slice("words", at, size)),
    ))
    holders = longer.where(F.size("words") > 2).select("lang", F.explode(F.array_distinct(spans)).alias("words"), "f")
    held = holders.groupBy("lang", "words").agg(F.max("f").alias("held"))
    kept = best.join(held, ["lang", "words"], "left").where(
        f"held is null or cast(100 as decimal(18,0)) * cast(held as decimal(19,0)) < cast({covered_percent} as decimal(18,0)) * cast(a as decimal(19,0))"
    )
    return kept.join(totals, "lang").select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"
    )


def top_per_language(found: DataFrame, most: int) -> DataFrame:
    """The `most` best of each language with their rank: by score, then occurrences, then the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# The production parameters in DuckDB SQL.
SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS size FROM worded),
listed AS (
  SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
  FROM sized WHERE len(w) >= size),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM listed GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f FROM counted WHERE size > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.w, c.k, c.f AS a, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, f, size, w, unnest([{'at': i, 'm': m} FOR i IN range(1, size)]) AS p
  FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates WHERE size > 2)),
held AS (
  SELECT lang, array_to_string(w[p['at'] : p['at'] + p['m'] - 1], ' ') AS phrase, max(f) AS f
  FROM parts WHERE p['at'] + p['m'] - 1 <= size GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE h.f IS NULL OR 100::HUGEINT * h.f < 80::HUGEINT * b.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    CAST(score AS BIGINT) AS score FROM kept)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
"""
