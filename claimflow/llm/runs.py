"""Periodic runs of words by Lyndon roots: stretches that repeat themselves, and texts collapsed to one period of each.

A run with period q is a maximal stretch of words in which words q apart are equal. The steps, in the tasks that read
the texts (nothing is shuffled):

1. Reduction, exact. In a run of at least `times` periods every three neighbouring words occur `times - 1` times or
   more. Stretches in which each three words do (counted per stretch by hash, so that a collision can only keep more)
   are cut out until nothing shrinks. No run is lost or cut, since all its threes lie in it.
2. Lyndon arrays. The first phase of a two-phase suffix sorter groups suffixes by their longest Lyndon prefix: groups
   are taken from the greatest to the least, and the positions just before a group's members, by how many members
   follow, move to new groups whose prefix is longer by as many copies of the group's. The prefix lengths are the
   Lyndon array. It is built under an order of the words and under the reverse order.
3. Every run has a Lyndon root in one of the two arrays. Roots are extended to both sides by longest common
   extensions, from names of all substrings of 2^k words, and equal results are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.tokens import Words, word_batches

RUN = "struct<start:long,length:long,period:long>"
SPACE = r"[\x20\x09-\x0D]+"


def _stretches(good: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the stretches of at least `least` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
    first, last = edges[::2], edges[1::2]
    long_enough = last - first >= least
    return first[long_enough], last[long_enough]


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    size = last - first
    return np.arange(size.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)


def repetitive_pieces(hashes: np.ndarray, text: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, piece): the words that can be in a run, in pieces that hold each such run as a whole.

    With period 1 a run has `least - 2` threes or more, all equal; with period q > 1 each residue has `times - 1`.
    """
    need = min(max(least, times) - 2, times - 1)
    word, piece = np.arange(len(hashes)), text
    rng = np.random.default_rng(1)
    while need > 1 and len(word) >= least:
        a, b, c, d = rng.integers(0, 1 << 63, 4, np.uint64) * np.uint64(2) + np.uint64(1)
        h = hashes[word]
        mixed = (h[:-2] * a + h[1:-1]) * b + h[2:]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * c + piece[:-2].astype(np.uint64) * d
        bits = max(int(len(word)).bit_length() + 2, 8)
        slot = ((mixed ^ (mixed >> np.uint64(32))) * d >> np.uint64(64 - bits)).astype(np.int64)
        whole = piece[:-2] == piece[2:]
        counts = np.bincount(slot[whole], minlength=1 << bits)
        good = whole & (counts[slot] >= need)
        # Windows of two pieces never touch: the two that reach over the border are not whole.
        first, last = _stretches(good, least - 2)
        kept = _ranges(first, last + 2)
        if len(kept) == len(word):
            break
        word, piece = word[kept], np.repeat(np.arange(len(first)), last + 2 - first)
    return word, piece


def lyndon_array(symbols: np.ndarray, n_symbols: int, n_ends: int = 0) -> np.ndarray:
    """Length of the longest Lyndon word starting at each place; symbols are numbered by their order.

    The first `n_ends` symbols end a text: they are less than all others, and their own places get 0.
    """
    n = len(symbols)
    group = [0, *symbols.tolist()]  # places from 1; place 0 stands for nothing before
    members: list[list[int]] = [[] for _ in range(n_symbols)]
    for place in range(1, n + 1):
        members[group[place]].append(place)
    size = [1] * n_symbols
    below, above = list(range(-1, n_symbols - 1)), list(range(1, n_symbols + 1))
    near = list(range(n + 1))  # the nearest place at or before this one whose group is still to come
    out = [0] * (n + 1)
    here = n_symbols - 1
    while here >= n_ends:
        mine = [i for i in members[here] if group[i] == here]
        members[here] = []
        length = size[here]
        for i in mine:
            near[i] = i - 1
            out[i] = length
        moves: dict[int, dict[int, list[int]]] = {}
        last, times = 0, 0

        def move() -> None:
            if last and group[last] >= n_ends:
                moves.setdefault(group[last], {}).setdefault(times, []).append(last)

        for i in mine:  # ascending, so equal places before come one after the other
            j = i - 1
            while near[j] != j:
                near[j] = near[near[j]]
                j = near[j]
            near[i] = j
            if j == last:
                times += 1
            else:
                move()
                last, times = j, 1
        move()
        for old, by_times in moves.items():
            under = old
            for times in sorted(by_times):
                new = len(size)
                size.append(size[old] + times * length)
                members.append(by_times[times])
                for i in by_times[times]:
                    group[i] = new
                over = above[under]
                below.append(under)
                above.append(over)
                above[under] = new
                if over < len(below):
                    below[over] = new
                under = new
        here = below[here]
    return np.array(out[1:], np.int64)


def substring_names(symbols: np.ndarray) -> list[np.ndarray]:
    """Per level k, a number for the 2^k symbols from each place on, equal for equal ones; up to where all differ."""
    names = [symbols.astype(np.int64)]
    step = 1
    while 2 * step <= len(symbols):
        low = names[-1]
        width = int(low.max()) + 1
        seen, name = np.unique(low[: len(low) - step] * width + low[step:], return_inverse=True)
        if len(seen) == len(name):
            break
        names.append(name)
        step *= 2
    return names


def common_extension(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """Number of equal symbols from places a and b on (a < b), or just before them."""
    n, total = len(names[0]), np.zeros(len(a), np.int64)
    for level in range(len(names) - 1, -1, -1):
        step, name = 1 << level, names[level]
        x, y = (a + total, b + total) if forward else (a - total - step, b - total - step)
        fits = (y + step <= n) if forward else (x >= 0)
        top = len(name) - 1
        total += step * (fits & (name[np.clip(x, 0, top)] == name[np.clip(y, 0, top)]))
    return total


def runs_of(symbols: np.ndarray, n_symbols: int, n_ends: int, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of at least `least` symbols and `times` periods."""
    n_words = n_symbols - n_ends
    turned = np.where(symbols < n_ends, symbols, 2 * n_ends + n_words - 1 - symbols)
    roots = []
    for order in (symbols, turned):
        length = lyndon_array(order, n_symbols, n_ends)
        roots.append(np.stack([np.flatnonzero(length), length[length > 0]], 1))
    start, period = np.unique(np.concatenate(roots), axis=0).T
    names = substring_names(symbols)
    left = common_extension(names, start, start + period, forward=False)
    right = common_extension(names, start, start + period, forward=True)
    length = left + period + right
    found = np.stack([start - left, length, period], 1)
    return np.unique(found[length >= np.maximum(least, times * period)], axis=0)


def runs_of_words(words: Words, least: int, times: int) -> np.ndarray:
    """Rows (number of the first word among all, length, period)."""
    word, piece = repetitive_pieces(words.hashes, words.of_text(), least, times)
    if not len(word):
        return np.zeros((0, 3), np.int64)
    relabelled = np.cumsum(np.concatenate([[0], piece[1:] != piece[:-1]]))
    n_ends = int(relabelled[-1]) + 1
    data = words.data.tobytes()
    number: dict[bytes, int] = {}
    ids = [number.setdefault(data[s:e], len(number)) for s, e in zip(words.starts[word].tolist(), words.ends[word].tolist())]
    # An end of its own after each piece: 0, 1, 2, ...; then the words.
    place = np.arange(len(word)) + relabelled
    symbols = np.empty(len(word) + n_ends, np.int64)
    first = np.concatenate([[True], piece[1:] != piece[:-1]])
    symbols[np.concatenate([place[first][1:] - 1, [len(symbols) - 1]])] = np.arange(n_ends)
    symbols[place] = np.array(ids, np.int64) + n_ends
    source = np.full(len(symbols), -1, np.int64)
    source[place] = word
    found = runs_of(symbols, n_ends + len(number), n_ends, least, times)
    return np.stack([source[found[:, 0]], found[:, 1], found[:, 2]], 1)


def _collapsed(words: Words, kept: np.ndarray, first_words: np.ndarray) -> pa.Array:
    """Per text the kept words, joined by one space."""
    data, n = words.data.copy(), len(words.data)
    inside = np.zeros(n + 1, np.int32)
    starts, ends = words.starts[kept], words.ends[kept]
    inside[starts] += 1
    inside[ends] -= 1
    mask = np.cumsum(inside[:n]) > 0
    text = np.searchsorted(first_words, np.flatnonzero(kept), "right") - 1
    gaps = ends[:-1][text[1:] == text[:-1]]  # the byte after a word that another kept word of its text follows
    data[gaps], mask[gaps] = 0x20, True
    sizes = np.concatenate([[0], np.cumsum(mask)])
    offsets = sizes[words.texts].astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[mask].tobytes()))
    return out.cast(pa.string())


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text by start and period, and the text without repetitions.

    A run has at least `least` (3 or more) words and `times` (2 or more) periods. A word is left out of `collapsed` if
    any run contains it after that run's first period; the others are joined by one space.

    Null and empty texts have no words, no runs and an empty collapsed text. A null id stays null; repeated rows and
    equal ids each give their own row; an empty table gives none. Other columns are not passed on, so their names do
    not matter. A long text is worked on in one piece, with memory in proportion to it.
    """
    if least < 3 or times < 2:
        raise ValueError("runs need at least 3 words and 2 periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_batches(batch.column(1)):
                found = runs_of_words(words, least, times)
                first_words = words.first_words()
                text = np.searchsorted(first_words, found[:, 0], "right") - 1
                order = np.lexsort((found[:, 2], found[:, 0]))
                found, text = found[order], text[order]
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, found[:, 0] + found[:, 2], 1)
                np.add.at(change, found[:, 0] + found[:, 1], -1)
                kept = np.cumsum(change[:-1]) == 0
                fields = [found[:, 0] - first_words[text], found[:, 1], found[:, 2]]
                runs = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "length", "period"])
                offsets = np.searchsorted(text, np.arange(high - low + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), pa.array(np.diff(first_words)),
                        pa.ListArray.from_arrays(pa.array(offsets), runs), _collapsed(words, kept, first_words),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in the texts of a tenth of the ids, by the crc32 of the id, the words from some word on repeat.

    With h = crc32(id) and g = h div 10, where h % 10 = 0, word i >= a = g % n becomes word a + (i - a) % p, with
    p = 1 + (n - a) div (3 + g % 8). Other texts, and those of null ids, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    words = F.when(chosen, F.array_remove(F.split("text", SPACE), ""))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words").cast("long")
    rows = rows.select("*", n.alias("n"), F.when(F.col("words").isNotNull(), F.col("g") % n).alias("a"))
    period = (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("long")

    def source(i: Column) -> Column:
        back = F.col("a") + (i - F.col("a")) % F.col("p")
        return F.get("words", F.when(i < F.col("a"), i).otherwise(back).cast("int"))

    rows = rows.select("*", period.alias("p"))
    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), source), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest run, and sha256 of all runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus_length"), r["start"].alias("start"), r["period"].alias("period")
    )))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select("*", longest.alias("longest")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.minus_length")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("1000 * -longest.minus_length div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
