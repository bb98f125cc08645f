"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

A document longer than the capacity is cut into full pieces, the first of which may be shorter; nothing else is cut.
What is left to pack are lengths below the capacity, so the plan needs only how often each length occurs: at most
`capacity` numbers, at any size of the input. Lengths above a third of the capacity are matched greedily, the longest
first with the longest partner that fits, at most two in a sequence. The shorter ones follow, longest first, each into
the smallest gap that holds it. The plan lists, per length, which run of its pieces goes where; every piece then finds
its place by its length and its number among the pieces of that length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimflow.llm.tokens import PIECES, PORTION, Encoder, in_portions
from claimflow.session import freeze

RUN = "length int, low long, high long, per_sequence long, sequence long, offset int"


@dataclass(frozen=True)
class Run:
    """Pieces low..high-1 of one length: `per_sequence` of them side by side from `offset` in each sequence in turn."""

    length: int
    low: int
    high: int
    per_sequence: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """Where the pieces of each length go, from how many there are of each length (1 to capacity)."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    left, used, runs, sequences = Counter(counts), Counter(), [], 0
    gaps: list[int] = []  # sorted
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, how many)

    def place(length: int, n: int, per: int, first: int, offset: int) -> None:
        runs.append(Run(length, used[length], used[length] + n, per, first, offset))
        used[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in open_bins:
                insort(gaps, gap)
            open_bins[gap].append((first, n))

    def take(gap: int) -> tuple[int, int]:
        found = open_bins[gap].pop()
        if not open_bins[gap]:
            del open_bins[gap]
            gaps.remove(gap)
        return found

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        partners = [b for b in large[: bisect_left(large, capacity - a + 1)] if left[b] > (b == a)]
        b = partners[-1] if partners else 0
        n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
        if a == b:
            place(a, 2 * n, 2, sequences, 0)
        else:
            place(a, n, 1, sequences, 0)
            if b:
                place(b, n, 1, sequences, a)
        leave(capacity - a - b, sequences, n)
        sequences += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while n := left[length]:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                first, bins = take(gap)
            else:
                gap, first = capacity, sequences
                bins = -(-n // (capacity // length))
                sequences += bins
            per = gap // length
            full = min(bins, n // per)
            if full:
                place(length, full * per, per, first, capacity - gap)
                leave(gap - per * length, first, full)
            rest = min(left[length], per) if full < bins else 0
            if rest:
                place(length, rest, rest, first + full, capacity - gap)
                leave(gap - rest * length, first + full, 1)
                full += 1
            leave(gap, first + full, bins - full)
    return runs


def pieces_of(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = PIECES,
) -> DataFrame:
    """Tokenize, append the end id, cut: (doc_id, piece, start, length, ids, part, nth).

    Null text counts as empty. `nth` numbers the pieces of one length within one task (`part`), from 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = Encoder.shared(tokenizer, remembered), TaskContext.get().partitionId(), Counter()
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for some in in_portions(rows, lambda r: len(r[1] or ""), PORTION):
                out = []
                for (doc, _), ids in zip(some, encoder.encode([t for _, t in some])):
                    ids += end
                    n = len(ids) // 4
                    start = 0
                    stop = n % capacity or capacity
                    number = 0
                    while start < n:
                        length = stop - start
                        out.append((doc, number, start, length, ids[4 * start : 4 * stop], part, seen[length]))
                        seen[length] += 1
                        start, stop, number = stop, stop + capacity, number + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.large_binary(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids", "part", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
    )


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces (length, part, nth).

    Only the counts per length reach the driver, `capacity` numbers at most; only the plan is broadcast, a few runs
    per length. A piece's number among all of its length is its number in its task plus those of the tasks before.
    """
    spark = pieces.sparkSession
    per_task = pieces.groupBy("length", "part").count()
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = [(r.length, r.low, r.high, r.per_sequence, r.sequence, r.offset) for r in plan(counts, capacity)]
    runs = spark.createDataFrame(runs, RUN).groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("low", "high", "per_sequence", "sequence", "offset"))).alias("runs")
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    numbered = pieces.join(firsts, ["length", "part"]).withColumn("nth", F.col("first") + F.col("nth"))
    at = F.filter("runs", lambda r: (r["low"] <= F.col("nth")) & (F.col("nth") < r["high"]))[0]
    placed = numbered.join(F.broadcast(runs), "length").withColumn("run", at)
    nth = F.col("nth") - F.col("run.low")
    return placed.select(
        *[c for c in pieces.columns if c not in ("part", "nth")],
        (F.col("run.sequence") + F.floor(nth / F.col("run.per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("run.offset") + nth % F.col("run.per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = PIECES,
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset).

    Defined for: null text (empty: the end id alone), null or repeated ids (rows are pieces of their own), texts of any
    length, an empty table (no rows), other columns (not read). Pieces of one length are interchangeable; which takes
    which place follows the order of the input's tasks, so the pieces are stored once before they are placed. A worker
    remembers the ids of about `remembered` pieces of text, which saves time and changes nothing else.
    """
    pieces = pieces_of(docs, tokenizer, end_id, capacity, id_col, text_col, remembered)
    return place_pieces(freeze(pieces.withColumn("ids_crc32", F.crc32("ids")), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: (sequence_id, ids), its pieces' ids in order of offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.transform(parts, lambda p: p["ids"]).alias("parts"))
    return joined.select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p)).alias("ids")
    )
