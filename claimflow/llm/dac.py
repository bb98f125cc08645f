"""Token ids as directly addressable codes: any token is read without decoding a block.

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of every token; level l+1 holds the next
chunk of those tokens alone whose continuation bit is set at level l. A rank directory (set bits before each 512)
turns a position at one level into the position at the next, so a token costs one step per chunk.

One segment is one file image, written as a row of a Parquet table, which any store that Spark writes to can hold:

    magic "DAC1" | u32 documents | u64 tokens | u32 levels
    document ids (i64 each) | is-null bytes | end of each document (u64 each)
    per level: u64 entries | chunks (u8 each) | continuation bits | u64 ranks | ranks (u32 each)

All numbers are little-endian.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimflow.llm.tokens import PORTION, Encoder, in_portions

MAGIC, WIDTH, RANK_EVERY = b"DAC1", 8, 512


def encode(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    """File image of the documents' token ids; `ends` has the end of each document among them."""
    levels, left = [], np.asarray(ids, np.uint32)
    while len(left) or not levels:
        more = left >= (1 << WIDTH)
        bits = np.packbits(more, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_EVERY)))]) if len(
            more
        ) else np.zeros(1)
        ranks = ones.astype("<u4").tobytes()
        levels.append(
            struct.pack("<Q", len(left)) + (left & 0xFF).astype(np.uint8).tobytes() + bits.tobytes()
            + struct.pack("<Q", len(ones)) + ranks
        )
        left = left[more] >> np.uint32(WIDTH)
    nulls = bytes(d is None for d in doc_ids)
    return b"".join([
        MAGIC, struct.pack("<IQI", len(doc_ids), len(ids), len(levels)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), nulls, np.asarray(ends, "<u8").tobytes(), *levels,
    ])


class Reader:
    """Random access to a file image."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a DAC1 image")
        docs, self.n_tokens, n_levels = struct.unpack_from("<IQI", image, 4)
        at = 4 + struct.calcsize("<IQI")
        ids = np.frombuffer(image, "<i8", docs, at)
        nulls = np.frombuffer(image, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [None if null else int(i) for i, null in zip(ids, nulls)]
        self.ends = np.frombuffer(image, "<u8", docs, at + 9 * docs)
        at += 17 * docs
        self.levels = []
        for _ in range(n_levels):
            n = struct.unpack_from("<Q", image, at)[0]
            chunks = np.frombuffer(image, np.uint8, n, at + 8)
            bits = np.frombuffer(image, np.uint8, (n + 7) // 8, at + 8 + n)
            at += 8 + n + len(bits)
            r = struct.unpack_from("<Q", image, at)[0]
            self.levels.append((chunks, bits, np.frombuffer(image, "<u4", r, at + 8)))
            at += 8 + 4 * r

    def _rank(self, level: int, i: int) -> int:
        """Set continuation bits before position i."""
        _, bits, ranks = self.levels[level]
        block = i // RANK_EVERY
        return int(ranks[block]) + int(self._bits(bits, block * RANK_EVERY, i).sum())

    @staticmethod
    def _bits(bits: np.ndarray, start: int, end: int) -> np.ndarray:
        part = np.unpackbits(bits[start // 8 : (end + 7) // 8], bitorder="little")
        return part[start % 8 : start % 8 + end - start]

    def token(self, i: int) -> int:
        """Token i."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, level = 0, 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << (WIDTH * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i, level = self._rank(level, i), level + 1

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Tokens start to end; at each level they lie together."""
        out = np.zeros(end - start, np.uint32)
        where = np.arange(end - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(WIDTH * level)
            more = self._bits(bits, start, end).astype(bool)
            where = where[more]
            if not len(where):
                break
            start = self._rank(level, start)
            end = start + len(where)
        return out


def write_dac(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_tokens: int = 1 << 20, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the token ids of all documents, in ascending order of `id_col`, as a table of segments at `path`.

    Null text counts as empty, so it has the end id alone. Null ids come first. Documents with one id are ordered by
    a hash of their text; those are the same in any order when the text is the same too. Other columns are not read.
    A document is never split over segments. Of an empty table an empty table is written.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder.shared(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()

        def coded():
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for some in in_portions(rows, lambda r: len(r[1] or ""), PORTION):
                    for (doc, _), ids in zip(some, encoder.encode([t for _, t in some])):
                        yield doc, ids + end

        for some in in_portions(coded(), lambda r: len(r[1]) // 4, segment_tokens):
            ends = np.cumsum([len(ids) // 4 for _, ids in some])
            image = encode(np.frombuffer(b"".join(ids for _, ids in some), "<u4"), [d for d, _ in some], ends)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([number], pa.int32()),
                "n_tokens": pa.array([int(ends[-1])], pa.int64()), "image": pa.array([image], pa.large_binary()),
            })
            number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(segments, "part int, segment int, n_tokens long, image binary").write.parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, segment, start): tokens before each segment. Sums per part first, so no task orders all segments."""
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    inside = segments.select("part", "segment", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("inside"))
    return inside.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inside")).alias("start"))


def read_dac(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a table of segments: (part, segment, doc_id, start_in_segment, n_tokens, ids)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, start, out = Reader(row["image"]), 0, []
                for doc, end in zip(reader.doc_ids, reader.ends.tolist()):
                    ids = reader.tokens(start, end).astype("<u4").tobytes()
                    out.append((row["part"], row["segment"], doc, start, end - start, ids))
                    start = end
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary())
                names = ("part", "segment", "doc_id", "start_in_segment", "n_tokens", "ids")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], list(names))

    return spark.read.parquet(path).select("part", "segment", "image").mapInArrow(
        documents, "part int, segment int, doc_id long, start_in_segment long, n_tokens long, ids binary"
    )
