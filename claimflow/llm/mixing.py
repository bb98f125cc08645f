"""Mixing sources to target weights by blocks of a fixed number of words.

Every source is one stream of words: its documents one after the other, in a pseudorandom order. The stream is cut
into blocks of `block_words`. The mix is a list of slots, dealt to output shards, each of which takes one block:

1. Targets: each source's share of all words by its weight, at most `most` times its own words; what that leaves over
   goes to the others by weight until none is above.
2. Slots of a source: as many as its blocks need to hold its target, in whole words; the last one takes a part of its
   block. Shards draw how many of their slots each source gets, as multinomial counts given those totals, so that every
   source meets its target to the word.
3. A source's slots are numbered over the shards. Slot j takes block perm(j mod blocks) of pass j div blocks, by
   another keyed permutation in each pass. So every block is taken once in each full pass, and at most `most` times.
4. Slots meet the pieces of documents that make up their block in one join on source and block number.

Only one row per source reaches the driver. All draws follow from the seed, so a rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimflow.llm.names import free_names
from claimflow.llm.tokens import word_batches

WORDS = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 4096  # documents that one window orders
CHUNK_SLOTS = 1 << 16  # slots that one row of the plan stands for
MOST_BROADCAST = 8 << 20  # bytes of the table of sources beyond which it is joined by a shuffle
SAMPLER_ENDS = 10**9  # slots from which on the library's sampler is not defined


@dataclass(frozen=True)
class Source:
    """`number` is the place in code point order, null last."""

    number: int
    name: str | None
    size: int
    docs: int
    target: float


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of the total by weight; what is above `most` times a size is dealt to the others until none is above."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        if not total:
            break
        over = {i for i in free if left * weights[i] / total > most * sizes[i]}
        if not over:
            for i in free:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        free -= over
    return targets


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 applied to `index`: four Feistel rounds, walked until the value is below n.

    `back` undoes it.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def mixed(x: np.ndarray, r: int) -> np.ndarray:
        f = x + np.uint64((key + r * 0x9E3779B97F4A7C15) % (1 << 64))
        f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (f ^ (f >> np.uint64(31))) & mask

    def rounds(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in (3, 2, 1, 0) if back else (0, 1, 2, 3):
            left, right = (right ^ mixed(left, r), left) if back else (right, left ^ mixed(right, r))
        return (left << np.uint64(half)) | right

    out = rounds(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= n)):
        out[outside] = rounds(out[outside])
    return out.astype(np.int64)


def shard_draws(totals: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots per shard and source: multinomial draws given the sources' totals; shards differ by one slot at most."""
    rng, left = np.random.default_rng(seed), np.array(totals, np.int64)
    out = np.zeros((shards, len(totals)), np.int64)
    for shard in range(shards):
        take = -(-int(left.sum()) // (shards - shard))
        rest, want = int(left.sum()), take
        for i, here in enumerate(left.tolist()):  # one source after the other, each hypergeometric
            rest -= here
            out[shard, i] = drawn(rng, here, rest, want)
            want -= out[shard, i]
        left -= out[shard]
    return out


def drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n slots drawn without return from good + bad are good."""
    if not n or not good:
        return 0
    if not bad:
        return n
    if good + bad < SAMPLER_ENDS:
        return int(rng.hypergeometric(good, bad, n))
    # The same law by its ratios from the most likely count outwards; beyond 12 deviations is less than a double can tell.
    total = good + bad
    likely = (n + 1) * (good + 1) // (total + 2)
    deviation = (n * (good / total) * (bad / total) * (total - n) / (total - 1)) ** 0.5
    reach = int(12 * deviation) + 50
    low, high = max(0, n - bad, likely - reach), min(good, n, likely + reach)
    k = np.arange(low, high, dtype=np.float64)
    logs = np.cumsum(np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1)))
    logs = np.concatenate([[0.0], logs])
    reached = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(reached, rng.random() * reached[-1], side="right"))


def sources_of(sized: DataFrame, weight: Callable[[int, str | None], float], most: float) -> list[Source]:
    """One entry per source, with its target."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    weights = [weight(i, r["source"]) for i, r in enumerate(rows)]
    targets = capped_targets([r["size"] for r in rows], weights, most)
    return [Source(i, r["source"], r["size"], r["docs"], t) for i, (r, t) in enumerate(zip(rows, targets))]


def source_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    rows = [(s.number, s.name, s.size, s.target, max(1, -(-s.docs // BUCKET_DOCS))) for s in sources]
    return spark.createDataFrame(
        rows, "source_number int, source string, source_size long, target double, buckets long"
    )


def streams(sized: DataFrame, sources: list[Source], seed: int) -> DataFrame:
    """Add to each document its source's number and figures, and `start`: the words before it in the source's stream.

    Documents are ordered by a hash of id and text, in buckets of about 4,096, so that no task orders a whole source;
    the buckets' sums are then added up per source.
    """
    spark = sized.sparkSession
    known = source_table(spark, sources)
    if sum(64 + len((s.name or "").encode()) for s in sources) <= MOST_BROADCAST:
        known = F.broadcast(known)
    keyed = sized.join(known, F.col("docs_source").eqNullSafe(known["source"])).drop("docs_source")
    keyed = keyed.withColumn("key", F.xxhash64("doc_id", "text_hash", F.lit(seed)))
    keyed = keyed.withColumn("bucket", F.pmod("key", F.col("buckets"))).drop("buckets")
    bucket = Window.partitionBy("source_number", "bucket").orderBy("key", "doc_id")
    so_far = bucket.rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.select(
        "*", F.coalesce(F.sum("size").over(so_far), F.lit(0)).alias("inside"), F.row_number().over(bucket).alias("nth")
    )
    sums = keyed.groupBy("source_number", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source_number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "source_number", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("before")
    )
    return inside.join(sums, ["source_number", "bucket"]).withColumn("start", F.col("before") + F.col("inside")).drop(
        "before", "inside", "key"
    )


def block_pieces(streamed: DataFrame, block_words: int) -> DataFrame:
    """One row per document and block it lies in: adds `block`, `from_word` and `n_words` (within the document).

    A document without words keeps one row, with null there.
    """
    start, end = F.col("start"), F.col("start") + F.col("size")
    first, last = F.floor(start / block_words), F.floor((end - 1) / block_words)
    blocks = F.when(F.col("size") > 0, F.sequence(first.cast("long"), last.cast("long")))
    cut = streamed.withColumn("block", F.explode_outer(blocks))
    low = F.greatest(start, F.col("block") * block_words)
    high = F.least(end, (F.col("block") + 1) * block_words)
    return cut.withColumns({"from_word": low - start, "n_words": high - low})


def pass_key(seed: int, source_number: int, turn: int) -> int:
    return (seed * 1_000_003 + source_number * 8191 + turn * 127) * 0x9E3779B97F4A7C15 % (1 << 64)


def slots_needed(source: Source, block_words: int, seed: int, most: float) -> tuple[int, int]:
    """How many slots hold the source's target in whole words, and how many words the last of them takes.

    All blocks have `block_words` but the source's last, so only its place in the last pass need be known.
    """
    if not source.size:
        return 0, 0
    blocks = -(-source.size // block_words)
    full, rest = divmod(min(round(source.target), int(most * source.size)), source.size)
    short = source.size - (blocks - 1) * block_words  # words of the last block
    if not rest:
        # the last slot takes its whole block, whichever that is
        return full * blocks, block_words
    place = int(permuted(np.array([blocks - 1]), blocks, pass_key(seed, source.number, full), back=True)[0])
    n = -(-rest // block_words)
    held = n * block_words - (block_words - short if place < n else 0)
    if held < rest:
        n, held = n + 1, held + block_words
    size = short if place == n - 1 else block_words
    return full * blocks + n, size - (held - rest)


def slots(spark: SparkSession, sources: list[Source], block_words: int, shards: int, seed: int, most: float) -> DataFrame:
    """One row per slot: (shard, source_number, pass, block, most_words)."""
    blocks = [-(-s.size // block_words) for s in sources]
    needed = [slots_needed(s, block_words, seed, most) for s in sources]
    totals = [n for n, _ in needed]
    draws = shard_draws(totals, shards, seed)
    firsts = np.cumsum(draws, axis=0) - draws
    plan = [
        (shard, s.number, blocks[i], int(firsts[shard, i]) + at, min(CHUNK_SLOTS, int(draws[shard, i]) - at), *needed[i])
        for shard in range(shards)
        for i, s in enumerate(sources)
        for at in range(0, int(draws[shard, i]), CHUNK_SLOTS)
    ]

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                j = np.arange(row.first, row.first + row.n, dtype=np.int64)
                turn, index = j // row.blocks, j % row.blocks
                block = np.empty(len(j), np.int64)
                for t in np.unique(turn):
                    here = turn == t
                    block[here] = permuted(index[here], row.blocks, pass_key(seed, row.source_number, int(t)))
                words = np.where(j == row.total - 1, row.cut, block_words)
                yield pd.DataFrame({
                    "shard": row.shard, "source_number": row.source_number, "pass": turn, "block": block, "most_words": words,
                })

    rows = spark.createDataFrame(plan, "shard int, source_number int, blocks long, first long, n long, total long, cut long")
    return rows.repartition("shard", "first").mapInPandas(
        fill, "shard int, source_number int, pass long, block long, most_words long"
    )


def mix(
    docs: DataFrame, weight: Callable[[int, str | None], float], most: float = 3, block_words: int = 128,
    shards: int = 64, seed: int = 1,
) -> DataFrame:
    """Pieces of documents with the slots that take them.

    Needs doc_id, text and source; other columns are not read. One row per document, block and slot that takes it:
    (doc_id, text_hash, size, source, source_number, source_size, target, bucket, nth, block, from_word, n_words, shard, pass).
    (source_number, bucket, nth) tells rows of the input apart, also repeated ones. A piece that no slot takes has null
    shard and pass, and so has one behind the words that the last slot of its source takes of its block; a document without words (null or blank text) has one row with null block. A null source is a
    source like any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"), F.col("source").cast("string").alias("docs_source"),
    )
    sources = sources_of(sized.withColumnRenamed("docs_source", "source"), weight, most)
    pieces = block_pieces(streams(sized, sources, seed), block_words)
    taken = slots(spark, sources, block_words, shards, seed, most)
    # The planner takes the slots for as small as the plan they are filled from; they grow with the input.
    joined = pieces.join(taken.hint("merge"), ["source_number", "block"], "left")
    before = F.col("start") + F.col("from_word") - F.col("block") * block_words  # words of the block before the piece
    here = F.when(F.col("pass").isNotNull(), F.least("n_words", F.col("most_words") - before))
    return joined.withColumns({
        "n_words": F.when(here > 0, here).otherwise(F.col("n_words")),
        "shard": F.when(here > 0, F.col("shard")), "pass": F.when(here > 0, F.col("pass")),
    }).drop("most_words")


def taken_words(mixed: DataFrame) -> DataFrame:
    """One row per document: (doc_id, size, source_size, target, taken)."""
    per_doc = mixed.groupBy("source_number", "bucket", "nth", "doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("pass").isNotNull(), F.col("n_words"))), F.lit(0)).alias("taken")
    )
    return per_doc.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame, weight: Callable[[int, str | None], float], most: float = 3, block_words: int = 128,
    shards: int = 64, seed: int = 1,
) -> DataFrame:
    """The mix as documents: a row per document and pass, with all columns of `docs` and the text taken in that pass.

    Words of blocks that follow each other keep the text between them; where blocks are left out, a line ends. n_chars,
    if there is one, is counted anew. Documents of which nothing is taken have no row; equal rows of id and text share
    their other columns, whose names may be any.
    """
    doc, hashed, listed, keyed = free_names(docs.columns, "_id", "_hash", "_spans", "_key")
    mixed = mix(docs, weight, most, block_words, shards, seed).where(F.col("pass").isNotNull())
    spans = mixed.groupBy("doc_id", "text_hash", "source_number", "bucket", "nth", "pass").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "n_words"))).alias(listed)
    ).select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed), listed)
    key = F.xxhash64("text")
    known = docs.withColumn(keyed, key).dropDuplicates(["doc_id", keyed])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(keyed) == F.col(hashed))
    joined = known.join(spans, same).select(*[F.col(f"`{c}`") for c in docs.columns], listed)
    text_at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.column(batch.num_columns - 1).to_pylist(), []
            for first, last, words in word_batches(batch.column(text_at)):
                cuts = words.first_words()
                for i in range(first, last):
                    parts, at = [], cuts[i - first]
                    for span in spans[i]:
                        low, high = at + span["from_word"], at + span["from_word"] + span["n_words"]
                        if parts and parts[-1][1] == low:
                            parts[-1][1] = high
                        else:
                            parts.append([low, high])
                    texts.append(b"\n".join(words.data[words.starts[a] : words.ends[b - 1]].tobytes() for a, b in parts))
            columns = list(batch.columns[:-1])
            columns[text_at] = pa.array([t.decode() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    out = joined.mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def cyclic_weight(number: int, _: str | None) -> float:
    """1, 2, 3, and again, by the source's place."""
    return 1.0 + number % 3
