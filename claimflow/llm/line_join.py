"""Line dedup by an exact set-similarity join: a line goes when an earlier line has a Jaccard similarity of 0.8 or more.

A line is a piece of text between newlines that has a word; its tokens are the set of its words. Lines are ordered by
document id (null first), a hash of the text, and their number. The steps:

1. Rarity: words are counted over all lines into 2^20 buckets by their hash. Any order of tokens gives right results;
   the buckets make it nearly that of rarity at a fixed size, so they can go to every task.
2. Lines with equal token sets form a class; its first line stands for it and all others go.
3. Prefix filter: two similar sets share a token among the first |x| - ceil(0.8 |x|) + 1 of each, rarest first. Pairs
   that share one must also pass the length filter, the positional filter and a bitmap of token parities (two sets
   differ in at least as many tokens as their bitmaps in bits).
   Tasks exchange their prefix entries as packed arrays, one row per target, and compare whole lists in memory. The list
   of a frequent token is split into parts that meet two by two, so a cell has a bounded size.
4. A line needs one earlier match only. So of the pairs that pass, the earliest few per token are verified, on the words
   themselves; a group of many variants is not paired out. Lines that had more, and whose few all fail, are verified
   against every other one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.names import free_names
from claimflow.llm.tokens import Words, portions, word_batches
from claimflow.session import freeze

BUCKETS, WIDTH = 1 << 20, 16
CELL = 4096  # entries in one part of a token's list, by the counts of its bucket
SHORT_LIST, BLOCK = 64, 512  # how lists are compared in memory
FILTER_BITS = 1 << 24  # 2 MB
FEW = 4  # candidates per entry and list that are verified first
NUMERATOR, DENOMINATOR = 4, 5  # the threshold 0.8, in whole numbers
LINE = "doc_id long, place long, low long, high long, size int, bits long, more_bits long, n_lines int, prefix array<int>"
SPACE = r"[\x20\x09-\x0D]+"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hash, text): 32 bits of the text's hash tell apart documents with one id; equal rows count as one."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(0)).alias("hash"), text.alias("text"),
    )


def rarity(rows: DataFrame) -> np.ndarray:
    """Words per bucket, over all lines. Each task sends WIDTH buckets a row."""
    names = [f"n{i}" for i in range(WIDTH)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, words in word_batches(batch.column(0)):
                total += np.bincount((words.hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        wide = total.reshape(-1, WIDTH)
        here = np.flatnonzero(wide.any(1))
        columns = [pa.array(wide[here, i]) for i in range(WIDTH)]
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), *columns], ["row", *names])

    schema = ", ".join(["row int", *(f"{n} long" for n in names)])
    counted = rows.select("text").mapInArrow(count, schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    out = np.zeros((BUCKETS // WIDTH, WIDTH), np.int64)
    found = counted.toArrow()  # BUCKETS / WIDTH rows at most
    out[found.column("row").to_numpy()] = np.stack([found.column(n).to_numpy() for n in names], 1)
    return out.ravel()


def in_order(line: np.ndarray, rare: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Order by line, rarity and token. The sort key has 26 bits of the token; should that tie, all bits are compared."""
    rare = np.minimum(rare, (1 << 20) - 1).astype(np.uint64)
    if len(line) and line[-1] < 1 << 18:
        key = line.astype(np.uint64) << np.uint64(46) | rare << np.uint64(26) | tokens >> np.uint64(38)
        order = np.argsort(key)
        k, t = key[order], tokens[order]
        if not ((k[1:] == k[:-1]) & (t[1:] != t[:-1])).any():
            return order
    return np.lexsort((tokens, rare, line))


def lines_of(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """One row per line with words. `place` orders lines within an id; (low, high) is a hash of the token set;
    n_lines counts those of the document.

    `prefix` has 32 bits of each token's hash, which is enough to find equal tokens; the order is by rarity and the
    whole hash.
    """
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = batch.column(0), batch.column(1).to_numpy()
            for first, last, words in word_batches(batch.column(2)):
                if len(words.hashes):
                    yield columns(docs.slice(first, last - first), keys[first:last], words, shared.value)

    def columns(docs: pa.Array, keys: np.ndarray, words: Words, rare: np.ndarray) -> pa.RecordBatch:
        lines, text_of, number_of = line_starts(words.data, words.texts)
        line = np.searchsorted(lines, words.starts, "right") - 1
        tokens = words.hashes
        order = in_order(line, rare[(tokens % np.uint64(BUCKETS)).astype(np.int64)], tokens)
        line, tokens = line[order], tokens[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (tokens[1:] != tokens[:-1])
        line, tokens = line[new], tokens[new]
        starts = np.flatnonzero(np.diff(line, prepend=-1))
        sizes = np.diff(np.append(starts, len(line)))
        # sums of mixed hashes do not depend on the order
        mixed = (tokens ^ (tokens >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        low = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
        mixed = (tokens ^ (tokens >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        high = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
        bit, half = np.uint64(1) << (tokens >> np.uint64(58)), (tokens >> np.uint64(57)) & np.uint64(1)
        bits, more_bits = (np.bitwise_xor.reduceat(bit * x, starts) for x in (half, np.uint64(1) - half))
        prefix = sizes + (-NUMERATOR * sizes // DENOMINATOR) + 1
        chosen = np.arange(len(tokens)) - np.repeat(starts, sizes) < np.repeat(prefix, sizes)
        ends = np.concatenate([[0], np.cumsum(prefix)]).astype(np.int32)
        here = line[starts]
        text, number = text_of[here], number_of[here]
        return pa.RecordBatch.from_arrays([
            docs.take(pa.array(text)), pa.array((keys[text] << 32) + number), pa.array(low.view(np.int64)),
            pa.array(high.view(np.int64)), pa.array(sizes.astype(np.int32)), pa.array(bits.view(np.int64)),
            pa.array(more_bits.view(np.int64)), pa.array(np.bincount(text)[text].astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[chosen].astype(np.uint32).view(np.int32))),
        ], ["doc_id", "place", "low", "high", "size", "bits", "more_bits", "n_lines", "prefix"])

    return rows.select("doc_id", "hash", "text").mapInArrow(make, LINE)


ENTRY = np.dtype([
    ("token", "<u4"), ("doc", "<i8"), ("place", "<i8"), ("bits", "<u8"), ("more_bits", "<u8"), ("size", "<i4"), ("position", "<i4"),
    ("cell", "<i4"), ("probe", "u1"), ("null", "u1"),
])


def by_column(entries: np.ndarray) -> bytes:
    """The entries one field after the other, which packs better."""
    return b"".join(entries[name].tobytes() for name in ENTRY.names)


def from_columns(packed: bytes) -> np.ndarray:
    out, at = np.empty(len(packed) // ENTRY.itemsize, ENTRY), 0
    for name in ENTRY.names:
        out[name] = np.frombuffer(packed, ENTRY[name], len(out), at)
        at += len(out) * ENTRY[name].itemsize
    return out


def prefix_counts(classes: DataFrame, counts: np.ndarray) -> np.ndarray:
    """How long the lists of a bucket's tokens are at most: the words of the bucket, or its prefix entries.

    A list is split beyond CELL entries only, so prefix entries are counted in buckets of more words than that.
    """
    shared = classes.sparkSession.sparkContext.broadcast(counts > CELL)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            bucket = batch.column(0).flatten().to_numpy().view(np.uint32) % np.uint32(BUCKETS)
            total += np.bincount(bucket[shared.value[bucket]], minlength=BUCKETS)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(total[here])], ["bucket", "n"])

    counted = classes.select("prefix").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, found = np.where(counts > CELL, 0, counts), counted.toArrow()
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def cells_of(token: np.ndarray, doc: np.ndarray, place: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries go to which cells: (index of the entry, cell number).

    A long list is split into parts by a hash of the class; a cell takes two parts, or one with itself, so that each
    pair of entries still meets and no cell is large.
    """
    parts = np.maximum(1, -(-listed[(token % np.uint32(BUCKETS)).astype(np.int64)] // CELL))
    mixed = (doc.view(np.uint64) ^ place.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    own = (mixed >> np.uint64(33)).astype(np.int64) % parts
    index = np.repeat(np.arange(len(token)), parts)
    other = np.arange(len(index)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.minimum(own[index], other), np.maximum(own[index], other)
    return index, (low * parts[index] + high).astype(np.int32)


def packed_entries(classes: DataFrame, listed: np.ndarray, targets: int, asked: np.ndarray | None) -> DataFrame:
    """(target, entries): each task's prefix entries as one binary row per target partition.

    `probe` marks the classes that look for a partner; the others are only found. `asked` is a bit set of the tokens
    that the probes have; entries of others are left out.
    """
    shared = classes.sparkSession.sparkContext.broadcast((listed, asked))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            prefix = column["prefix"]
            lengths = prefix.value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lengths)
            token = prefix.flatten().to_numpy().view(np.uint32)
            null = column["doc_id"].is_null().to_numpy(zero_copy_only=False)
            doc = column["doc_id"].fill_null(0).to_numpy()
            place = column["place"].to_numpy()
            counts, asked_tokens = shared.value
            position = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            if asked_tokens is not None:
                some = np.flatnonzero(is_marked(asked_tokens, token % np.uint32(FILTER_BITS)))
                row, token, position = row[some], token[some], position[some]
            if not len(token):
                continue
            index, cell = cells_of(token, doc[row], place[row], counts)
            row = row[index]
            out = np.empty(len(index), ENTRY)
            out["token"], out["doc"], out["place"], out["cell"] = token[index], doc[row], place[row], cell
            for name in ("bits", "more_bits"):
                out[name] = column[name].to_numpy().view(np.uint64)[row]
            out["size"] = column["size"].to_numpy()[row]
            out["position"] = position[index]
            out["probe"] = column["probe"].to_numpy(zero_copy_only=False)[row]
            out["null"] = null[row]
            spread = (out["token"].astype(np.uint64) + out["cell"].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            target = ((spread >> np.uint64(32)) % np.uint64(targets)).astype(np.int32)
            order = np.argsort(target, kind="stable")
            out, target = out[order], target[order]
            cuts = np.flatnonzero(np.diff(target, prepend=-1))
            ends = np.append(cuts[1:], len(target))
            yield pa.RecordBatch.from_arrays([
                pa.array(target[cuts]), pa.array([by_column(out[a:b]) for a, b in zip(cuts, ends)], pa.large_binary())
            ], ["target", "entries"])

    columns = ["prefix", "size", "bits", "more_bits", "probe", F.col("head.doc_id").alias("doc_id"), F.col("head.place").alias("place")]
    return classes.select(*columns).mapInArrow(pack, "target int, entries binary")


class Filters:
    """Length, positional and bitmap filters on pairs of entries, on columns, the cheapest first."""

    def __init__(self, e: np.ndarray):
        self.size, self.left = e["size"].copy(), e["size"] - e["position"]
        self.bits, self.more_bits, self.probe = e["bits"].copy(), e["more_bits"].copy(), e["probe"] > 0

    def passing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs pass; a has the later classes."""
        x, y = self.size[a], self.size[b]
        some = np.flatnonzero((DENOMINATOR * x >= NUMERATOR * y) & (DENOMINATOR * y >= NUMERATOR * x))
        a, b = a[some], b[some]
        # Similar sets share at least 4/9 of the sum of their sizes, and all of it from their first common token on.
        whole, total = NUMERATOR + DENOMINATOR, x[some] + y[some]
        ok = np.flatnonzero((whole * np.minimum(self.left[a], self.left[b]) >= NUMERATOR * total) & self.probe[a])
        some, a, b, total = some[ok], a[ok], b[ok], total[ok]
        # so they differ in at most 1/9 of that sum
        differ = np.bitwise_count(self.bits[a] ^ self.bits[b]).astype(np.int32)
        differ += np.bitwise_count(self.more_bits[a] ^ self.more_bits[b])
        return some[whole * differ <= (DENOMINATOR - NUMERATOR) * total]


def list_order(e: np.ndarray) -> np.ndarray:
    """Order of the entries by token, cell, and the order of lines."""
    token = e["token"].astype(np.uint64) << np.uint64(32)
    if not len(e) or e["null"].any() or e["cell"].any() or e["doc"].min() < 0 or e["doc"].max() >> 32:
        nulls = [1 - e["null"]] if e["null"].any() else []
        return np.lexsort((e["place"], e["doc"], *nulls, token | e["cell"].astype(np.uint64)))
    # One sort by token and document does nearly all; entries with the same of both are then put in order of place.
    key = token | e["doc"].astype(np.uint64)
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    at = order[tied]
    order[tied] = at[np.lexsort((e["place"][at], key[at]))]
    return order


def pairs_in(entries: np.ndarray, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates among the entries: later, earlier, and whether more of the later one's list may have been left out.

    With `most`, only the earliest so many per entry and list are given.
    """
    e = entries[list_order(entries)]
    filters = Filters(e)
    new = np.empty(len(e), bool)
    new[:1] = True
    new[1:] = (e["token"][1:] != e["token"][:-1]) | (e["cell"][1:] != e["cell"][:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(e)))
    offset = np.arange(len(e)) - np.repeat(starts, lengths)  # place in the list
    found = np.zeros(len(e), np.int64)
    limit = len(e) if most is None else most
    later = np.flatnonzero((np.repeat(lengths, lengths) <= SHORT_LIST) & (offset > 0))
    n = 0  # the earlier entry's place in its list
    while len(later):
        earlier = later - offset[later] + n
        ok = filters.passing(later, earlier)
        hit = later[ok]
        found[hit] += 1
        yield e[hit], e[earlier[ok]], found[hit] >= limit
        n += 1
        later = later[(offset[later] > n) & (found[later] < limit)]
    for start, length in zip(starts[lengths > SHORT_LIST], lengths[lengths > SHORT_LIST]):
        for at in range(0, length, BLOCK):
            some = np.arange(at, min(at + BLOCK, length))
            for to in range(0, at + len(some), BLOCK):
                some = some[found[start + some] < limit]
                others = np.arange(to, min(to + BLOCK, length))
                i, j = (x.ravel() for x in np.meshgrid(some + start, others + start, indexing="ij"))
                if to == at:
                    i, j = i[j < i], j[j < i]
                ok = filters.passing(i, j)
                i, j = i[ok], j[ok]
                ends = np.searchsorted(i, i, "left")  # where each one's candidates begin
                rank = found[i] + np.arange(len(i)) - ends + 1
                i, j, rank = i[rank <= limit], j[rank <= limit], rank[rank <= limit]
                found[start : start + length] += np.bincount(i - start, minlength=length)
                yield e[i], e[j], rank >= limit


def tokens_asked(probes: DataFrame) -> np.ndarray:
    """Bit set of the tokens that probes have."""
    bit = F.col("token").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("long").alias("bit")
    return marks_of(probes.where("probe").select(F.explode("prefix").alias("token")).select(bit))


def candidates(
    classes: DataFrame, listed: np.ndarray, most: int | None, asked: np.ndarray | None = None
) -> DataFrame:
    """(later, earlier, cut): heads of classes that share a prefix token and pass the filters; later ones are probes.

    `cut` tells that the later one may have more candidates than are given.
    """
    targets = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [from_columns(x) for batch in batches for x in batch.column(1).to_pylist()]
        if not parts:
            return
        names = ["later_null", "later_doc", "later_place", "null", "doc", "place", "cut"]
        seen: list[np.ndarray] = []
        for a, b, cut in pairs_in(np.concatenate(parts), most):
            if len(a):
                columns = [x[k].astype(np.int64) for x in (a, b) for k in ("null", "doc", "place")]
                seen.append(np.stack([*columns, cut.astype(np.int64)], 1))
        if seen:
            out = np.unique(np.concatenate(seen), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(7)], names)

    packed = packed_entries(classes, listed, targets, asked).repartition(targets, "target")
    key = ["later_null", "later_doc", "later_place", "null", "doc", "place"]
    pairs = packed.mapInArrow(pair, ", ".join(f"{c} long" for c in [*key, "cut"])).groupBy(*key).agg(F.max("cut").alias("cut"))

    def head(prefix: str) -> Column:
        doc = F.when(F.col(f"{prefix}null") == 0, F.col(f"{prefix}doc"))
        return F.struct(doc.alias("doc_id"), F.col(f"{prefix}place").alias("place"))

    return pairs.select(head("later_").alias("later"), head("").alias("earlier"), (F.col("cut") > 0).alias("cut"))


def line_starts(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where lines start, the text each is in and its number there. Places of empty texts count for the next text."""
    lines = np.union1d(texts[:-1], np.flatnonzero(data == 10) + 1)
    text = np.searchsorted(texts, lines, "right") - 1
    inside = text < len(texts) - 1  # a newline at the very end starts nothing
    lines, text = lines[inside], text[inside]
    return lines, text, np.arange(len(lines)) - np.searchsorted(lines, texts[text])


def marks_of(bits: DataFrame) -> np.ndarray:
    """A bit set of fixed size from the rows' `bit`: the driver gets FILTER_BITS bits, however many rows there are."""
    # these functions put the numbers 1 to 32768 into bucket 1, and so on
    bucket, position = F.expr("bitmap_bucket_number(bit + 1)"), F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.groupBy(bucket.alias("bucket")).agg(position.alias("marks")).toLocalIterator():
        part = np.frombuffer(row["marks"], np.uint8)
        at = (row["bucket"] - 1) * 4096
        out[at : at + len(part)] = part
    return out


def is_marked(marks: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (marks[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def wanted_lines(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(head, line): lines that may be among the heads, by a bit set of fixed size; few others pass while it is sparse."""
    doc, place = F.coalesce("head.doc_id", F.lit(0)), F.col("head.place")
    mixed = F.shiftright(place, 32).bitwiseXOR(place.bitwiseAND(F.lit(0xFFFFFFFF)) * 2654435)
    mixed = mixed.bitwiseXOR(doc).bitwiseXOR(F.shiftright(doc, 24))
    marks = marks_of(heads.select(mixed.bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit")))
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            hashes = batch.column(1).to_numpy()
            for first, last, data, texts in portions(batch.column(2)):
                lines, text, number = line_starts(data, texts)
                doc, key = ids[first:last][text], hashes[first:last][text]
                bit = (key ^ (number * 2654435) ^ doc ^ (doc >> 24)) & (FILTER_BITS - 1)
                some = np.flatnonzero(is_marked(shared.value, bit))
                ends = np.append(lines[1:], len(data))[some]
                raw = [data[a:b].tobytes().rstrip(b"\n") for a, b in zip(lines[some], ends)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).take(pa.array(text[some])),
                    pa.array((key[some] << 32) + number[some]), pa.array(raw, pa.binary()).cast(pa.string()),
                ], ["doc_id", "place", "line"])

    found = rows.select("doc_id", "hash", "text").mapInArrow(cut, "doc_id long, place long, line string")
    return found.select(F.struct("doc_id", "place").alias("head"), "line")


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose token sets are similar, by the words of the lines."""
    heads = pairs.select(F.explode(F.array("later", "earlier")).alias("head"))
    lines = wanted_lines(rows, heads)
    words = F.array_distinct(F.filter(F.split("line", SPACE), lambda w: w != ""))
    sets = lines.dropDuplicates(["head"]).select("head", words.alias("words"))
    a = sets.select(F.col("head").alias("later"), F.col("words").alias("a"))
    b = sets.select(F.col("head").alias("earlier"), F.col("words").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    similar = DENOMINATOR * both >= NUMERATOR * (F.size("a") + F.size("b") - both)
    return pairs.join(a, "later").join(b, "earlier").where(similar).select("later", "earlier")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, hash, n_lines, removed), `removed` holding the numbers of the lines that go.

    n_lines counts lines with words; other lines stay. Line numbers start at 0. Null text has no lines. Documents with
    one id are told apart by their text; equal rows count as one document and give one row, so their lines do not
    remove each other. Null ids come first in the order. Only the id and the text are read, so other columns may have
    any names. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    counts = rarity(rows)
    lines = freeze(lines_of(rows, counts), "lines")
    head = F.struct("doc_id", "place")
    classes = freeze(
        lines.groupBy("low", "high").agg(
            F.min(head).alias("head"), F.first("size").alias("size"), F.first("bits").alias("bits"),
            F.first("more_bits").alias("more_bits"), F.first("prefix").alias("prefix"), F.count(F.lit(1)).alias("n"),
        ),
        "line-classes",
    )
    listed = prefix_counts(classes, counts)
    pairs = freeze(candidates(classes.withColumn("probe", F.lit(True)), listed, FEW), "line-pairs")
    found = freeze(verified(pairs, rows).select("later").distinct(), "line-found")
    # Classes that had more than the few candidates, which all failed, are compared with every other one.
    still = freeze(pairs.where("cut").select("later").distinct().join(found, "later", "left_anti"), "line-open")
    if not still.isEmpty():
        probes = classes.join(still.withColumn("probe", F.lit(True)), classes["head"] == still["later"], "left")
        probes = probes.drop("later").withColumn("probe", F.coalesce("probe", F.lit(False)))
        found = found.union(
            verified(freeze(candidates(probes, listed, None, tokens_asked(probes)), "line-pairs"), rows).select("later")
        ).distinct()
    gone = found.withColumn("gone", F.lit(True))

    # Only classes that lose a line go on to the lines; most classes are one line that stays.
    verdicts = classes.select("low", "high", "head", "n").join(gone, F.col("head") == F.col("later"), "left").select(
        "low", "high", "head", "n", F.coalesce("gone", F.lit(False)).alias("gone")
    ).where((F.col("n") > 1) | F.col("gone"))
    number = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    hash_of = F.shiftright("place", 32).alias("hash")
    out = lines.select("low", "high", "doc_id", "place").join(verdicts, ["low", "high"]).where(
        F.col("gone") | (F.col("head") != head)
    ).select("doc_id", hash_of, F.lit(0).alias("n_lines"), number.alias("number"))
    none = F.lit(None).cast("int").alias("number")
    counted = lines.groupBy("doc_id", hash_of).agg(F.max("n_lines").alias("n_lines")).withColumn("number", none)
    known = rows.select("doc_id", "hash", F.lit(0).alias("n_lines"), none)
    return known.union(counted).union(out).groupBy("doc_id", "hash").agg(
        F.max("n_lines").cast("long").alias("n_lines"), F.array_sort(F.collect_set("number")).alias("removed")
    )


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the lines gone from the text; every row and all other columns stay, whatever their names."""
    doc, hashed, removed = free_names(docs.columns, "_id", "_hash", "_removed")
    gone = removed_lines(docs, id_col, text_col).where(F.size("removed") > 0).select(
        F.col("doc_id").alias(doc), F.col("hash").alias(hashed), F.col("removed").alias(removed)
    )
    text = F.col(text_col).cast("string")
    key = F.coalesce(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(0))
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (key == F.col(hashed)), "left")
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(removed, i))
    cleaned = F.when(F.col(removed).isNull(), text).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
