"""N-gram Jaccard join of documents with Bayesian pruning of candidates.

Documents are sets of 5-word shingles; a link joins two that have a Jaccard similarity of 0.8 or more.

1. Documents with equal shingle sets form a class, so copies are compared once.
2. Each class gets 128 MinHash values. In 32 bands of 4, classes with equal band values are candidates; a pair at the
   threshold is missed with a probability of (1 - 0.8^4)^32, less than 5e-8.
3. Classes are dealt to blocks by the least class they share a band with, so that relatives lie together; the blocks of
   a large family have a bounded number of classes and shingles. Two blocks are compared when classes of both share a
   band: a family of m documents costs (m / block)^2 rows, not m^2.
4. In a task that holds two blocks, MinHash values of all pairs are compared 16 at a time. After n values of which m
   agree, the similarity has the posterior Beta(m + 1, n - m + 1); pairs whose probability of reaching the threshold is
   below the tolerance are dropped. The others are verified exactly on their shingles.
5. Tasks return, per class, how many documents it is linked with, and a spanning forest of its links, at most as many
   as classes. Groups are the connected components, by labels that spread until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.names import free_names
from claimflow.llm.tokens import shingle_hashes, word_batches
from claimflow.session import freeze

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
TOLERANCE = 1e-7
STEP = 16  # MinHash values compared at a time
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 18


def minhash_parameters(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingle hashes of each text, some texts at a time.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    for first, last, words in word_batches(column):
        cuts = words.first_words()
        yield [
            np.unique(shingle_hashes(w, min(WORDS, max(1, len(w)))))
            for w in (words.hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
        ]


def minhashes(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row of MinHash values per (non-empty) set."""
    flat = np.concatenate(sets)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(a)), np.uint32)
    for i in range(len(a)):
        x = flat * a[i] + b[i]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out[:, i] = np.minimum.reduceat(x, starts)
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = 0..HASHES compared values: the fewest that must agree for a pair to stay.

    With a uniform prior, P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(HASHES + 1):
        total = 0.0
        for m in range(n + 2):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return out


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, signatures): (doc_id, hash, low, high, n) per document, and MinHash values per class.

    (low, high) is a hash of the shingle set and names the class. `signatures` holds each document with a non-empty set
    once per row of the input; equal classes have equal values.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = minhash_parameters()
        for batch in batches:
            at = 0
            for sets in shingle_sets(batch.column(2)):
                some = batch.slice(at, len(sets))
                at += len(sets)
                full = [s for s in sets if len(s)]
                signed = iter(minhashes(full, a, b)) if full else iter(())
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8")
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1),
                    pa.array(digests[::2]), pa.array(digests[1::2]), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], ["doc_id", "hash", "low", "high", "n", "signature"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    made = freeze(
        rows.mapInArrow(make, "doc_id long, hash long, low long, high long, n int, signature binary"), "shingle-classes"
    )
    return made.select("doc_id", "hash", "low", "high", "n"), made.where("n > 0").select("low", "high", "n", "signature")


def band_rows(signatures: DataFrame) -> DataFrame:
    """(band, low, high): one row per class and band; `band` hashes the band's number and values."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").reshape(-1, BANDS, ROWS)
            band = np.broadcast_to(mark, values.shape[:2]).copy()
            for i in range(ROWS):
                band = (band ^ values[:, :, i]) * np.uint64(0xBF58476D1CE4E5B9)
                band ^= band >> np.uint64(29)
            yield pa.RecordBatch.from_arrays([
                pa.array(band.view(np.int64).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)),
                pa.array(np.repeat(batch.column(1).to_numpy(), BANDS)),
            ], ["band", "low", "high"])

    return signatures.select("low", "high", "signature").mapInArrow(cut, "band long, low long, high long")


def count_links(a: dict, b: dict | None, least: list[int]) -> Iterator[tuple[int, int]]:
    """Linked pairs (i in a, j in b), or within a when b is None: pruned by MinHash values, verified on shingles."""
    other = b or a
    i, j = np.divmod(np.arange(len(a["sets"]) * len(other["sets"])), len(other["sets"]))
    if b is None:
        i, j = i[i < j], j[i < j]
    agree, left = np.zeros(len(i), np.int32), a["values"].T.copy()
    right = other["values"].T.copy()
    for at in range(0, HASHES, STEP):
        for k in range(at, at + STEP):
            agree += left[k][i] == right[k][j]
        stay = agree >= least[at + STEP]
        i, j, agree = i[stay], j[stay], agree[stay]
    sizes, others = a["sizes"][i].astype(np.int64), other["sizes"][j].astype(np.int64)
    fits = 5 * np.minimum(sizes, others) >= 4 * np.maximum(sizes, others)
    i, j, total = i[fits], j[fits], (sizes + others)[fits]
    both = overlaps(a["sets"], other["sets"], i, j)
    linked = 5 * both >= 4 * (total - both)
    yield from zip(i[linked].tolist(), j[linked].tolist())


def overlaps(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Shared shingles of the pairs (left[i], right[j]): by products of 0/1 matrices where pairs are many, else one by one."""
    if not len(i):
        return np.zeros(0, np.int64)
    rows, at_i = np.unique(i, return_inverse=True)
    columns, at_j = np.unique(j, return_inverse=True)
    values, place = np.unique(np.concatenate([left[x] for x in rows] + [right[y] for y in columns]), return_inverse=True)
    if len(rows) * len(columns) * len(values) > len(i) * 300_000:
        return np.array([len(left[x]) + len(right[y]) - len(np.union1d(left[x], right[y])) for x, y in zip(i, j)])
    lengths = [len(left[x]) for x in rows] + [len(right[y]) for y in columns]
    row = np.repeat(np.arange(len(lengths)), lengths)
    shared = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for at in range(0, len(values), 4096):
        low, high = np.searchsorted(place, (at, at + 4096))
        m = np.zeros((len(lengths), 4096), np.float32)
        m[row[low:high], place[low:high] - at] = 1
        shared += m[: len(rows)] @ m[len(rows) :].T
    return shared[at_i, at_j].round().astype(np.int64)


def unpack(rows: list[dict]) -> dict:
    sets = [np.frombuffer(r["shingles"], "<u8") for r in rows]
    return {
        "key": [(r["low"], r["high"]) for r in rows], "copies": [r["copies"] for r in rows], "sets": sets,
        "sizes": np.array([len(s) for s in sets]),
        "values": np.frombuffer(b"".join(r["signature"] for r in rows), "<u4").reshape(-1, HASHES),
    }


def link_rows(pairs: DataFrame) -> DataFrame:
    """Per pair of blocks (a, b; b is null for a block with itself): (low, high, links, to_low, to_high).

    A row with links counts documents linked with the class; a row with a partner is an edge of the spanning forest.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches()
        kinds = [pa.int64()] * 5
        names = ["low", "high", "links", "to_low", "to_high"]
        for batch in batches:
            for n in range(batch.num_rows):
                a = unpack(batch.column(0)[n].as_py())
                other = batch.column(1)[n].as_py()
                b = unpack(other) if other is not None else None
                links: dict[tuple[int, int], int] = {}
                root: dict[tuple[int, int], tuple[int, int]] = {}

                def find(k):
                    while root.setdefault(k, k) != k:
                        root[k] = root[root[k]]
                        k = root[k]
                    return k

                out = []
                to = b or a
                for x, y in count_links(a, b, least):
                    p, q = a["key"][x], to["key"][y]
                    links[p] = links.get(p, 0) + to["copies"][y]
                    links[q] = links.get(q, 0) + a["copies"][x]
                    if (r := find(p)) != (s := find(q)):
                        root[r] = s
                        out.append((*p, 0, *q))
                out += [(*k, v, None, None) for k, v in links.items()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return pairs.mapInArrow(compare, "low long, high long, links long, to_low long, to_high long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes with an edge: the least node of the component.

    Labels spread along edges, and labels of labels are followed in the same round, so long chains halve. Each round is
    a table in the shared folder.
    """
    both = freeze(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = freeze(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        far = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(far, "next").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved"))
        step = freeze(step, "labels")
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, hash, class_id, n_links).

    class_id is the least id of the group the document is in: those connected by links, its own id when it has none.
    n_links is the number of other documents it is linked with, copies included. A text of fewer than five words is a
    single shingle, so it is linked with texts of the same words only; null texts and texts without words have no
    links. Null ids are least and take part; repeated rows are documents of their own. Ties in ids are told apart by
    `hash`, xxhash64 of the text. Other columns are not read. An empty table gives no rows.
    """
    return grouped_documents(docs, id_col, text_col).drop("label")


def grouped_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As link_documents, with `label`, which names the group; null for texts without words. Groups may have the same
    class_id, where rows of one id have different texts."""
    members, signatures = classes_of(docs, id_col, text_col)
    classes = freeze(
        signatures.groupBy("low", "high").agg(
            F.count("*").alias("copies"), F.first("n").alias("n"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    bands = freeze(band_rows(classes), "bands")
    # Of each band the least class, which the others gather around; bands of one class make no candidates.
    hubs = bands.groupBy("band").agg(F.count("*").alias("m"), F.min(F.struct("low", "high")).alias("hub")).where("m > 1")
    shared = freeze(bands.join(hubs.drop("m"), "band"), "shared-bands")
    homes = shared.groupBy("low", "high").agg(F.min("hub").alias("home"))
    sized = homes.join(classes.select("low", "high", "n"), ["low", "high"])
    parts = sized.groupBy("home").agg(F.count("*").alias("m"), F.sum("n").alias("total")).select(
        "home", F.ceil(F.greatest(F.col("m") / BLOCK_CLASSES, F.col("total") / BLOCK_SHINGLES)).alias("parts")
    )
    part = F.pmod(F.xxhash64("low", "high"), F.col("parts"))
    dealt = freeze(sized.join(parts, "home").select("low", "high", F.struct("home.low", "home.high", part.alias("part")).alias("block")), "blocks")

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.col(text_col).cast("string").alias("text"))
    chosen = members.where("n > 0").groupBy("low", "high").agg(F.min(F.struct("doc_id", "hash")).alias("d"))
    chosen = chosen.join(dealt, ["low", "high"]).join(classes.drop("n"), ["low", "high"])
    same = texts["doc_id"].eqNullSafe(F.col("d.doc_id")) & (texts["hash"] == F.col("d.hash"))
    with_text = texts.join(chosen, same).select("low", "high", "block", "copies", "signature", "text")

    def add_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for some in shingle_sets(batch.column(5)) for s in some]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sets, pa.large_binary())], [
                "low", "high", "block", "copies", "signature", "shingles"])

    content = with_text.mapInArrow(
        add_shingles, "low long, high long, block struct<low:long,high:long,part:long>, copies long, "
        "signature binary, shingles binary",
    ).dropDuplicates(["low", "high"])
    blocks = freeze(content.groupBy("block").agg(F.collect_list(
        F.struct("low", "high", "copies", "signature", "shingles")).alias("rows")), "block-rows")

    seen = shared.join(dealt, ["low", "high"]).select("band", "block").distinct()
    pairs = seen.select("band", F.col("block").alias("a")).join(seen.select("band", F.col("block").alias("b")), "band")
    pairs = pairs.where("a < b").select("a", "b").distinct()
    left = blocks.select(F.col("block").alias("a"), F.col("rows").alias("rows_a"))
    right = blocks.select(F.col("block").alias("b"), F.col("rows").alias("rows_b"))
    across = pairs.join(left, "a").join(right, "b").select("rows_a", "rows_b")
    within = blocks.where(F.size("rows") > 1).select(F.col("rows").alias("rows_a"), F.lit(None).cast(right.schema["rows_b"].dataType).alias("rows_b"))
    found = freeze(link_rows(across).union(link_rows(within)), "links")

    key = F.struct("low", "high")
    edges = found.where("to_low IS NOT NULL").select(key.alias("a"), F.struct(F.col("to_low").alias("low"), F.col("to_high").alias("high")).alias("b"))
    labels = components(edges)
    counts = found.groupBy("low", "high").agg(F.sum("links").alias("links"))
    per_class = members.groupBy("low", "high").agg(F.min(F.struct("doc_id")).alias("least"), F.count("*").alias("copies"))
    per_class = per_class.join(counts, ["low", "high"], "left").join(
        labels.select("node.low", "node.high", "label"), ["low", "high"], "left"
    ).withColumn("label", F.coalesce("label", key))
    groups = per_class.groupBy("label").agg(F.min("least").alias("group"))
    per_class = per_class.join(groups, "label").select("low", "high", "copies", "links", "group.doc_id", "label")
    per_class = per_class.withColumnRenamed("doc_id", "class_id")
    full = F.col("n") > 0
    return members.join(per_class, ["low", "high"]).select(
        "doc_id", "hash", F.when(full, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(full, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(full, F.col("label")).alias("label"),
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay when one of each group does: that with the least id, null least, and of several the one
    of least hash of the text. Of rows that are equal in id and text any one stays. Texts without words are in no group
    and all stay. All columns are kept, whatever their names."""
    doc, hashed, n = free_names(docs.columns, "_id", "_hash", "_n")
    links = grouped_documents(docs, id_col, text_col)
    counts = links.groupBy("doc_id", "hash", "label").agg(F.count("*").alias("n"))
    groups = counts.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "hash", "n")).alias("d"))
    alone = links.where("label IS NULL").select("doc_id", "hash", F.lit(1).cast("long").alias("n")).distinct()
    stay = groups.select("d.doc_id", "d.hash", "d.n").union(alone)
    stay = freeze(stay.toDF(doc, hashed, n), "one-per-group")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (
        F.xxhash64(F.col(text_col).cast("string")) == F.col(hashed)
    )
    once = docs.join(stay.where(F.col(n) == 1), same, "left_semi")
    several = docs.join(stay.where(F.col(n) > 1), same).dropDuplicates([doc, hashed])
    return once.union(several.select(*[F.col(f"`{c}`") for c in docs.columns]))
