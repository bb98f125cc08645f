"""Exact top-k by inner product over integer vectors, longest vectors first.

1. Components become floor(scale * x). Vectors of one dimension are compared with each other.
2. A rotation by the eigenvectors of the sum of v v^T (the SVD of all vectors; one d x d matrix per task is added up)
   moves most of a product into the first coordinates.
3. Vectors are dealt to chunks by length, each chunk sorted by descending length; queries form blocks. Blocks meet
   chunks by a join on the chunk's number.
4. The first pass takes the chunk of the longest vectors only and gives each query a score it will reach. The second
   takes all others: a query stops in a chunk when |q| |v| falls below its k-th score, and skips a vector when the
   product of the first rotated coordinates plus the product of the lengths of the rest (Cauchy-Schwarz) does. What is
   left is scored exactly in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimflow.session import freeze

CHUNK, QUERY_BLOCK, TILE = 4096, 256, 512
ROWS = "dim int, number long, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long, dim int"


def scaled(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, dim, norm2): floor(scale * x) as long; without vectors that are null or hold null or non-finite x."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.col(vector_col).isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    )
    rows = vectors.where(fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long")).alias("v"),
    )
    norm = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm2"))


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the eigenvectors of the sum of v v^T, largest eigenvalue first. One matrix per task is summed."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            v, dims = batch.column(0), batch.column(1).to_numpy()
            flat = v.flatten().to_numpy().astype(np.float64)
            ends = np.cumsum(dims)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                m = flat[(ends[rows] - d)[:, None] + np.arange(d)]
                total[int(d)] = total.get(int(d), 0) + m.T @ m
        out = [(d, i, float(x)) for d, m in total.items() for i, x in enumerate(m.ravel())]
        if out:
            kinds = (pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["dim", "i", "x"])

    sums = rows.select("v", "dim").mapInArrow(gram, "dim int, i int, x double").groupBy("dim", "i").agg(F.sum("x").alias("x"))
    by_dim: dict[int, np.ndarray] = {}
    for r in sums.collect():  # one matrix per dimension that occurs
        by_dim.setdefault(r["dim"], np.zeros(r["dim"] ** 2))[r["i"]] = r["x"]
    out = {}
    for d, m in by_dim.items():
        values, vectors = np.linalg.eigh(m.reshape(d, d))
        out[d] = vectors[:, np.argsort(-values)]
    return out


def pack_rows(rows: DataFrame) -> DataFrame:
    """(dim, number, ids, vectors) from (dim, number, vec_id, v): a matrix per group, longest vectors first."""
    item = F.struct((-F.col("norm2")).alias("less"), "vec_id", "v")
    groups = rows.groupBy("dim", "number").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, number, items in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([i["vec_id"] for i in items], np.int64)
                v = np.array([i["v"] for i in items], np.int64).reshape(len(ids), dim)
                yield pa.RecordBatch.from_arrays([
                    pa.array([dim], pa.int32()), pa.array([number], pa.int64()), pa.array([ids.tobytes()], pa.large_binary()),
                    pa.array([v.tobytes()], pa.large_binary()),
                ], ["dim", "number", "ids", "vectors"])

    return groups.mapInArrow(pack, ROWS)


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in whole numbers; of any size where 64 bits could overflow."""
    if len(q) and float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1]) >= 2**62:
        return np.array([sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, v)], object)
    return np.einsum("ij,ij->i", q, v)


def search(ids, q, floors, chunk_ids, chunk, rotation, k):
    """Rows (query place, id, score) of the chunk that can be among the best k of each query.

    floors: a score that each query is known to reach with k other vectors. Vectors come longest first. Bounds are
    floating point, so they are widened by far more than rounding can cost.
    """
    n, d = q.shape
    head = max(1, d // 4)
    qr, vr = q @ rotation, chunk @ rotation
    q_norm, v_norm = np.sqrt((qr * qr).sum(1)), np.sqrt((vr * vr).sum(1))
    q_tail, v_tail = np.sqrt((qr[:, head:] ** 2).sum(1)), np.sqrt((vr[:, head:] ** 2).sum(1))
    slack = 1e-6 * (1 + q_norm * (v_norm.max() if len(v_norm) else 0))
    best: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    floor = np.array(floors, np.float64)
    active = np.arange(n)
    for at in range(0, len(chunk), TILE):
        # the longest vector of the tile bounds all that follow
        active = active[q_norm[active] * v_norm[at] + slack[active] >= floor[active]]
        if not len(active):
            break
        stop = min(at + TILE, len(chunk))
        bound = qr[active, :head] @ vr[at:stop, :head].T + q_tail[active][:, None] * v_tail[at:stop]
        i, j = np.nonzero(bound + slack[active][:, None] >= floor[active][:, None])
        i, j = active[i], j + at
        other = ids[i] != chunk_ids[j]
        i, j = i[other], j[other]
        scores = exact(q[i], chunk[j])
        for x in np.unique(i):
            mine = i == x
            rows = best[x] + list(zip((-scores[mine]).tolist(), chunk_ids[j[mine]].tolist()))
            rows.sort()
            best[x] = rows[:k]
            if len(best[x]) == k:
                floor[x] = max(floor[x], -best[x][-1][0])
    return [(x, vec, -less) for x in range(n) for less, vec in best[x] if -less >= floors[x]]


def run_pass(pairs: DataFrame, rotation: dict[int, np.ndarray], k: int) -> DataFrame:
    """Candidates of every (query block, chunk): columns dim, query_ids, queries, floors, ids, vectors."""
    shared = pairs.sparkSession.sparkContext.broadcast(rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, query_ids, queries, floors, ids, vectors = (c[i].as_py() for c in batch.columns)
                query_ids, ids = np.frombuffer(query_ids, np.int64), np.frombuffer(ids, np.int64)
                q = np.frombuffer(queries, np.int64).reshape(len(query_ids), dim)
                v = np.frombuffer(vectors, np.int64).reshape(len(ids), dim)
                known = {f["query_id"]: f["floor"] for f in floors or []}
                low = [known.get(x, -np.inf) for x in query_ids.tolist()]
                rotation = shared.value[dim] if dim else np.zeros((0, 0))
                found = search(query_ids, q, low, ids, v, rotation, k)
                if found:
                    rows = [(int(query_ids[x]), vec, int(score), dim) for x, vec, score in found]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
                    names = ["query_id", "vec_id", "score", "dim"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return pairs.select("dim", "query_ids", "queries", "floors", "ids", "vectors").mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The best k per query; ties go to the smaller id. Spark drops most rows before they are shuffled."""
    order = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its k best other rows.

    Fewer than k where there are fewer. A vector that is null or holds null or non-finite components takes no part,
    nor does a row without an id. Vectors of different dimension are not compared; those of no components score 0.
    Ids should be unique: rows of one id are never compared with each other, and rows that are equal count once.
    Equal scores go to the smaller id. A score beyond 64 bits raises an error. Other columns are not read.
    """
    rows = freeze(scaled(vectors, scale, id_col, vector_col).where("vec_id IS NOT NULL").dropDuplicates(["vec_id", "v"]), "vectors")
    rotation = rotations(rows)
    # Chunks by length: bounds from a sketch of the lengths cut each dimension into runs of about CHUNK vectors.
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    numbers = {d: max(1, -(-n // CHUNK)) for d, n in sizes.items()}
    spark = rows.sparkSession
    cuts = []
    for d, n in numbers.items():
        share = [i / n for i in range(1, n)]
        found = rows.where(F.col("dim") == d).approxQuantile("norm2", share, 0.1 / n) if share else []
        cuts.append((d, sorted(set(found))))
    cuts = spark.createDataFrame(cuts, "dim int, cuts array<double>")
    longer = F.size(F.filter("cuts", lambda c: c >= F.col("norm2"))).cast("long")
    # vectors of one length that fill more than a chunk are told apart by a hash
    chunked = rows.join(F.broadcast(cuts), "dim").withColumn("number", longer).drop("cuts")
    crowd = chunked.groupBy("dim", "number").agg(F.ceil(F.count("*") / (2 * CHUNK)).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    chunked = chunked.join(crowd, ["dim", "number"]).withColumn("number", F.col("number") * 1_000_000 + part)
    chunks = freeze(pack_rows(chunked.select("dim", "number", "norm2", "vec_id", "v")), "vector-chunks")

    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"))
    dealt = asked.join(blocks, "dim").withColumn("number", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    queries = freeze(
        pack_rows(dealt.select("dim", "number", "norm2", "vec_id", "v")).select(
            "dim", F.col("number").alias("block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")
        ), "query-blocks",
    )
    listed = chunks.select("dim", "number")
    first = listed.groupBy("dim").agg(F.min("number").alias("number"))
    opened = queries.join(first, "dim").join(chunks, ["dim", "number"])
    opening = freeze(run_pass(opened.withColumn("floors", F.lit(None).cast("array<struct<query_id:long,floor:long>>")), rotation, k), "top-first")
    floors = best_of(opening, k).where(F.col("rank") == k).select("dim", F.col("query_id"), F.col("score").alias("floor"))
    placed = dealt.select("dim", F.col("number").alias("block"), F.col("vec_id").alias("query_id"))
    floors = placed.join(floors, ["dim", "query_id"]).groupBy("dim", "block").agg(
        F.collect_list(F.struct("query_id", "floor")).alias("floors")
    )
    rest = listed.join(first.withColumn("is_first", F.lit(True)), ["dim", "number"], "left").where("is_first IS NULL").drop("is_first")
    others = queries.join(floors, ["dim", "block"], "left").join(rest, "dim").join(chunks, ["dim", "number"])
    found = opening.union(run_pass(others, rotation, k))
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")
