"""Session settings, shuffle sizing and the shared working folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SPLIT = "spark.sql.files.maxPartitionBytes"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Codec of stored tables; claims take about half of what Spark's default gives.
STORED = "zstd"
# A reducer of 512 MB sorts in executor memory or spills once.
SHUFFLE_TARGET_BYTES = 512 << 20
# Bytes of rows in a sort per byte of a stored table: 18 bytes of a line item become a claim of some 600.
EXPANSION = 32
# So a split of Spark's 128 MB would sort as several GB.
SPLIT_BYTES = 32 << 20


def build_session(app: str = "claimflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package is tuned for; keyword values override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Total file size below the paths. Only the listing is read, no file content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def shuffle_partitions_for(n_bytes: int, at_least: int = 1) -> int:
    return max(at_least, math.ceil(n_bytes / SHUFFLE_TARGET_BYTES))


def fit_shuffle(spark: SparkSession, *paths: str) -> int:
    """Let AQE start from a partition count that fits the rows of the input; it merges small ones itself.

    Scans are split finer too, as rows are sorted before a shuffle as well.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions_for(EXPANSION * stored_bytes(spark, *paths), at_least=current)
    if wanted > current:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    if split_bytes(spark) > SPLIT_BYTES:
        spark.conf.set(MAX_SPLIT, str(SPLIT_BYTES))
    return wanted


def split_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(MAX_SPLIT))


@contextmanager
def whole_splits(spark: SparkSession, n_bytes: int = 2 * SPLIT_BYTES):
    """Scans inside take splits of up to `n_bytes`, for rows that are written as they come: in fewer files."""
    before = spark.conf.get(MAX_SPLIT)
    spark.conf.set(MAX_SPLIT, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(MAX_SPLIT, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_dir
    if _local_dir is None or not os.path.isdir(_local_dir):
        _local_dir = tempfile.mkdtemp(prefix="claimflow-")
    return _local_dir


_local_dir: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/claimflow/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_tables():
    """Collects the paths of the tables that `freeze` writes inside."""
    made: list[str] = []
    _listening.append(made)
    try:
        yield made
    finally:
        _listening.remove(made)


_listening: list[list[str]] = []


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back.

    Unlike a cached frame it survives lost executors, and its real size is known to the
    planner, so a later join broadcasts it only when it is truly small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for made in _listening:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
