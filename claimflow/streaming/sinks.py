"""Running a stream until all available input is done, and the append sink."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from claimflow.session import ROCKSDB, STORED


def run_available_now(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is there, in as many micro-batches as it takes, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_sink(sdf: DataFrame, path: str, ckpt: str) -> DataStreamWriter:
    """Writer that appends each row exactly once, across restarts with the same checkpoint."""
    return (
        sdf.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
        .option("path", path).option("compression", STORED)
    )


@contextmanager
def stream_state(spark: SparkSession, partitions: int | None = None):
    """Streams started inside keep their state in RocksDB, off the heap, in `partitions` partitions.

    A stream keeps both choices of its first run for good, so size it for the state to come.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
