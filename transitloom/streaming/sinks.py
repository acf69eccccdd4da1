"""Sinks of the streaming jobs. Every one appends and keeps a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(df: DataFrame, writer, available_now: bool) -> StreamingQuery:
    """Start with state in RocksDB, whatever session this is: the states of alerts and weather
    have several column families, which Spark's default store refuses.

    The query takes over the session's setting only while it is starting up in its own thread,
    so the setting stays. A checkpoint keeps the store it began with.
    """
    df.sparkSession.conf.set(_STATE_STORE, _ROCKSDB)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_files(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to a parquet folder; the sink's log makes replays harmless."""
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _start(df, writer, available_now)


def start_console(df: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Print the first rows of each micro-batch, to look at a stream."""
    writer = df.writeStream.format("console").outputMode("append").option("truncate", "true")
    return _start(df, writer.option("checkpointLocation", checkpoint), available_now)


def table_writer(path: str) -> BatchWriter:
    """Write each micro-batch to its own ``epoch_id`` folder; a replay overwrites it.

    The folder belongs to one checkpoint: with another one the numbers start over.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch_id={epoch_id}")

    return write


def count_writer(path: str, keys: Sequence[str]) -> BatchWriter:
    """Write the row counts of each micro-batch by ``keys``, in the same way."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        counts = batch.groupBy(*keys).agg(F.count("*").alias("row_count"))
        counts.write.mode("overwrite").parquet(f"{path}/epoch_id={epoch_id}")

    return write


def start_fan_out(
    df: DataFrame, writers: Sequence[BatchWriter], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """One query feeding several sinks: the source is read and joined once per micro-batch.

    For that a micro-batch is kept while the sinks write it; a single sink gets it as it comes.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        if len(writers) == 1:
            writers[0](batch, epoch_id)
            return
        batch.persist()
        try:
            for writer in writers:
                writer(batch, epoch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).outputMode("append")
    return _start(df, writer.option("checkpointLocation", checkpoint), available_now)


def wait_for_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until one of the session's queries ends, failing if it failed."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)
