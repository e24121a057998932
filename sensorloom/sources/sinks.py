"""Batch and streaming sinks. Streaming sinks return the started query."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sensorloom.functions import codec
from sensorloom.workspace import STREAMING_CONF, configure


def to_events(df: DataFrame, key: Column, *columns: str) -> DataFrame:
    """JSON events with their routing key."""
    return df.select(key.alias("routing_key"), codec.encode_json(*columns).alias("event"))


def write_routed(df: DataFrame, path: str, order: list[str], mode: str = "append") -> None:
    """Write so that the events of a routing key stand in order.

    Ranges of (key, order) rather than the hash of the key: a hot key is spread over several files, which
    follow each other in file order, and no task gets all of it.
    """
    columns = ["routing_key", *order]
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; times with microseconds, which the default format would cut off."""
    df.write.mode(mode).format("json").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").save(path)


def write_per_frame(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder with one file per camera and frame, holding its bytes.

    The number of files is what takes time, so the partitions are given by number: adaptive execution would
    join them by size and leave all files to a few tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(tasks, "camera", "frame_number").write.mode(mode).partitionBy("camera", "frame_number").parquet(path)


def stream_writer(df: DataFrame, checkpoint: str, interval: str | None) -> DataStreamWriter:
    """Append, with the state of a long-running stream off the heap (``workspace.STREAMING_CONF``)."""
    configure(df.sparkSession, STREAMING_CONF)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


@contextmanager
def no_idle_batches(spark: SparkSession) -> Iterator[None]:
    """Streams started in it have no micro-batches without input, which only move the watermark on.

    For streams whose results need none, as those of an inner join: its old state goes with the next input, and at the
    end of a bounded source it is not taken apart row by row.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stream_to_console(df: DataFrame, checkpoint: str, interval: str | None = "3 seconds") -> StreamingQuery:
    return stream_writer(df, checkpoint, interval).format("console").option("truncate", "false").start()


def stream_to_table(df: DataFrame, path: str, checkpoint: str, interval: str | None = None,
                    partition_by: list[str] | None = None) -> StreamingQuery:
    """Exactly-once Parquet; with no interval, process what is there and stop."""
    writer = stream_writer(df, checkpoint, interval).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def stream_to_batches(df: DataFrame, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame],
                      interval: str | None = None) -> StreamingQuery:
    """Write each micro-batch, after ``prepare``, to a folder of its own: a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream_writer(df, checkpoint, interval).foreachBatch(write).start()


def stream_routed(numbered: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write a stream of events with ``routing_key`` and ``position`` (``state.number_events``) so that keys stand in order.

    A micro-batch is a folder, laid out as by ``write_routed``; a repeated one has the same positions and replaces
    itself. The events of a key, folder after folder, have no gaps.
    """
    columns = ["routing_key", "position"]

    def ordered(batch: DataFrame) -> DataFrame:
        return batch.repartitionByRange(*columns).sortWithinPartitions(*columns)

    return stream_to_batches(numbered, path, checkpoint, ordered, interval)


def stream_to_rows(df: DataFrame, handler, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Call ``handler`` (a function, or an object with open/process/close) for each row."""
    return stream_writer(df, checkpoint, interval).foreach(handler).start()


def sample(df: DataFrame, order: list[str], n: int, cached: bool = False) -> DataFrame:
    """The first ``n`` rows in a defined order; optionally kept for interactive use."""
    top = df.orderBy(*order).limit(n)
    return top.cache() if cached else top


def shuffled(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """All rows in a random order that depends on the keys and the seed only, not on the partitioning."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys)
