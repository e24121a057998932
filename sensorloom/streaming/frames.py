"""Frame reassembly per micro-batch with built-in operators, for high rates.

``state.reassemble`` takes payloads through Python and its state. Here each micro-batch is one batch job over its chunks and
those that earlier batches left over, so that frames still come out as soon as they are complete.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensorloom.functions import codec
from sensorloom.operators import chunks as ops
from sensorloom.sources.sinks import stream_writer


def reassemble_to_table(chunks: DataFrame, keys: list[str], ts: str, path: str, checkpoint: str,
                        timeout_millis: int = 10_000, interval: str | None = None) -> StreamingQuery:
    """Write frames (keys, n_chunks, data, error) to ``path``/frames, a folder per micro-batch.

    A frame that lacks chunks waits until an event ``timeout_millis`` later than it has come; then, and at
    once if its chunks contradict each other, it becomes a row with an error code and no data. Waiting
    chunks are in ``path``/pending, and the keys of finished frames in ``path``/done for as long, so that chunks
    delivered again are left out. There are two folders of each, in turns: a batch reads what the one before
    it wrote and writes the other, so that a repeated batch does the same again.
    """
    columns = list(dict.fromkeys([*keys, "chunk_index", "final_chunk_index", "data", "hash"]))
    chunks = chunks.select(*columns)
    schema = chunks.schema

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        this, previous = batch_id % 2, (batch_id + 1) % 2
        held, latest = batch, batch.agg(F.max(ts).alias("latest"))
        finished = batch.select(*keys).limit(0)
        if batch_id > 0:
            finished = spark.read.schema(finished.schema).parquet(f"{path}/done/{previous}")
            held = held.join(finished, keys, "left_anti")
            held = held.unionByName(spark.read.schema(schema).parquet(f"{path}/pending/{previous}"))
            latest = latest.unionByName(spark.read.schema(latest.schema).parquet(f"{path}/latest/{previous}"))
        held = held.persist(StorageLevel.DISK_ONLY)
        try:
            latest = latest.agg(F.max("latest").alias("latest"))
            latest.write.mode("overwrite").parquet(f"{path}/latest/{this}")
            now = spark.read.schema(latest.schema).parquet(f"{path}/latest/{this}").scalar()
            expired = F.unix_millis(F.col(ts)) + timeout_millis <= F.unix_millis(now)
            waits = F.col("is_waiting") & ~F.coalesce(expired, F.lit(False))
            status = ops.frame_status(held, keys)
            failed = status.filter(F.col("error").isNotNull() & ~waits).select(
                *keys, F.col("n_rows").alias("n_chunks"), F.lit(None).cast("binary").alias("data"), "error")
            whole = ops.reassemble(held, keys, carry=["hash"])
            valid = F.col("hash").isNull() | codec.is_hash_valid(F.col("data"), F.col("hash"))
            frames = whole.select(*keys, "n_chunks", F.when(valid, F.col("data")).alias("data"),
                                  F.when(~valid, ops.HASH).alias("error"))
            frames.unionByName(failed).write.mode("overwrite").parquet(f"{path}/frames/batch={batch_id}")
            written = spark.read.schema(frame_schema(held, keys)).parquet(f"{path}/frames/batch={batch_id}")
            ended = finished.unionByName(written.select(*keys)).filter(~F.coalesce(expired, F.lit(True)))
            ended.write.mode("overwrite").parquet(f"{path}/done/{this}")
            pending = held.join(status.filter(waits).select(*keys), keys, "left_semi").select(*columns)
            pending.write.mode("overwrite").parquet(f"{path}/pending/{this}")
        finally:
            held.unpersist()

    return stream_writer(chunks, checkpoint, interval).foreachBatch(step).start()


def frame_schema(chunks: DataFrame, keys: list[str]) -> StructType:
    """The schema of the frames table."""
    return StructType([*chunks.select(*keys).schema, *StructType.fromDDL(
        "n_chunks bigint, data binary, error string")])
