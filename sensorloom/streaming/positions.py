"""Frame reassembly with payloads outside the state: state knows where chunks lie, the log gives their bytes.

The first tier is a stateful operator over chunk headers and log positions. When a frame is whole, the second
tier reads its chunks from the log by their positions. State and checkpoints stay small at any payload size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType, TimestampType

from sensorloom.functions import codec
from sensorloom.operators.chunks import COUNT, FINAL_MISMATCH, HASH, INDEX_RANGE, MAX_CHUNKS, NO_KEY, SEQUENCE
from sensorloom.sources.sinks import stream_writer

POSITION = ["segment_id", "offset"]
BUCKETS = 64  # of frames: one Python call for each and micro-batch; a query must keep its number over restarts
_NONE = -MAX_CHUNKS - 1  # for a NULL index, which no 16-bit field holds


def track(chunks: DataFrame, keys: list[str], ts: str, delay: str, timeout_millis: int = 10_000, buckets: int = BUCKETS) -> DataFrame:
    """Where the chunks of each whole frame lie: keys, n_chunks, error, places (chunk_index, segment_id, offset).

    ``chunks`` is a stream with ``keys`` (the event time ``ts`` among them), chunk_index, final_chunk_index and
    the log position. A frame comes in the micro-batch that brings its last missing chunk. One that lacks chunks
    comes with an error code and no places ``timeout_millis`` of event time after the last chunk it got, and at once
    if its chunks contradict each other. The key of a finished frame is kept for as long, so that chunks
    delivered again are left out. Chunks without a key come at once, as errors of one row each.

    Frames are dealt to ``buckets`` by a hash of their keys; a bucket's open frames are one state of arrays, and
    all of its frames are judged in one call.
    """
    times = {f.name for f in chunks.select(*keys).schema if isinstance(f.dataType, TimestampType)}
    no_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    index, final = (F.coalesce(F.col(c).cast("int"), F.lit(_NONE)).alias(c) for c in ("chunk_index", "final_chunk_index"))
    marked = chunks.withWatermark(ts, delay)
    rows = marked.filter(~no_key).select(
        ts, *[(F.unix_micros(k) if k in times else F.col(k)).alias(f"key_{i}") for i, k in enumerate(keys)], index, final, *POSITION,
        F.unix_millis(ts).alias("millis")).withColumn("bucket", F.pmod(F.xxhash64(*[f"key_{i}" for i in range(len(keys))]), F.lit(buckets)).cast("int"))
    names = [f"key_{i}" for i in range(len(keys))]
    columns = [*names, "chunk_index", "final_chunk_index", *POSITION]
    kinds = {f.name: f.dataType.simpleString() for f in rows.select(*columns).schema}
    places = "places array<struct<chunk_index: int, segment_id: bigint, offset: bigint>>"
    out = StructType.fromDDL(", ".join([*(f"{n} {kinds[n]}" for n in names), "n_chunks bigint, error string", places]))
    state_schema = ", ".join([*(f"{n} array<{kinds[n]}>" for n in columns), "expires array<bigint>",
                              *(f"finished_{n} array<{kinds[n]}>" for n in names), "finished_expires array<bigint>"])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else tuple([] for _ in range(len(columns) + len(names) + 2))
        held = pd.DataFrame(dict(zip([*columns, "expires"], kept, strict=False)))
        finished = pd.DataFrame(dict(zip([*names, "expires"], kept[len(columns) + 1:], strict=True)))
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            new = pd.concat(list(batches))
            new["expires"] = np.maximum(new["millis"], now) + timeout_millis
            if len(finished):
                done = pd.MultiIndex.from_frame(new[names]).isin(pd.MultiIndex.from_frame(finished[names]))
                new = new[~done]
            held = pd.concat([held, new[[*columns, "expires"]]], ignore_index=True) if len(held) else new[[*columns, "expires"]]
        ended = pd.DataFrame(columns=[*names, "expires"])
        if len(held):
            found = _judged(held, names)
            gone = ~found["waits"] | (found["expires"] <= now)
            whole = found["error"].isna()
            ended = found[gone]
            placed = held.merge(ended.loc[whole[gone], names], on=names).sort_values("chunk_index", kind="stable")
            listed = _listed(placed, names)
            if len(ended):
                yield pd.DataFrame({
                    **{n: ended[n] for n in names}, "n_chunks": ended["n_rows"], "error": ended["error"],
                    "places": [listed.get(k) for k in ended[names].itertuples(index=False, name=None)]})
                held = held.merge(found.loc[~gone, names], on=names)
        finished = pd.concat([finished, ended[[*names, "expires"]]]) if len(finished) else ended[[*names, "expires"]]
        finished = finished[finished["expires"] > now]
        if not len(held) and not len(finished):
            state.remove()
            return
        state.update(tuple([*(held[c].tolist() for c in [*columns, "expires"]), *(finished[c].tolist() for c in [*names, "expires"])]))
        state.setTimeoutTimestamp(max(now + 1, int(min([*held["expires"], *finished["expires"]]))))

    tracked = rows.groupBy("bucket").applyInPandasWithState(step, out, state_schema, "append", GroupStateTimeout.EventTimeTimeout)

    def given(i: int, k: str) -> Column:
        return (F.timestamp_micros(f"key_{i}") if k in times else F.col(f"key_{i}")).alias(k)

    found = tracked.select(*[given(i, k) for i, k in enumerate(keys)], "n_chunks", "error", "places")
    lost = marked.filter(no_key).select(*keys, F.lit(1).cast("bigint").alias("n_chunks"), F.lit(NO_KEY).alias("error"),
                                        F.lit(None).cast(out["places"].dataType).alias("places"))
    return found.unionByName(lost)


def _listed(placed: pd.DataFrame, names: list[str]) -> dict[tuple, list[dict]]:
    """The places of each frame's chunks, in the order of the rows: one pass, as a group of pandas for each frame is slow."""
    listed: dict[tuple, list[dict]] = {}
    keys = placed[names].itertuples(index=False, name=None)
    for key, index, segment, offset in zip(keys, *(placed[c].tolist() for c in ["chunk_index", *POSITION]), strict=True):
        listed.setdefault(key, []).append({"chunk_index": index, "segment_id": segment, "offset": offset})
    return listed


def _judged(rows: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """A row for each frame with the error code of ``chunks.frame_status``, and whether it may still become whole."""
    index = rows["chunk_index"].where(rows["chunk_index"] != _NONE)
    final = rows["final_chunk_index"].where(rows["final_chunk_index"] != _NONE)
    found = rows.assign(i=index, f=final).groupby(names, sort=False, as_index=False).agg(
        n_rows=("chunk_index", "size"), distinct=("i", "nunique"), first=("i", "min"), last=("i", "max"),
        low=("f", "min"), high=("f", "max"), expires=("expires", "max"))
    contiguous = (found["first"] == 0) & (found["last"] == found["n_rows"] - 1) & (found["distinct"] == found["n_rows"])
    found["error"] = np.select(
        [~(found["low"] == found["high"]), (found["first"] < 0) | (found["last"] > found["high"]), ~contiguous,
         found["n_rows"] != found["high"] + 1], [FINAL_MISMATCH, INDEX_RANGE, SEQUENCE, COUNT], "")
    found["error"] = found["error"].where(found["error"] != "", None)
    found["waits"] = found["error"].isin([SEQUENCE, COUNT]) & (found["distinct"] == found["n_rows"])
    return found


def fetch(found: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """The frames of ``track`` with their payloads: keys, n_chunks, data, error.

    ``log`` has the position, ``data`` and ``hash``. Its scan gets the least and the greatest offset that is asked
    for as a filter; positions are joined (by broadcast where Spark finds them small), and payloads are shuffled
    once, by frame.
    """
    places = found.filter(F.col("error").isNull()).select(*keys, "n_chunks", F.inline("places"))
    span = places.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
    near = log.filter(F.col("offset").between(span["low"], span["high"])) if span["low"] is not None else log.filter(F.lit(False))
    chunks = near.select(*POSITION, "data", "hash").join(places, POSITION)
    whole = chunks.groupBy(*keys, "n_chunks").agg(
        F.expr("listagg(data) WITHIN GROUP (ORDER BY chunk_index)").alias("data"), F.min_by("hash", "chunk_index").alias("hash"))
    valid = F.col("hash").isNull() | codec.is_hash_valid(F.col("data"), F.col("hash"))
    failed = found.filter(F.col("error").isNotNull()).groupBy(*keys, "error").agg(F.sum("n_chunks").alias("n_chunks"))
    return whole.select(*keys, "n_chunks", F.when(valid, F.col("data")).alias("data"), F.when(~valid, HASH).alias("error")).unionByName(
        failed.select(*keys, "n_chunks", F.lit(None).cast("binary").alias("data"), "error"))


def reassemble_to_table(chunks: DataFrame, log: Callable[[SparkSession], DataFrame], keys: list[str], ts: str, delay: str,
                        path: str, checkpoint: str, timeout_millis: int = 10_000, interval: str | None = None,
                        buckets: int = BUCKETS) -> StreamingQuery:
    """Write frames (keys, n_chunks, data, error) to ``path``/frames, a folder per micro-batch that replaces itself.

    ``chunks`` is the log as a stream, of which only headers and positions are read; ``log`` gives it as a table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{path}/found/batch={batch_id}"
        batch.write.mode("overwrite").parquet(place)
        found = spark.read.schema(batch.schema).parquet(place)
        fetch(found, log(spark), keys).write.mode("overwrite").parquet(f"{path}/frames/batch={batch_id}")

    tracked = track(chunks, keys, ts, delay, timeout_millis, buckets)
    return stream_writer(tracked, checkpoint, interval).foreachBatch(write).start()
