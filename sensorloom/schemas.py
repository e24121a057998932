"""Declared schemas, and one naming for fields that producers spell differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names and types of the producers' records.
LOG = "scope string, stream string, segment_id long, offset long, routing_key string, event binary"
SENSOR = "timestamp timestamp, event_type string, device_id string, temp_celsius double"
FORCE = "punchID double, Force double, eventTime timestamp"
FRAME = "timestamp timestamp, frame_number int, camera int, ssrc int, data binary"
HASHED_FRAME = f"{FRAME}, hash binary"
CHUNKED_FRAME = f"{HASHED_FRAME}, chunk_index smallint, final_chunk_index smallint"
FILE_CHUNK = "timestamp timestamp, camera int, ssrc int, chunk int, num_chunks int, data binary"
LOG_CHUNK = (
    "timestamp timestamp, frame_number int, camera int, chunk int, num_chunks int, ssrc int, data binary"
)
GRID_PLAYER = "camera int, data binary"

FRAME_KEY = ["camera", "ssrc", "timestamp", "frame_number"]
FILE_CHUNK_KEY = ["timestamp", "camera", "ssrc"]

# Field names as producers write them, and the name used here.
FIELD_NAMES = {
    "frameNumber": "frame_number",
    "chunkIndex": "chunk_index",
    "finalChunkIndex": "final_chunk_index",
}


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename camel-case fields, and turn (chunk, num_chunks) into (chunk_index, final_chunk_index), as wide as they are."""
    renames = {old: new for old, new in FIELD_NAMES.items() if old in df.columns}
    df = df.withColumnsRenamed(renames)
    if "chunk" in df.columns:
        df = df.withColumn("chunk_index", F.col("chunk")).drop("chunk")
    if "num_chunks" in df.columns:
        df = df.withColumn("final_chunk_index", F.col("num_chunks") - 1).drop("num_chunks")
    return df


def event_time(text: Column) -> Column:
    """A timestamp from text holding either epoch milliseconds or ISO-8601; NULL if it is neither."""
    return F.coalesce(F.timestamp_millis(text.try_cast("bigint")), F.try_to_timestamp(text))
