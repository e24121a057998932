"""The given tables as readings, event logs, payload frames and pixel frames.

Readings and the log come from ``events``, payload frames from the whole texts of ``documents``, pixel
frames from ``embeddings`` (64 values = 8x8). For every Spark form there is the SQL form for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import codec
from sensorloom.functions import frames as px
from sensorloom.operators import chunks
from sensorloom.workspace import configure

SEGMENTS = 4
CHUNK_BYTES = 512
CAMERAS = 9
FRAME_MILLIS = 200
TILE = 8
MAX_TRAVEL = 900  # seconds
EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """The table as a stream. The pattern matches a single file as well as a folder of files."""
    reader = configure(spark).readStream.schema(table(spark, sf_dir, name).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def readings(events: DataFrame) -> DataFrame:
    """device_id, timestamp (with zone, as watermarks need it), temp_celsius, event_type, event_id."""
    return events.select(
        "event_id", F.col("user_id").alias("device_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type", F.col("value").alias("temp_celsius"),
    )


def arrivals(events: DataFrame) -> DataFrame:
    """device_id and a fixed arrival: the event's time and up to ``MAX_TRAVEL`` seconds on its way."""
    travel = F.make_dt_interval(secs=(F.col("event_id") * 7919 % MAX_TRAVEL).cast("decimal(18,6)"))
    return events.select("event_id", F.col("user_id").alias("device_id"), (F.col("ts").cast("timestamp") + travel).alias("arrival"))


ARRIVALS_SQL = f"SELECT event_id, user_id, ts + to_seconds(event_id * 7919 % {MAX_TRAVEL}) AS ts FROM events"


def log(events: DataFrame) -> DataFrame:
    """An event log: a segment per device, offsets without gaps over all segments, JSON events."""
    return events.select(
        (F.col("user_id") % SEGMENTS).alias("segment_id"),
        F.col("event_id").alias("offset"),
        codec.routing_key(F.col("user_id")).alias("routing_key"),
        codec.encode_json("event_id", "user_id", "event_type").alias("event"),
    )


LOG_SQL = f"SELECT user_id % {SEGMENTS} AS segment_id, event_id AS \"offset\", user_id, ts, event_type FROM events"


def payloads(documents: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Frames with key (doc_id, timestamp): the UTF-8 bytes of each text, and their hash."""
    return documents.select(
        "doc_id",
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("timestamp"),
        F.encode("text", "UTF-8").alias("data"),
        *(carry or []),
    ).withColumn("hash", codec.frame_hash(F.col("data")))


def payload_chunks(documents: DataFrame, carry: list[str] | None = None) -> DataFrame:
    return chunks.split(payloads(documents, carry), CHUNK_BYTES)


CHUNKS_SQL = f"""
    SELECT doc_id, c AS chunk_index, n - 1 AS final_chunk_index,
           array_slice(b, c * {CHUNK_BYTES} + 1, least((c + 1) * {CHUNK_BYTES}, octet_length(b))) AS data
    FROM (SELECT doc_id, b, n, unnest(range(n)) AS c FROM (
        SELECT doc_id, encode(text) AS b,
               greatest(1, (octet_length(encode(text)) + {CHUNK_BYTES - 1}) // {CHUNK_BYTES}) AS n
        FROM documents))
"""


def pixel_frames(embeddings: DataFrame) -> DataFrame:
    """camera, frame_number, ssrc, timestamp and pixels (grey values) of 8x8 frames, 5 per second."""
    frame = F.floor(F.col("vec_id") / CAMERAS)
    start = F.unix_millis(F.lit(EPOCH).cast("timestamp"))
    return embeddings.select(
        (F.col("vec_id") % CAMERAS).cast("int").alias("camera"),
        frame.cast("int").alias("frame_number"),
        F.col("label").alias("ssrc"),
        F.timestamp_millis(start + frame * FRAME_MILLIS).alias("timestamp"),
        px.to_pixels(F.col("embedding")).alias("pixels"),
    )


FRAMES_SQL = f"""
    SELECT (vec_id % {CAMERAS})::INT AS camera, (vec_id // {CAMERAS})::INT AS frame_number, label AS ssrc,
           TIMESTAMP '{EPOCH}' + to_milliseconds((vec_id // {CAMERAS}) * {FRAME_MILLIS}) AS ts,
           list_transform(embedding, lambda v: round((v::DOUBLE + 1) * 127.5)::INT) AS pixels
    FROM embeddings
"""


def plain(column: str) -> Column:
    """A timestamp without zone, as the given tables have it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def scaled(value: Column, digits: int) -> Column:
    """A double in whole units of 10**-digits, to compare engines that add up in different orders.

    The border lies off the half, where exact decimal ties would fall to either side.
    """
    return F.floor(value * 10**digits + 0.4999).cast("bigint")


def scaled_sql(value: str, digits: int) -> str:
    return f"floor(({value}) * {10**digits} + 0.4999::DOUBLE)::BIGINT"
