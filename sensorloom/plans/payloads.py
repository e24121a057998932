"""Chunking, reassembly, integrity checks, chunk joins, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import codec
from sensorloom.operators import chunks
from sensorloom.plans.tables import (
    CHUNK_BYTES, CHUNKS_SQL, SEGMENTS, payload_chunks, payloads, plain, readings, table,
)
from sensorloom.sources import log as logs

FAULTS = 11
JOIN_CHUNKS = 3
# Offsets leave room for 32,768 chunks per document: a block has 64 documents.
LOG_BLOCK_BITS = 21
WRITERS = 4


def chunk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = payload_chunks(table(spark, sf_dir, "documents"))
    return parts.select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"),
                        F.col("final_chunk_index").cast("int").alias("final_chunk_index"),
                        F.octet_length("data").alias("n_bytes"), F.hex("data").alias("data_hex"))


def chunk_v1_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunked events, their header fields, and the payload bytes behind the header."""
    frames = payloads(table(spark, sf_dir, "documents")).select("doc_id", "data")
    parsed = chunks.parse_v1(chunks.split_v1(frames, codec.V1_SLICE_OVERHEAD + CHUNK_BYTES))
    return parsed.select("doc_id", F.col("version").cast("int").alias("version"),
                         F.col("chunk_index").cast("int").alias("chunk_index"),
                         F.col("final_chunk_index").cast("int").alias("final_chunk_index"),
                         F.sha1("data").alias("data_sha1"))


def chunk_v1_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads from a log of chunked events, found by their order in each segment alone."""
    frames = payloads(table(spark, sf_dir, "documents")).select("doc_id", "data")
    events = chunks.split_v1(frames, codec.V1_SLICE_OVERHEAD + CHUNK_BYTES)
    index = codec.v1_fields(F.col("event"))["chunk_index"]
    log = events.select((F.col("doc_id") % SEGMENTS).alias("segment_id"),
                        (F.col("doc_id") * chunks.MAX_CHUNKS + index).alias("offset"), "event")
    whole = logs.scan_payloads(log, "chunked_v1", LOG_BLOCK_BITS, payload_bits=LOG_BLOCK_BITS)
    return whole.select("segment_id", "offset", "n_chunks", F.sha1("data").alias("data_sha1"))


def _interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which four writers take turns in each segment: each sends one document's chunks at a time."""
    frames = payloads(table(spark, sf_dir, "documents")).select("doc_id", "data")
    events = chunks.split_v1(frames, codec.V1_SLICE_OVERHEAD + CHUNK_BYTES)
    turn, writer = F.floor(F.col("doc_id") / WRITERS), F.col("doc_id") % WRITERS
    index = codec.v1_fields(F.col("event"))["chunk_index"]
    return events.select((turn % SEGMENTS).alias("segment_id"), ((turn * chunks.MAX_CHUNKS + index) * WRITERS + writer).alias("offset"),
                         codec.routing_key(writer).alias("routing_key"), "event")


def chunk_v1_scan_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads from a log in which several writers interleave, told apart by routing key."""
    whole = logs.scan_payloads(_interleaved(spark, sf_dir), "chunked_v1", LOG_BLOCK_BITS, by="routing_key", payload_bits=LOG_BLOCK_BITS)
    return whole.select("segment_id", "offset", "n_chunks", F.sha1("data").alias("data_sha1"))


def chunk_v1_scan_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the key, by the headers alone."""
    log = _interleaved(spark, sf_dir).drop("routing_key")
    whole = logs.scan_payloads(log, "chunked_v1", writers=WRITERS, payload_bits=LOG_BLOCK_BITS)
    return whole.select("segment_id", "offset", "n_chunks", F.sha1("data").alias("data_sha1"))


def chunk_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = payload_chunks(table(spark, sf_dir, "documents"))
    frames = chunks.check_hash(chunks.reassemble(parts, ["doc_id", "timestamp"], carry=["hash"]))
    return frames.select("doc_id", plain("timestamp"), "n_chunks", F.octet_length("data").alias("n_bytes"),
                         F.lower(F.hex("hash")).alias("hash_hex"), F.sha1("data").alias("data_sha1"),
                         "is_hash_valid")


def _with_faults(parts: DataFrame) -> DataFrame:
    """Chunks of which some frames lack one, have one twice, or have a wrong index."""
    fault = F.col("doc_id") % FAULTS
    index, final = F.col("chunk_index"), F.col("final_chunk_index")
    last = (index == final) & (final >= 1)
    lost = ((fault == 1) & (index == 1) & (final >= 2)) | ((fault == 2) & last)
    copies = F.when((fault == 3) & (index == 0), 2).otherwise(1)
    return parts.filter(~lost).withColumns({
        "chunk_index": F.when((fault == 5) & last, index + 5).otherwise(index).cast("smallint"),
        "final_chunk_index": F.when((fault == 4) & last, final + 1).otherwise(final).cast("smallint"),
        "_copy": F.explode(F.sequence(F.lit(1), copies)),
    }).drop("_copy")


def chunk_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _with_faults(payload_chunks(table(spark, sf_dir, "documents")))
    return chunks.errors(parts, ["doc_id"]).select("doc_id", "n_rows", "error")


def chunk_reassemble_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good frames next to the bad ones of ``chunk_errors``."""
    parts = _with_faults(payload_chunks(table(spark, sf_dir, "documents")))
    return chunks.reassemble(parts, ["doc_id"]).select("doc_id", "n_chunks", F.sha1("data").alias("data_sha1"))


def thirds(documents: DataFrame) -> DataFrame:
    """Chunks of a third of each text (rounded up), so that frames have one, two or three."""
    frames = payloads(documents).select("doc_id", "timestamp", "data")
    n_bytes = F.octet_length("data")
    size = F.greatest(F.lit(1), F.ceil(n_bytes / JOIN_CHUNKS)).cast("int")
    n = F.greatest(F.lit(1), F.ceil(n_bytes / size)).cast("int")
    indexed = frames.withColumns({"_size": size, "_n": n}).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return indexed.select("doc_id", "timestamp", F.col("_i").cast("smallint").alias("chunk_index"),
                          (F.col("_n") - 1).cast("smallint").alias("final_chunk_index"),
                          F.col("data").substr(F.col("_i") * F.col("_size") + 1, F.col("_size")).alias("data"))


def chunk_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of exactly three chunks, by a three-way join."""
    parts = thirds(table(spark, sf_dir, "documents")).filter(F.col("final_chunk_index") == JOIN_CHUNKS - 1)
    joined = chunks.join_chunks(parts, ["doc_id"], JOIN_CHUNKS)
    return joined.select("doc_id", F.sha1(chunks.concat_chunks(JOIN_CHUNKS, null_safe=False)).alias("data_sha1"))


def chunk_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of up to three chunks; the plain concatenation is NULL where there are fewer."""
    parts = thirds(table(spark, sf_dir, "documents")).filter(F.col("final_chunk_index") <= JOIN_CHUNKS - 1)
    joined = chunks.join_chunks(parts, ["doc_id"], JOIN_CHUNKS, "left")
    return joined.select("doc_id",
                         F.sha1(chunks.concat_chunks(JOIN_CHUNKS, null_safe=False)).alias("plain_sha1"),
                         F.sha1(chunks.concat_chunks(JOIN_CHUNKS, null_safe=True)).alias("safe_sha1"))


def dedup_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per device and hour: the one with the least event id."""
    rows = readings(table(spark, sf_dir, "events")).withColumn("hour", F.date_trunc("hour", "timestamp"))
    kept = chunks.dedup_frames(rows.select("hour", "device_id", "event_id", "temp_celsius"),
                               ["hour", "device_id"], ["event_id"], place=["event_id"])
    return kept.withColumn("hour", plain("hour"))


def _damaged(data: Column) -> Column:
    """Payload behind its checksum, with the checksum of every seventh document turned over."""
    stored = codec.with_checksum(data)
    flipped = F.concat(F.unhex(F.lpad(F.hex(F.bitwise_not(codec.checksum(stored)).bitwiseAND(0xFFFFFFFF)), 8, "0")),
                       codec.checked_payload(stored))
    return F.when(F.col("doc_id") % 7 == 0, flipped).otherwise(stored)


def crc_prefix_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = payloads(table(spark, sf_dir, "documents")).select("doc_id", _damaged(F.col("data")).alias("data"))
    return frames.select("doc_id", codec.is_checksum_correct(F.col("data")).alias("is_checksum_correct"),
                         F.octet_length(codec.checked_payload(F.col("data"))).alias("n_bytes"),
                         F.sha1(codec.checked_payload(F.col("data"))).alias("data_sha1"))


def frame_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = payloads(table(spark, sf_dir, "documents"))
    return frames.select("doc_id", F.lower(F.hex("hash")).alias("hash_hex"))


QUERIES = {f.__name__: f for f in (
    chunk_split, chunk_v1_roundtrip, chunk_v1_scan, chunk_v1_scan_by_key, chunk_v1_scan_matched, chunk_reassemble, chunk_errors, chunk_reassemble_with_faults,
    chunk_join_inner, chunk_join_left, dedup_frames, crc_prefix_check, frame_hash,
)}

_FAULTY_SQL = f"""
    SELECT doc_id,
           CASE WHEN doc_id % {FAULTS} = 5 AND c = f AND f >= 1 THEN c + 5 ELSE c END AS chunk_index,
           CASE WHEN doc_id % {FAULTS} = 4 AND c = f AND f >= 1 THEN f + 1 ELSE f END AS final_chunk_index
    FROM (SELECT doc_id, chunk_index AS c, final_chunk_index AS f,
                 unnest(range(CASE WHEN doc_id % {FAULTS} = 3 AND chunk_index = 0 THEN 2 ELSE 1 END)) AS copy
          FROM ({CHUNKS_SQL}))
    WHERE NOT (doc_id % {FAULTS} = 1 AND c = 1 AND f >= 2) AND NOT (doc_id % {FAULTS} = 2 AND c = f AND f >= 1)
"""
_STATUS_SQL = f"""
    SELECT doc_id, count(*) AS n_rows,
           CASE WHEN min(final_chunk_index) <> max(final_chunk_index) THEN '{chunks.FINAL_MISMATCH}'
                WHEN min(chunk_index) < 0 OR max(chunk_index) > max(final_chunk_index) THEN '{chunks.INDEX_RANGE}'
                WHEN list(chunk_index ORDER BY chunk_index) <> range(count(*)) THEN '{chunks.SEQUENCE}'
                WHEN count(*) <> max(final_chunk_index) + 1 THEN '{chunks.COUNT}' END AS error
    FROM ({_FAULTY_SQL}) GROUP BY doc_id
"""
_N_SQL = f"greatest(1, (octet_length(encode(text)) + {CHUNK_BYTES - 1}) // {CHUNK_BYTES})"
_THIRDS_SQL = f"""
    SELECT doc_id, b, s, greatest(1, (octet_length(b) + s - 1) // s) AS n
    FROM (SELECT doc_id, encode(text) AS b,
                 greatest(1, (octet_length(encode(text)) + {JOIN_CHUNKS - 1}) // {JOIN_CHUNKS}) AS s FROM documents)
"""

_INTERLEAVED_SQL = f"""
    SELECT doc_id // {WRITERS} % {SEGMENTS} AS segment_id,
           doc_id // {WRITERS} * {chunks.MAX_CHUNKS * WRITERS} + doc_id % {WRITERS} AS "offset",
           {_N_SQL}::BIGINT AS n_chunks, sha1(encode(text)) AS data_sha1
    FROM documents WHERE octet_length(encode(text)) > 0
"""

ORACLES = {
    "chunk_v1_scan_by_key": _INTERLEAVED_SQL,
    "chunk_v1_scan_matched": _INTERLEAVED_SQL,
    "chunk_split": f"""
        SELECT doc_id, chunk_index::INT AS chunk_index, final_chunk_index::INT AS final_chunk_index,
               octet_length(data)::INT AS n_bytes, hex(data) AS data_hex FROM ({CHUNKS_SQL})""",
    "chunk_v1_roundtrip": f"""
        SELECT doc_id, 1 AS version, chunk_index::INT AS chunk_index, final_chunk_index::INT AS final_chunk_index,
               sha1(data) AS data_sha1
        FROM ({CHUNKS_SQL}) WHERE octet_length(data) > 0""",
    "chunk_v1_scan": f"""
        SELECT doc_id % {SEGMENTS} AS segment_id, doc_id * {chunks.MAX_CHUNKS} AS "offset",
               {_N_SQL}::BIGINT AS n_chunks, sha1(encode(text)) AS data_sha1
        FROM documents WHERE octet_length(encode(text)) > 0""",
    "chunk_reassemble": f"""
        SELECT doc_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS timestamp, {_N_SQL}::BIGINT AS n_chunks,
               octet_length(encode(text))::INT AS n_bytes, substr(sha1(encode(text)), 1, 12) AS hash_hex,
               sha1(encode(text)) AS data_sha1, true AS is_hash_valid
        FROM documents""",
    "chunk_errors": f"SELECT * FROM ({_STATUS_SQL}) WHERE error IS NOT NULL",
    "chunk_reassemble_with_faults": f"""
        SELECT s.doc_id, n_rows AS n_chunks, sha1(encode(d.text)) AS data_sha1
        FROM ({_STATUS_SQL}) s JOIN documents d ON s.doc_id = d.doc_id WHERE error IS NULL""",
    "chunk_join_inner": f"""
        SELECT doc_id, sha1(b) AS data_sha1 FROM ({_THIRDS_SQL}) WHERE n = {JOIN_CHUNKS}""",
    "chunk_join_left": f"""
        SELECT doc_id, CASE WHEN n = {JOIN_CHUNKS} THEN sha1(b) END AS plain_sha1, sha1(b) AS safe_sha1
        FROM ({_THIRDS_SQL})""",
    "dedup_frames": """
        SELECT date_trunc('hour', ts) AS hour, user_id AS device_id, event_id, value AS temp_celsius
        FROM events
        QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts), user_id ORDER BY event_id) = 1""",
    "crc_prefix_check": """
        SELECT doc_id, doc_id % 7 <> 0 AS is_checksum_correct, octet_length(encode(text))::INT AS n_bytes,
               sha1(encode(text)) AS data_sha1
        FROM documents""",
    "frame_hash": "SELECT doc_id, substr(sha1(encode(text)), 1, 12) AS hash_hex FROM documents",
}
