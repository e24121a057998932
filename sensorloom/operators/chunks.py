"""Payloads to chunks and back, with the sequence and hash checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import codec

# Default chunk size, and the number of indexes a signed 16-bit field can hold.
DEFAULT_CHUNK_BYTES = 512 * 1024
MAX_CHUNKS = 32768

# A bad frame with more rows than MAX_CHUNKS and over 1/HEAVY_SHARE of all rows of bad frames is removed
# ahead of the payload shuffle. By the second condition there are fewer than HEAVY_SHARE of those.
HEAVY_SHARE = 10_000

# Error codes, in the order in which they are tested.
NO_KEY = "no_key"
FINAL_MISMATCH = "final_index_differs"
INDEX_RANGE = "index_out_of_range"
SEQUENCE = "index_not_next"
COUNT = "count_differs"
HASH = "hash_differs"


def _explode_slices(df: DataFrame, n_chunks: Column, size: int, data: str) -> DataFrame:
    too_many = F.raise_error(F.lit(f"payload needs more than {MAX_CHUNKS} chunks")).cast("int")
    counted = F.when(n_chunks > MAX_CHUNKS, too_many).when(n_chunks > 0, n_chunks.cast("int"))
    others = [name for name in df.columns if name != data]
    # No chunks is NULL, which explode skips.
    indexed = df.withColumn("_n", counted).select(
        *others, data, "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i")
    )
    piece = F.col(data).substr(F.col("_i") * size + 1, F.lit(size))
    return indexed.select(
        *others,
        F.col("_i").cast("smallint").alias("chunk_index"),
        (F.col("_n") - 1).cast("smallint").alias("final_chunk_index"),
        piece.alias(data),
    )


def split(df: DataFrame, size: int = DEFAULT_CHUNK_BYTES, data: str = "data") -> DataFrame:
    """One row per chunk with all the frame's columns. An empty payload gives one empty chunk."""
    n_bytes = F.octet_length(data)
    n_chunks = F.greatest(F.lit(1), F.ceil(n_bytes / F.lit(size)))
    return _explode_slices(df, F.when(n_bytes.isNotNull(), n_chunks), size, data)


def split_v1(df: DataFrame, max_chunk_size: int, data: str = "data") -> DataFrame:
    """One row per chunk with an ``event`` column: header and payload. An empty payload gives no row."""
    size = max_chunk_size - codec.V1_SLICE_OVERHEAD
    if size <= 0:
        raise ValueError(f"max_chunk_size must be over {codec.V1_SLICE_OVERHEAD}")
    parts = _explode_slices(df, F.ceil(F.octet_length(data) / F.lit(size)), size, data)
    event = codec.v1_event(F.col("chunk_index"), F.col("final_chunk_index"), F.col(data))
    return parts.withColumn("event", event).drop("chunk_index", "final_chunk_index", data)


def parse_v1(df: DataFrame, event: str = "event") -> DataFrame:
    """Header fields and payload of chunked events."""
    return df.withColumns(codec.v1_fields(F.col(event))).drop(event)


def frame_status(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Per frame: number of chunk rows, final index, an error code (NULL if whole), and ``is_waiting``.

    A waiting frame only lacks chunks: it is an error now, but may be whole later. Reads no payload. Copies of a chunk collapse on the map side, in the first grouping.
    """
    per_chunk = chunks.groupBy(*keys, "chunk_index").agg(
        F.count(F.lit(1)).alias("_copies"),
        F.min("final_chunk_index").alias("_low"),
        F.max("final_chunk_index").alias("_high"),
    )
    per_frame = per_chunk.groupBy(*keys).agg(
        F.sum("_copies").alias("n_rows"),
        F.count("chunk_index").alias("_distinct"),
        F.min("chunk_index").alias("_first"),
        F.max("chunk_index").alias("_last"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
    )
    no_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    contiguous = (
        (F.col("_first") == 0) & (F.col("_last") == F.col("n_rows") - 1) & (F.col("_distinct") == F.col("n_rows"))
    )
    error = (
        F.when(no_key, NO_KEY)
        .when(~F.coalesce(F.col("_low") == F.col("_high"), F.lit(False)), FINAL_MISMATCH)
        .when((F.col("_first") < 0) | (F.col("_last") > F.col("_high")), INDEX_RANGE)
        .when(~F.coalesce(contiguous, F.lit(False)), SEQUENCE)
        .when(F.col("n_rows") != F.col("_high") + 1, COUNT)
    )
    waiting = F.col("error").isin(SEQUENCE, COUNT) & (F.col("_distinct") == F.col("n_rows"))
    return per_frame.withColumn("error", error).select(
        *keys, "n_rows", F.col("_high").alias("final_chunk_index"), "error",
        F.coalesce(waiting, F.lit(False)).alias("is_waiting"))


def errors(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """The frames that fail a sequence check, with the code."""
    return frame_status(chunks, keys).filter(F.col("error").isNotNull())


def reassemble(chunks: DataFrame, keys: list[str], carry: list[str] | None = None) -> DataFrame:
    """Whole frames: ``keys``, ``n_chunks``, ``data``, and ``carry`` columns from the first chunk.

    The checks run on the indexes alone, so that the payloads of only the good frames are shuffled, once,
    and a group never has more rows than its final index says. The rest is in ``errors``.
    """
    carry = carry or []
    for key in keys:
        chunks = chunks.filter(F.col(key).isNotNull())
    status = frame_status(chunks, keys)
    good = status.filter(F.col("error").isNull()).select(*keys, F.col("n_rows").alias("n_chunks"))
    bad = status.filter(F.col("error").isNotNull())
    # All three read the same columns of the status, so that Spark computes its shuffles once.
    share = bad.agg(F.sum("n_rows") / HEAVY_SHARE).scalar()
    heavy = bad.filter((F.col("n_rows") > MAX_CHUNKS) & (F.col("n_rows") > share)).select(*keys)
    light = chunks.join(F.broadcast(heavy), keys, "left_anti")
    return (
        light.join(good, keys)
        .groupBy(*keys, "n_chunks")
        .agg(
            F.expr("listagg(data) WITHIN GROUP (ORDER BY chunk_index)").alias("data"),
            *[F.min_by(name, "chunk_index").alias(name) for name in carry],
        )
    )


def check_hash(frames: DataFrame) -> DataFrame:
    """Add ``is_hash_valid``: the payload against the ``hash`` that came with the chunks."""
    return frames.withColumn("is_hash_valid", codec.is_hash_valid(F.col("data"), F.col("hash")))


def require_hash(frames: DataFrame) -> DataFrame:
    """Fail on the first frame whose hash differs."""
    valid = codec.is_hash_valid(F.col("data"), F.col("hash"))
    return frames.filter(F.when(valid, F.lit(True)).otherwise(F.raise_error(F.lit(HASH)).cast("boolean")))


def join_chunks(chunks: DataFrame, keys: list[str], n: int, how: str = "inner") -> DataFrame:
    """Frames as an ``n``-way self-join on the index gives them, payloads as ``data_0`` ... ``data_<n-1>``.

    ``inner`` keeps frames that have all of the first ``n`` chunks, ``left`` those that have chunk 0. Of copies
    of a chunk the least payload counts, and a group holds one payload for each index. It is one grouping and one
    shuffle, in place of a join for each chunk. As in a join, a NULL key equals nothing: such rows go, or each
    first chunk is a frame of its own, without the others; they are not grouped.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    index = F.col("chunk_index")
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    # The set of indexes tells a chunk with a NULL payload from none, and holds no payload.
    found = chunks.filter(~no_key & (index >= 0) & (index < n)).groupBy(*keys).agg(
        F.collect_set(index.cast("int")).alias("_found"), *[F.min(F.when(index == i, F.col("data"))).alias(f"data_{i}") for i in range(n)])
    names = [*keys, *[f"data_{i}" for i in range(n)]]
    if how == "inner":
        return found.filter(F.size("_found") == n).select(*names)
    alone = chunks.filter(no_key & (index == 0)).select(
        *keys, F.col("data").alias("data_0"), *[F.lit(None).cast("binary").alias(name) for name in names[len(keys) + 1:]])
    return found.filter(F.array_contains("_found", 0)).select(*names).unionByName(alone)


def concat_chunks(n: int, null_safe: bool) -> Column:
    """The payload of ``join_chunks``: NULL with any missing chunk, or, null-safe, what is there."""
    parts = [F.col(f"data_{i}") for i in range(n)]
    return F.concat(*[F.coalesce(p, F.lit(b"")) for p in parts] if null_safe else parts)


def dedup_frames(frames: DataFrame, keys: list[str], prefer: list[str], place: list[str] | None = None) -> DataFrame:
    """One row per key: the least by the ``prefer`` columns. Partial results are merged map-side.

    For large rows name as ``place`` columns without NULL that tell all rows apart: the rows are chosen on these,
    the keys and ``prefer``, and only the chosen ones are fetched.
    """
    if place is not None:
        chosen = frames.groupBy(*keys).agg(F.min(F.struct(*dict.fromkeys([*prefer, *place]))).alias("_row"))
        return frames.join(chosen.select(*[F.col(f"_row.{c}").alias(c) for c in place]), place, "left_semi")
    others = [name for name in frames.columns if name not in keys]
    order = F.struct(*prefer, *[name for name in others if name not in prefer])
    return (
        frames.groupBy(*keys).agg(F.min(order).alias("_row")).select(*keys, "_row.*")
        .select(*frames.columns)
    )
