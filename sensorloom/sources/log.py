"""The event log: a table of (scope, stream, segment_id, offset, routing_key, event), batch or streaming."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorloom.functions import codec
from sensorloom.operators import chunks, ordering
from sensorloom.workspace import materialize

PAYLOAD_BITS = 9  # offsets that one group has payloads of, as a power of two: 512 MiB with the largest events


def scan(spark: SparkSession, path: str, scope: str | None = None, stream: str | None = None) -> DataFrame:
    """The whole log, or one stream of it, from the earliest event."""
    return _one_stream(spark.read.parquet(path), scope, stream)


def scan_stream(spark: SparkSession, path: str, schema: str | StructType, scope: str | None = None,
                stream: str | None = None, max_files: int | None = None) -> DataFrame:
    """The log as a stream. ``path`` may be a folder of files or a pattern."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _one_stream(reader.parquet(path), scope, stream)


def json_stream(spark: SparkSession, path: str, schema: str | StructType,
                max_files: int | None = None) -> DataFrame:
    """A folder of JSON lines files, read as they arrive."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path, schema=schema)


def _one_stream(log: DataFrame, scope: str | None, stream: str | None) -> DataFrame:
    if scope is not None:
        log = log.filter(F.col("scope") == scope)
    if stream is not None:
        log = log.filter(F.col("stream") == stream)
    return log


def segment_columns(log: DataFrame) -> list[str]:
    """What tells the segments of a log apart: one stream's log may lack scope and stream."""
    return [name for name in ("scope", "stream", "segment_id") if name in log.columns]


def _headers(log: DataFrame, by: str | None) -> DataFrame:
    """Place, header fields and writer of chunked events, without their payloads."""
    fields = codec.v1_fields(F.col("event"))
    named = [F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("writer")] if by else []
    return log.select(*segment_columns(log), *named, "offset", fields["chunk_index"].alias("chunk_index"),
                      fields["final_chunk_index"].alias("final_chunk_index"))


def chunked_frames(log: DataFrame, bits: int = ordering.BLOCK_BITS, by: str | None = None, writers: int | None = None) -> DataFrame:
    """Place and header fields of chunked events with the ``frame`` that they belong to; payloads stay out.

    Chunked events name no frame. With one writer its chunks follow each other in their segment, and index 0
    starts the next one: ``frame`` is the number of first chunks so far. Several writers interleave:

    - ``by`` names the column that tells them apart, such as the routing key (NULL is a writer of its own). The
      frames of each are numbered, and a column ``writer`` is part of a frame's key.
    - Without such a column ``writers`` is their number, and ``match_frames`` finds the frames.

    ``bits`` is the size of the offset blocks in which first chunks are counted, see ``ordering``.
    """
    heads = _headers(log, by)
    if writers is not None:
        if by is not None:
            raise ValueError("give either the writers' column or their number")
        return match_frames(heads, segment_columns(log), writers)
    key = [*segment_columns(log), *(["writer"] if by else [])]
    block = [ordering.offset_block(F.col("offset"), bits)]
    return ordering.prefix_sum(heads, key, ["offset"], block, (F.col("chunk_index") == 0).cast("int"), "frame")


def match_frames(heads: DataFrame, segment: list[str], writers: int) -> DataFrame:
    """Tell interleaved frames apart by their headers: a chunk goes to the oldest open frame that expects it.

    Frames of one final index are matched apart from all others, in offset order; ``frame`` is the offset of the
    first chunk. At most ``writers`` frames are open: a further first chunk closes the one that has waited
    longest, whose writer must have given it up. A chunk that none expects is a frame of its own, of number
    -1 - offset. The rows are a few numbers each, are sorted by Spark, and are taken one after another.
    """
    order = [*segment, "final_chunk_index", "offset"]
    names = [*order, "chunk_index", "frame"]
    fields = [heads.schema[name] for name in (*order, "chunk_index")]

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, opened = None, []  # of [next index, first offset, last offset], oldest first
        for batch in batches:
            frames = []
            for *key, offset, index in zip(*(batch.column(name).to_pylist() for name in names[:-1]), strict=True):
                if key != current:
                    current, opened = key, []
                final = key[-1]
                if index == 0:
                    frames.append(offset)
                    if final:
                        if len(opened) >= writers:
                            opened.remove(min(opened, key=lambda f: f[2]))
                        opened.append([1, offset, offset])
                    continue
                found = next((f for f in opened if f[0] == index), None)
                if found is None:
                    frames.append(-1 - offset)
                    continue
                frames.append(found[1])
                found[0], found[2] = index + 1, offset
                if index == final:
                    opened.remove(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names[:-1]), pa.array(frames, pa.int64())], names=names)

    dealt = heads.select(*names[:-1]).repartition(*segment, "final_chunk_index").sortWithinPartitions(*order)
    return dealt.mapInArrow(matched, StructType([*fields, StructField("frame", LongType())]))


def scan_payloads(log: DataFrame, encoding: str | None = None, bits: int = ordering.BLOCK_BITS, by: str | None = None,
                  writers: int | None = None, payload_bits: int = PAYLOAD_BITS) -> DataFrame:
    """Whole payloads as (segment columns, offset, data). With ``encoding='chunked_v1'`` chunked events are put
    together; ``offset`` is that of the first chunk. For the others see ``payload_errors``.

    Frames are found on the headers alone, see ``chunked_frames``. Payloads are shuffled once, by blocks of
    2**``payload_bits`` offsets: each block gets the small list of its chunks' frames and puts them together on
    the spot. Only the parts of frames that go on over a block's end are shuffled again.
    """
    segment = segment_columns(log)
    if encoding is None:
        return log.select(*segment, "offset", F.col("event").alias("data"))
    if encoding != "chunked_v1":
        raise ValueError(f"unknown encoding {encoding!r}")
    # Written, as the three uses below would each read all events for their headers.
    frames = materialize(chunked_frames(log, bits, by, writers))
    key = [*segment, *(["writer"] if by else []), "frame"]
    block = ordering.offset_block(F.col("offset"), payload_bits).alias("block")
    good = chunks.frame_status(frames, key).filter(F.col("error").isNull()).select(*key, F.col("n_rows").alias("n_chunks"))
    span = frames.groupBy(*key).agg(F.min("offset").alias("start"), F.max(block).alias("last"))
    placed = frames.join(good.join(span, key), key)
    first = ordering.offset_block(F.col("start"), payload_bits)
    mark = F.struct("start", "n_chunks", "chunk_index", (first != F.col("last")).alias("crosses"))
    lists = placed.groupBy(*segment, block).agg(F.map_from_entries(F.collect_list(F.struct("offset", mark))).alias("marks"))
    marked = (
        log.select(*segment, "offset", block, "event").join(lists, [*segment, "block"])
        .withColumn("mark", F.try_element_at("marks", "offset")).filter(F.col("mark").isNotNull())
        .select(*segment, "block", "mark.*", codec.v1_fields(F.col("event"))["data"].alias("data"))
    )
    parts = marked.groupBy(*segment, "block", "start", "n_chunks", "crosses").agg(
        F.min("chunk_index").alias("index"), F.expr("listagg(data) WITHIN GROUP (ORDER BY chunk_index)").alias("data"))
    inside = parts.filter(~F.col("crosses")).select(*segment, "start", "n_chunks", "data")
    across = parts.filter("crosses").groupBy(*segment, "start", "n_chunks").agg(
        F.expr("listagg(data) WITHIN GROUP (ORDER BY index)").alias("data"))
    return inside.unionByName(across).select(*segment, F.col("start").alias("offset"), "n_chunks", "data")


def payload_errors(log: DataFrame, bits: int = ordering.BLOCK_BITS, by: str | None = None, writers: int | None = None) -> DataFrame:
    """The frames of a log of chunked events that are not whole; number 0 is what precedes the first start."""
    key = [*segment_columns(log), *(["writer"] if by else []), "frame"]
    return chunks.errors(chunked_frames(log, bits, by, writers), key)


def register(log: DataFrame, name: str) -> DataFrame:
    """Name a table for SQL, and scan it by that name."""
    log.createOrReplaceTempView(name)
    return log.sparkSession.table(name)


def extent(log: DataFrame, segment: Sequence[str] = ("segment_id",)) -> DataFrame:
    """Head and tail (one past the last offset) of each segment; for several streams give ``segment_columns``."""
    return log.groupBy(*segment).agg(
        F.min("offset").alias("head_offset"), (F.max("offset") + 1).alias("tail_offset")
    )


def between(log: DataFrame, start: Mapping[int, int] | None, end: Mapping[int, int] | None) -> DataFrame:
    """Events from ``start`` up to but not including ``end``; None is unbounded.

    A segment that a given position does not name is left out. The condition is a plain filter, so that
    the scan skips row groups outside the offsets.
    """
    if start is not None and end is not None:
        segments = sorted(start.keys() & end.keys())
    else:
        segments = sorted((start if start is not None else end or {}).keys())
    if start is None and end is None:
        return log
    if not segments:
        return log.filter(F.lit(False))
    offset = F.col("offset")
    outer: list[Column] = []
    if start is not None:
        outer.append(offset >= min(start[s] for s in segments))
    if end is not None:
        outer.append(offset < max(end[s] for s in segments))

    def within(segment: int) -> Column:
        condition = F.col("segment_id") == segment
        if start is not None:
            condition &= offset >= start[segment]
        if end is not None:
            condition &= offset < end[segment]
        return condition

    for condition in (*outer, reduce(Column.__or__, map(within, segments))):
        log = log.filter(condition)
    return log


def between_cuts(log: DataFrame, cuts: DataFrame) -> DataFrame:
    """Events that lie in a range of ``cuts`` (segment_id, from_offset, to_offset), each once.

    A segment may have any number of ranges, which may overlap; one that ``cuts`` does not name is left out. A
    NULL bound is none, and a NULL segment_id stands for the events without one. The scan also gets the least
    and the greatest offset of all ranges as a plain filter, to skip row groups.
    """
    outer = cuts.agg(
        F.min(F.coalesce("from_offset", F.lit(-2**63))).alias("low"), F.max(F.coalesce("to_offset", F.lit(2**63 - 1))).alias("high")
    ).first()
    if outer["low"] is None:
        return log.filter(F.lit(False))
    inside = log.filter((F.col("offset") >= outer["low"]) & ((F.col("offset") < outer["high"]) | F.lit(outer["high"] == 2**63 - 1)))
    ranges = cuts.select(F.col("segment_id").alias("_segment"), "from_offset", "to_offset")
    offset = F.col("offset")
    on = (
        F.col("segment_id").eqNullSafe(F.col("_segment"))
        & (F.col("from_offset").isNull() | (offset >= F.col("from_offset")))
        & (F.col("to_offset").isNull() | (offset < F.col("to_offset")))
    )
    return inside.join(ranges, on, "left_semi")


def from_tail(log: DataFrame, tails: DataFrame) -> DataFrame:
    """Events at or after the tail, a table (segment_id, tail_offset) such as an earlier ``extent``.

    Segments created later, so not in the tail, are read from their start, as is one with a NULL tail. Works on
    a stream as well: the events before the tail are taken out by a join with a static table.
    """
    behind = tails.groupBy("segment_id").agg(F.max("tail_offset").alias("_tail")).select(
        F.col("segment_id").alias("_segment"), "_tail")
    on = F.col("segment_id").eqNullSafe(F.col("_segment")) & (F.col("offset") < F.col("_tail"))
    return log.join(behind, on, "left_anti")
