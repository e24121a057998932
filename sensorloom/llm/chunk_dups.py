"""Repeated passages: content-defined chunks cut by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm import common
from sensorloom.llm.common import staged

WINDOW = 16  # bytes that decide about a cut
SPREAD = 8  # consecutive candidates of which one at least is a cut: chunks of 4.5 words on average
LONG_WORD = 32  # bytes without a space behind which bytes are candidates too
MASK_BITS = 3  # a candidate after one of those bytes in 8, on average
SMALLEST, LARGEST = 8, 256  # bytes of a chunk; the last of a text may be shorter
PASSAGE = 96  # bytes of consecutive repeated chunks that make a repeated passage
# Words of them that do, however short. Of 51 words, the first WINDOW / 2 may lack hashed bytes, and 2 * SPREAD - 1
# at either side may hold cuts that depend on what stands around the passage: 14 words remain.
WORDS = 14

_GEAR = common.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, sum of gear[byte i back] << i over WINDOW bytes, by doubling the window."""
    hashed, width = _GEAR[data], 1
    while width < WINDOW:
        wider = hashed.copy()
        wider[width:] += hashed[:-width] << np.uint64(width)
        hashed, width = wider, 2 * width
    return hashed


def word_starts(data: np.ndarray) -> np.ndarray:
    """Whether a word starts at each byte: behind white space, or any character of scripts written without spaces."""
    space, starts = data <= 32, data >= 0xE0
    starts[1:] |= space[:-1] & ~space[1:]
    starts[:1] = True
    return starts & (data != 0xE2)  # U+2000 to U+2FFF are punctuation and signs


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, within the size limits.

    Candidates are the starts of words, and within long words the characters that the upper bits of the hash choose.
    A cut is where the hash of the bytes ahead is the least of SPREAD consecutive candidates, so that cuts depend on
    the words around them alone and no passage is without one for longer than that.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    hashed = gear(data)
    starts, place = word_starts(data), np.arange(n)
    away = place - np.maximum.accumulate(np.where(starts, place, 0))
    inner = data & 0xC0 == 0x80
    starts[1:] |= (hashed[:-1] >> np.uint64(64 - MASK_BITS) == 0) & (away[1:] > LONG_WORD) & ~inner[1:]
    at = np.flatnonzero(starts[1:]) + 1
    marks = np.zeros(0, np.int64)
    if len(at) >= SPREAD:
        windows = np.lib.stride_tricks.sliding_window_view(common.mix(hashed[at - 1]), SPREAD)
        marks = at[np.unique(windows.argmin(axis=1) + np.arange(len(windows)))]
    ends, last = [], 0
    for mark in [*marks.tolist(), n]:
        while mark - last > LARGEST:
            last += next((k for k in range(LARGEST, LARGEST - 4, -1) if not inner[last + k]), LARGEST)
            ends.append(last)
        if mark - last >= SMALLEST or mark == n and mark > last:
            ends.append(mark)
            last = mark
    return np.array(ends, np.int64)


def _chunked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, end and 64-bit digest of each chunk."""
    data, offsets = common.text_bytes(batch.column("text"))
    rows, starts, ends = [], [], []
    for row, (first, last) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        end = cuts(data[first:last])
        rows.append(np.full(len(end), row))
        ends.append(end + first)
        starts.append(np.concatenate([[0], end[:-1]])[:len(end)] + first)
    row, start, end = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, starts, ends))
    return row, start - offsets[row], end - offsets[row], common.word_hashes(data, start, end)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        digest, n = np.unique(_chunked(batch)[3], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array(n)], names=["digest", "n"])


def _repeated(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunks that may be repeated, with their place and a 128-bit digest."""
    for batch in common.slices(batches):
        row, start, end, digest = _chunked(batch)
        data, offsets = common.text_bytes(batch.column("text"))
        whole, first = data.tobytes(), np.concatenate([[True], row[1:] != row[:-1]])[:len(row)]
        begun = word_starts(data)
        begun[offsets[row[first]]] = True
        words = np.diff(np.cumsum(begun)[offsets[row] + end - 1], prepend=0) if len(row) else row
        index = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        kept = np.flatnonzero(common.may_hold(bits, digest))
        begins, ends = offsets[row[kept]] + start[kept], offsets[row[kept]] + end[kept]
        strong = [hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(begins, ends, strict=True)]
        rows = pa.array(row[kept])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("tie").take(rows), pa.array(strong, pa.binary()),
             pa.array(index[kept]), pa.array(start[kept]), pa.array(end[kept]), pa.array(words[kept].astype(np.int64))],
            names=["doc_id", "tie", "digest", "at", "start", "end", "words"])


def _spans(documents: DataFrame, shortest: int) -> DataFrame:
    """doc_id, tie, start, end, copies, original, repeats: the spans of ``shortest`` bytes or WORDS words or more that other documents hold too.

    Texts are cut where the rolling hash says so, hence at the same places in every copy of a passage, whatever
    was inserted before it. Every passage of more than 50 words that documents share has a span; a span ends at the
    cuts next to the passage's edges. Chunks are counted by a 64-bit hash, those that occur twice are found again through a
    filter of fixed size, and joined by a 128-bit digest. Consecutive chunks that occur in two or more documents
    make a span, in bytes of the UTF-8 text; ``copies`` is how often its most frequent chunk occurs, and
    ``original`` tells that no chunk of it occurs in a document of smaller (doc_id, text hash). ``repeats`` are the
    parts of the span, in order, whose chunks do: what to drop, so that each chunk stays in its first holder.

    Null and empty texts have no chunk. Rows without doc_id take part, with a null one in the result; rows
    that repeat both doc_id and text are the same document.
    """
    documents = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("tie"), "text")
    twice = (
        documents.select("text").mapInArrow(_digests, "digest bigint, n bigint")
        .groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1")
    )
    bits = documents.sparkSession.sparkContext.broadcast(common.bit_filter(twice, "digest"))
    chunks = staged(documents.mapInArrow(
        lambda batches: _repeated(batches, bits.value),
        "doc_id bigint, tie bigint, digest binary, at bigint, start bigint, end bigint, words bigint"), "chunks")
    holder = F.struct("doc_id", "tie")
    shared = chunks.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min(holder).alias("first"), F.max(holder).alias("last")).where("first <> last")
    found = chunks.join(shared, "digest").select(
        "doc_id", "tie", "at", "start", "end", "words", "copies", (F.col("first") == holder).alias("original")
    ).dropDuplicates(["doc_id", "tie", "at"])
    order = Window.partitionBy("doc_id", "tie").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    alike = F.when(F.col("original"), F.sum(F.col("original").cast("int")).over(order)).otherwise(
        F.sum((~F.col("original")).cast("int")).over(order))
    parts = (
        found.withColumn("run", F.col("at") - F.row_number().over(order)).withColumn("part", F.col("at") - alike)
        .groupBy("doc_id", "tie", "run", "part", "original")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("copies").alias("copies"),
             F.sum("words").alias("words"))
    )
    again = F.collect_list(F.when(~F.col("original"), F.struct("start", "end")))
    return (
        parts.groupBy("doc_id", "tie", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("copies").alias("copies"),
             F.every("original").alias("original"), F.sum("words").alias("words"), F.array_sort(again).alias("repeats"))
        .where((F.col("end") - F.col("start") >= shortest) | (F.col("words") >= WORDS))
        .select("doc_id", "tie", "start", "end", "copies", "original", "repeats")
    )


def passages(documents: DataFrame, shortest: int = PASSAGE) -> DataFrame:
    """doc_id, start, end, copies, original, repeats: the spans of ``_spans``."""
    return _spans(documents, shortest).drop("tie")


def deduplicated(documents: DataFrame, shortest: int = PASSAGE) -> DataFrame:
    """doc_id, text of each document without the ``repeats`` of its passages; a repeated chunk stays in its first holder.

    Rows that repeat both doc_id and text are one document and give one row; null and empty texts stay as they are.
    """
    rows = documents.select("doc_id", F.xxhash64("text").alias("tie"), "text").dropDuplicates(["doc_id", "tie"])
    drop = _spans(documents, shortest).groupBy(F.col("doc_id").alias("id"), F.col("tie").alias("hash")).agg(
        F.array_sort(F.flatten(F.collect_list("repeats"))).alias("drop"))
    kept = F.arrays_zip(F.concat(F.array(F.lit(0).cast("bigint")), F.col("drop.end")).alias("start"),
                        F.concat("drop.start", F.array(F.octet_length("text").cast("bigint"))).alias("end"))
    pieces = F.transform(kept, lambda p: F.substring(
        F.col("text").cast("binary"), p["start"].cast("int") + 1, (p["end"] - p["start"]).cast("int")).cast("string"))
    return rows.join(drop, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("hash")), "left").select(
        "doc_id", F.when(F.size("drop") > 0, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"))
