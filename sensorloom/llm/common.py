"""What the operators share: staged tables, Arrow text columns as bytes, hashing, fixed-size bit filters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.workspace import LARGE_ROW_CONF, configure, run_dir

SEGMENT_BYTES = 1 << 20  # of text that words are hashed in at a time
SLICE_BYTES = 1 << 20  # of text that operators on bytes take at a time
FILTER_BITS = 26  # 2**26 bits, 8 MB, whatever the number of keys

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with Arrow batches in a size fit for long texts."""
    return configure(spark, LARGE_ROW_CONF).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, safe from lost executors."""
    path = run_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offset of each row, null as empty; a view where Arrow allows it."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    if n:
        powers[0] = 1
    return np.cumprod(powers)


@lru_cache(maxsize=2)
def powers(base: int) -> np.ndarray:
    """The powers of ``base`` modulo 2**64 from 0 on, one for each byte of a segment."""
    return _powers(base, SEGMENT_BYTES)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word: a polynomial over byte values by prefix sums, then mixed.

    The sums are of one segment of words at a time, so that memory does not grow with the text; a word longer
    than a segment has one of its own.
    """
    out, first, n = np.zeros(len(starts), np.uint64), 0, len(starts)
    while first < n:
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + SEGMENT_BYTES, side="right")))
        size = int(ends[last - 1]) - low
        up, down = (powers(b) if size <= SEGMENT_BYTES else _powers(b, size) for b in (_BASE, _INVERSE))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[low:low + size]] * up[:size], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        first = last
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of SLICE_BYTES of the text column, or of one row if that has more."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross the given row offsets."""
    n = len(flags)
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1]
    last[:-1] &= ~flags[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = flags[inner]
    last[inner - 1] = flags[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes."""
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(_BASE) + words[i:i + n]
    return mix(total)


def bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the 64-bit keys by their low bits, as words of 64 bits: 8 MB at the driver for any input."""
    slot = F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)
    words = (
        keys.where(F.col(column).isNotNull())
        .select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found = words.toArrow()
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each uint64 key may be among those of the filter; never False for one that is."""
    slot = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
