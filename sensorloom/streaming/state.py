"""The operators that need state of their own: early frame reassembly, counters by camera or routing key, sessions by the clock."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType, TimestampType

from sensorloom.functions import codec
from sensorloom.operators.chunks import COUNT, FINAL_MISMATCH, HASH, INDEX_RANGE, MAX_CHUNKS, NO_KEY, SEQUENCE

_RESULT = "n_chunks int, data binary, error string"
_STATE = ("low array<int>, high array<int>, n_rows array<int>, n_null array<int>, indexes array<array<int>>, "
          "payloads array<array<binary>>, hash array<binary>, expires array<bigint>")
_N_STORED = 8  # columns of _STATE
_NONE = -MAX_CHUNKS - 1  # for a NULL index, which no 16-bit field holds
_ROWS_OUT = 256  # frames that are given to Spark at once
BUCKETS = 1024  # of frames: at most one Python call for each and micro-batch


def frame_error(low: int | None, high: int | None, n_rows: int, indexes: set[int], n_null: int = 0) -> str | None:
    """The error code of a frame, in the order of ``chunks.frame_status``; None if it is whole."""
    if low is None or low != high:
        return FINAL_MISMATCH
    if indexes and (min(indexes) < 0 or max(indexes) > high):
        return INDEX_RANGE
    if n_null or len(indexes) != n_rows or not indexes or min(indexes) != 0 or max(indexes) != n_rows - 1:
        return SEQUENCE
    return COUNT if n_rows != high + 1 else None


class _Frame:
    """What has come of a frame: at most one payload per index, and none once it cannot become whole."""

    __slots__ = ("low", "high", "n_rows", "n_null", "seen", "held", "hash", "expires")

    def __init__(self, low=None, high=None, n_rows=0, n_null=0, indexes=(), payloads=(), expected=None, expires=0) -> None:
        self.low, self.high, self.n_rows, self.n_null = low, high, n_rows, n_null
        self.seen, self.held = set(indexes), dict(zip(indexes, payloads))
        self.hash, self.expires = expected, expires

    def add(self, index: int, final: int, data: bytes | None, row_hash: bytes | None) -> None:
        self.n_rows += 1
        if final != _NONE:
            self.low = final if self.low is None else min(self.low, final)
            self.high = final if self.high is None else max(self.high, final)
        if self.hash is None and row_hash is not None:
            self.hash = row_hash
        if index == _NONE:
            self.n_null += 1
        else:
            self.seen.add(index)
            self.held.setdefault(index, data)

    def error(self) -> str | None:
        return frame_error(self.low, self.high, self.n_rows, self.seen, self.n_null)

    def forget_lost(self) -> bool:
        """Whether the frame cannot become whole; then only what the error code needs is kept."""
        seen, high = self.seen, self.high
        lost = bool(self.n_null or len(seen) != self.n_rows or self.low != high or len(seen) > MAX_CHUNKS or (
            high is not None and seen and not 0 <= min(seen) <= max(seen) <= high))
        if lost:
            self.seen = {min(seen), max(seen)} | set(sorted(seen)[:MAX_CHUNKS]) if seen else seen
            self.held = {}
        return lost

    def payload(self) -> tuple[bytes | None, str | None]:
        whole = b"".join(self.held[i] or b"" for i in range(self.high + 1))
        valid = self.hash is None or hashlib.sha1(whole).digest()[:codec.HASH_BYTES] == self.hash
        return (whole, None) if valid else (None, HASH)

    def stored(self) -> tuple:
        order = sorted(self.seen)
        payloads = [self.held.get(i) for i in order] if self.held else []
        return self.low, self.high, self.n_rows, self.n_null, order, payloads, self.hash, self.expires


def reassemble(chunks: DataFrame, keys: list[str], ts: str, delay: str, timeout_millis: int = 10_000,
               buckets: int = BUCKETS) -> DataFrame:
    """Frames as soon as their last missing chunk arrives, in any order of arrival.

    ``chunks`` has ``keys`` (with the event time ``ts`` among them), chunk_index, final_chunk_index, data
    and hash. A frame that is not whole ``timeout_millis`` of event time after its chunks gives a row with an
    error code and no data; a NULL key gives one at once. State holds at most one payload per index, none
    once a frame cannot become whole, and until the time limit the mere key of a finished one, whose chunks
    are left out if they are delivered again.

    Frames are dealt to ``buckets`` by a hash of their keys, whose number must stay the same over restarts. A bucket is
    one state and one Python call per micro-batch, which holds the bucket's chunks of that batch and its open frames.
    Keys go as text, so that a NULL among them leaves the others exact.
    """
    times = {f.name for f in chunks.select(*keys).schema if isinstance(f.dataType, TimestampType)}
    kinds = [f.dataType for f in chunks.select(*keys).schema]
    names = [f"key_{i}" for i in range(len(keys))]
    no_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    rows = chunks.withWatermark(ts, delay).select(
        ts, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        *[(F.unix_micros(k) if k in times else F.col(k)).cast("string").alias(n) for n, k in zip(names, keys)],
        no_key.alias("no_key"), F.coalesce(F.unix_millis(ts), F.lit(0)).alias("millis"),
        *[F.coalesce(F.col(c).cast("int"), F.lit(_NONE)).alias(c) for c in ("chunk_index", "final_chunk_index")], "data", "hash")
    columns = [*names, "no_key", "millis", "chunk_index", "final_chunk_index", "data", "hash"]
    out = StructType.fromDDL(", ".join([*(f"{n} string" for n in names), _RESULT]))
    state_schema = ", ".join([*(f"{n} array<string>" for n in names), _STATE,
                              *(f"done_{n} array<string>" for n in names), "done_expires array<bigint>"])

    def step(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, n_keys = state.getCurrentWatermarkMs(), len(names)
        frames: dict[tuple, _Frame] = {}
        done: dict[tuple, int] = {}
        if state.exists:
            kept = state.get
            frames = {k: _Frame(*f) for k, f in zip(zip(*kept[:n_keys]), zip(*kept[n_keys:-n_keys - 1]))}
            done = dict(zip(zip(*kept[-n_keys - 1:-1]), kept[-1]))
        unnamed: dict[tuple, int] = {}
        touched: dict[tuple, _Frame] = {}
        for batch in () if state.hasTimedOut else batches:
            for row in zip(*(batch[c].tolist() for c in columns)):
                key, (nameless, millis, index, final, data, row_hash) = row[:n_keys], row[n_keys:]
                if nameless:
                    key = tuple(None if pd.isna(k) else k for k in key)
                    unnamed[key] = unnamed.get(key, 0) + 1
                    continue
                expires = max(millis, now) + timeout_millis
                if key in done:
                    done[key] = expires
                    continue
                frame = frames.get(key)
                if frame is None:
                    frame = frames[key] = _Frame()
                frame.expires, touched[key] = expires, frame
                frame.add(index, final, data, row_hash)

        def results() -> Iterator[tuple]:
            for key, n in unnamed.items():
                yield *key, n, None, NO_KEY
            for key, frame in touched.items():
                if not frame.forget_lost() and frame.error() is None:
                    yield *key, frame.n_rows, *frame.payload()
                    done[key] = frames.pop(key).expires
            for key in [k for k, frame in frames.items() if frame.expires <= now]:
                frame = frames.pop(key)
                yield *key, frame.n_rows, None, frame.error()

        ready = results()
        while part := list(islice(ready, _ROWS_OUT)):
            yield pd.DataFrame(part, columns=out.fieldNames())
        done = {k: e for k, e in done.items() if e > now}
        if not frames and not done:
            state.remove()
            return
        open_keys, done_keys = ([list(c) for c in zip(*d)] if d else [[] for _ in names] for d in (frames, done))
        stored = [list(c) for c in zip(*(f.stored() for f in frames.values()))] if frames else [[] for _ in range(_N_STORED)]
        state.update((*open_keys, *stored, *done_keys, list(done.values())))
        state.setTimeoutTimestamp(max(now + 1, min([f.expires for f in frames.values()] + list(done.values()))))

    found = rows.groupBy("bucket").applyInPandasWithState(step, out, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(*[
        (F.timestamp_micros(F.col(n).cast("bigint")) if k in times else F.col(n).cast(kind)).alias(k)
        for n, k, kind in zip(names, keys, kinds)], "n_chunks", "data", "error")


def number_frames(rows: DataFrame, camera: str, ts: str) -> DataFrame:
    """Add ``frame_number``: 0-based per output camera, in time order.

    ``rows`` is a stream over the table that a windowed aggregate wrote in append mode, where each batch has
    only later windows than the batches before (Spark allows no such state behind an aggregate in one
    query). Give it whole batches: no ``maxFilesPerTrigger``. Keep payloads out, and join them on
    (camera, time) afterwards.
    """
    schema = StructType.fromDDL(", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(camera, ts).schema]
        + ["frame_number bigint"]
    ))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start = state.get[0] if state.exists else 0
        times = pd.concat([batch[ts] for batch in batches]).sort_values(ignore_index=True)
        state.update((start + len(times),))
        yield pd.DataFrame({camera: key[0], ts: times, "frame_number": range(start, start + len(times))})

    return (
        rows.select(camera, ts).groupBy(F.col(camera))
        .applyInPandasWithState(step, schema, "next bigint", "append", GroupStateTimeout.NoTimeout)
    )


def number_events(events: DataFrame, key: str, order: list[str], buckets: int = 64) -> DataFrame:
    """Add ``position``: gapless from 0 in each ``key``, by micro-batch and within it by ``order``.

    Rows of equal order are numbered as they come. Keys are dealt to ``buckets`` by hash; the next positions of a
    bucket's keys are one state, kept for good, and a bucket's rows of one micro-batch are numbered in one call, so
    the source's limits per micro-batch bound them. A NULL key is a key like any other. The number of buckets
    must stay the same over restarts.
    """
    kind = events.schema[key].dataType.simpleString()
    placed = events.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    schema = StructType([*events.schema, *StructType.fromDDL("position bigint")])

    def step(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, following = state.get if state.exists else ([], [])
        counts = dict(zip(keys, following, strict=True))
        rows = pd.concat(list(batches), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
        named = rows[key].astype(object).where(rows[key].notna(), None)
        positions = []
        for value in named:
            counts[value] = counts.get(value, 0) + 1
            positions.append(counts[value] - 1)
        state.update((list(counts), list(counts.values())))
        rows["position"] = positions
        yield rows[schema.fieldNames()]

    return placed.groupBy("_bucket").applyInPandasWithState(
        step, schema, f"keys array<{kind}>, following array<bigint>", "append", GroupStateTimeout.NoTimeout)


def sessions_by_clock(events: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Sessions per key in processing time: events arrive when their micro-batch does, and a session closes by the clock.

    Rows (keys, session_start, session_end, n_events), with the end at the last arrival + gap. A session goes on at
    exactly the gap, as in event time. The clock is that of the micro-batch, which the checkpoint keeps: a batch that
    is run again after a failure gives the same sessions. A key that has gone quiet closes without any further event, so
    the query needs a trigger that goes on; after a restart Spark looks at the clock from the first event on. NULL is a key like any other. State is three numbers a key. Sessions
    that must come out alike whenever they are read need arrivals that are stored (``events.stamp_arrival``).
    """
    key_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in events.select(*keys).schema]
    schema = StructType.fromDDL(", ".join([*key_fields, "session_start timestamp, session_end timestamp, n_events bigint"]))
    gap = gap_seconds * 1000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = state.get if state.exists else None
        arrived = sum(len(batch) for batch in batches)
        if held is not None and (state.hasTimedOut or now - held[1] > gap):
            first, last, n = held
            yield pd.DataFrame([[*key, pd.Timestamp(first, unit="ms", tz="UTC"), pd.Timestamp(last + gap, unit="ms", tz="UTC"), n]],
                               columns=schema.fieldNames())
            held = None
        if arrived:
            first, _, n = held or (now, now, 0)
            state.update((first, now, n + arrived))
            state.setTimeoutDuration(gap)
        else:
            state.remove()

    return events.select(*keys).groupBy(*keys).applyInPandasWithState(
        step, schema, "first bigint, last bigint, n bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)
