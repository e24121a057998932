import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.functions import codec, times
from sensorloom.operators import chunks, grid
from sensorloom.operators import events as ev
from sensorloom.sources import log as logs
from sensorloom.sources import sinks
from sensorloom.streaming import frames, run, state
from sensorloom.workspace import STREAMING_CONF, configure
from tests import fixtures as fx

START = dt.datetime(2024, 1, 1)


def seconds(n):
    return START + dt.timedelta(seconds=n)


class Stream:
    """A folder of files that are read one per micro-batch, in order, by one restartable query."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, folder, schema, 0

    def add(self, rows):
        # File names and times grow, so that the source takes them in this order.
        frame = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        frame.write.parquet(f"{self.folder}/in/part={self.files:03d}")
        self.files += 1
        time.sleep(0.05)

    def run(self, transform, name="out"):
        source = logs.scan_stream(self.spark, f"{self.folder}/in/*", self.schema, max_files=1)
        df = transform(source)
        out = f"{self.folder}/{name}"
        sinks.stream_to_table(df, f"{out}/table", f"{out}/checkpoint").awaitTermination()
        return self.spark.read.schema(df.schema).parquet(f"{out}/table")


READING = "d int, ts timestamp, v double"


@pytest.fixture()
def readings(spark, tmp_path):
    return Stream(spark, str(tmp_path), READING)


def test_json_stream_with_declared_schema(spark, tmp_path):
    folder = fx.write(tmp_path / "in", *fx.WRITER_FILES)
    parts = schemas.normalize_names(logs.json_stream(spark, folder, schemas.FILE_CHUNK, max_files=1))
    found = run.to_table(parts, "json").collect()
    assert len(found) == 24
    assert sum(bytes(r["data"]) == b"east " for r in found) == 7


def test_stream_join_of_chunks_then_dedup(spark, tmp_path):
    folder = fx.write(tmp_path / "in", *fx.WRITER_FILES)
    parts = schemas.normalize_names(logs.json_stream(spark, folder, schemas.FILE_CHUNK))
    parts = parts.filter("final_chunk_index = 3").withWatermark("timestamp", "60 seconds")
    joined = None
    for i in range(4):
        side = parts.filter(F.col("chunk_index") == i).select(*schemas.FILE_CHUNK_KEY, F.col("data").alias(f"data_{i}"))
        joined = side if joined is None else joined.join(side, schemas.FILE_CHUNK_KEY)
    whole = joined.select("timestamp", "camera", "ssrc", chunks.concat_chunks(4, False).alias("data"))
    assert run.to_table(whole, "join").count() == 4
    survivors = run.to_table(whole.dropDuplicates(["timestamp", "camera"]), "join-dedup").collect()
    assert sorted(r["timestamp"].strftime("%H:%M:%S.%f")[:-3] for r in survivors) == [
        fx.FIRST, fx.SECOND, fx.THIRD]
    assert {bytes(r["data"]) for r in survivors} == {fx.WHOLE}


CHUNK = "camera int, ts timestamp, chunk_index smallint, final_chunk_index smallint, data binary, hash binary"


def chunk_rows(spark, payloads, size=8):
    """Chunk rows of one frame per (camera, second, payload)."""
    frames = spark.createDataFrame([(c, seconds(s), bytearray(p)) for c, s, p in payloads],
                                   "camera int, ts timestamp, data binary")
    split = chunks.split(frames.withColumn("hash", codec.frame_hash(F.col("data"))), size)
    names = [f.split()[0] for f in CHUNK.split(", ")]
    return [tuple(r) for r in split.select(*names).collect()]


def frames_of(table):
    return {(r["camera"], (r["ts"] - START).seconds): (r["data"] and bytes(r["data"]), r["error"]) for r in table.collect()}


def reassembly(df):
    return state.reassemble(df, ["camera", "ts"], "ts", "1 second", timeout_millis=10_000)


def with_state(stream):
    return stream.run(reassembly)


def with_batches(stream):
    source = logs.scan_stream(stream.spark, f"{stream.folder}/in/*", CHUNK, max_files=1)
    out = f"{stream.folder}/batches"
    frames.reassemble_to_table(source, ["camera", "ts"], "ts", out, f"{out}/checkpoint").awaitTermination()
    return stream.spark.read.schema(frames.frame_schema(source, ["camera", "ts"])).parquet(f"{out}/frames")


both = pytest.mark.parametrize("assemble", [with_state, with_batches])


@both
def test_frames_come_as_soon_as_complete_in_any_order(spark, tmp_path, assemble):
    stream = Stream(spark, str(tmp_path), CHUNK)
    payloads = [(c, s, random.Random(c * 10 + s).randbytes(30 + s)) for c in range(3) for s in range(4)]
    rows = chunk_rows(spark, payloads)
    random.Random(1).shuffle(rows)
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        stream.add(part)
    expected = {(c, s): (p, None) for c, s, p in payloads}
    # No later event moves the watermark: the frames are there because they are complete.
    assert frames_of(assemble(stream)) == expected


@both
def test_bad_frames_become_error_rows(spark, tmp_path, assemble):
    stream = Stream(spark, str(tmp_path), CHUNK)
    rows = chunk_rows(spark, [(c, 0, bytes(range(20))) for c in range(7)])
    by_camera = {c: sorted(r for r in rows if r[0] == c) for c in range(7)}

    def changed(row, **values):
        names = [f.split()[0] for f in CHUNK.split(", ")]
        return tuple(values.get(n, v) for n, v in zip(names, row))

    good = by_camera[0]
    bad = [
        by_camera[1][0], by_camera[1][2],                                   # the middle one is missing
        by_camera[2][0], by_camera[2][1],                                   # the last one is missing
        by_camera[3][0], by_camera[3][0], by_camera[3][1],                  # one twice
        by_camera[4][0], changed(by_camera[4][1], final_chunk_index=5),     # another final index
        by_camera[5][0], changed(by_camera[5][1], chunk_index=9),           # index out of range
        *by_camera[6][:2], changed(by_camera[6][2], data=bytearray(b"?")),  # wrong payload
    ]
    stream.add(good + bad)
    stream.add(chunk_rows(spark, [(9, 60, b"later")]))
    stream.add(chunk_rows(spark, [(9, 120, b"later")]))
    found = frames_of(assemble(stream))
    assert {k: v for k, v in found.items() if k[0] != 9} == {
        (0, 0): (bytes(range(20)), None), (1, 0): (None, chunks.SEQUENCE), (2, 0): (None, chunks.COUNT),
        (3, 0): (None, chunks.SEQUENCE), (4, 0): (None, chunks.FINAL_MISMATCH), (5, 0): (None, chunks.INDEX_RANGE),
        (6, 0): (None, chunks.HASH),
    }


@both
def test_nulls_are_error_rows_and_codes_have_one_order(spark, tmp_path, assemble):
    """A NULL does not end the stream; of several faults all forms report the same one."""
    stream = Stream(spark, str(tmp_path), CHUNK)
    part = (bytearray(b"x"), None)
    rows = [
        (0, seconds(0), 0, None, *part), (1, seconds(0), None, 0, *part),
        (2, seconds(0), 0, 1, *part), (2, seconds(0), 0, 1, *part), (2, seconds(0), 1, 2, *part),
        (3, seconds(0), 0, 0, *part)]
    stream.add(rows)
    stream.add([(9, seconds(60), 0, 0, *part)])
    stream.add([(9, seconds(120), 0, 0, *part)])
    found = {k: v for k, v in frames_of(assemble(stream)).items() if k[0] != 9}
    batch = spark.createDataFrame(rows, CHUNK)
    expected = {(r["camera"], 0): (None, r["error"]) for r in chunks.errors(batch, ["camera", "ts"]).collect()}
    assert found == {**expected, (3, 0): (b"x", None)}
    assert [expected[c, 0][1] for c in range(3)] == [chunks.FINAL_MISMATCH, chunks.SEQUENCE, chunks.FINAL_MISMATCH]


@both
def test_a_frame_delivered_again_comes_once(spark, tmp_path, assemble):
    stream = Stream(spark, str(tmp_path), CHUNK)
    rows = sorted(chunk_rows(spark, [(1, 0, bytes(range(20))), (2, 1, b"one chunk"[:5])]))
    stream.add(rows)
    stream.add(rows[:2])
    stream.add(rows[2:])
    stream.add(chunk_rows(spark, [(9, 60, b"later")]))
    stream.add(chunk_rows(spark, [(9, 120, b"later")]))
    found = [r for r in assemble(stream).collect() if r["camera"] != 9]
    assert sorted((r["camera"], bytes(r["data"]), r["error"]) for r in found) == [
        (1, bytes(range(20)), None), (2, b"one c", None)]


def test_a_null_key_is_an_error_row(spark, tmp_path):
    stream = Stream(spark, str(tmp_path), CHUNK)
    stream.add([(None, seconds(0), 0, 0, bytearray(b"x"), None), (1, None, 0, 0, bytearray(b"x"), None)])
    assert {(r["camera"], r["error"]) for r in with_state(stream).collect()} == {(None, chunks.NO_KEY), (1, chunks.NO_KEY)}


def test_bounded_streams_are_whole_in_any_number_of_batches(spark, tmp_path):
    rng = random.Random(8)
    rows = sorted(((rng.randrange(4), seconds(rng.randrange(900)), float(i)) for i in range(300)), key=lambda r: r[1])
    batch = spark.createDataFrame(rows, READING)

    def windows(df):
        return ev.window_counts(df.withWatermark("ts", "30 seconds"), ["d"], "ts", "20 seconds", "10 seconds")

    for files in (1, 5):
        stream = Stream(spark, str(tmp_path / str(files)), READING)
        for i in range(files):
            stream.add(rows[i * 300 // files:(i + 1) * 300 // files])
        source = logs.scan_stream(spark, f"{stream.folder}/in/*", READING, max_files=1)
        found = run.to_finished_table(
            windows(source), lambda mark: windows(batch).filter(F.col("window_end") > F.lit(mark)), "whole")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, windows(batch).collect()))


@both
def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, assemble):
    """Half a frame before the restart and half after it; windows counted once."""
    stream = Stream(spark, str(tmp_path), CHUNK)
    rows = sorted(chunk_rows(spark, [(1, 0, bytes(range(40)))]))
    stream.add(rows[:2])
    assert frames_of(assemble(stream)) == {}
    stream.add(rows[2:])
    assert frames_of(assemble(stream)) == {(1, 0): (bytes(range(40)), None)}
    assert len(assemble(stream).collect()) == 1


def test_restart_of_windows_equals_one_run(spark, tmp_path):
    def count(df):
        return ev.window_counts(df.withWatermark("ts", "5 seconds"), ["d"], "ts", "10 seconds")

    parts = [[(d, seconds(s), 1.0) for d in range(2) for s in range(a, a + 30)] for a in (0, 30, 60)]
    stepwise, at_once = (Stream(spark, str(tmp_path / n), READING) for n in ("a", "b"))
    for part in parts:
        stepwise.add(part)
        stepped = stepwise.run(count)
        at_once.add(part)
    once = at_once.run(count)
    assert sorted(map(tuple, stepped.collect())) == sorted(map(tuple, once.collect()))
    assert once.agg(F.sum("n_events")).first()[0] == 160


def test_late_rows_are_dropped(readings):
    """Spark drops a row one batch after the watermark has passed it."""
    readings.add([(1, seconds(5), 1.0), (1, seconds(600), 1.0)])
    readings.add([(1, seconds(700), 1.0)])
    readings.add([(1, seconds(6), 1.0), (1, seconds(800), 1.0)])
    readings.add([(1, seconds(7), 1.0), (1, seconds(2000), 1.0)])
    counted = readings.run(lambda df: ev.window_counts(df.withWatermark("ts", "60 seconds"), ["d"], "ts", "10 seconds"))
    found = {(r["window_start"] - START).seconds: r["n_events"] for r in counted.collect()}
    assert found == {0: 1, 600: 1, 700: 1, 800: 1}


def test_stream_equals_batch(spark, readings):
    rng = random.Random(6)
    rows = sorted((rng.randrange(4), seconds(rng.randrange(900)), float(i)) for i in range(400))
    rows.sort(key=lambda r: r[1])
    for i in range(0, 400, 100):
        readings.add(rows[i:i + 100])
    readings.add([(99, seconds(5000), 0.0)])
    readings.add([(99, seconds(5001), 0.0)])
    batch = spark.createDataFrame(rows, READING)

    def same(streamed, batched, columns):
        got = streamed.filter("d <> 99").select(*columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batched.select(*columns).collect()))

    columns = ["d", "window_start", "window_end", "n_events"]
    same(readings.run(lambda df: ev.window_counts(df.withWatermark("ts", "1 second"), ["d"], "ts", "20 seconds", "10 seconds"),
                      "sliding"),
         ev.window_counts(batch, ["d"], "ts", "20 seconds", "10 seconds"), columns)
    same(readings.run(lambda df: ev.stream_sessions(df, ["d"], "ts", 5, "1 second"), "sessions"),
         ev.sessions(batch, ["d"], "ts", 5), ["d", "session_start", "session_end", "n_events"])

    def sides(df):
        return df.select("d", F.col("ts").alias("t1"), F.col("v").alias("v1")), \
            df.select("d", F.col("ts").alias("t2"), F.col("v").alias("v2"))

    same(readings.run(lambda df: ev.stream_interval_join(*sides(df), "d", "t1", "t2", 2), "join"),
         ev.interval_join(*sides(batch), ["d"], "t1", "t2", 2), ["d", "t1", "t2", "v1", "v2"])


def test_sessions_by_the_clock(spark, tmp_path):
    """A quiet key closes by the clock alone; one that goes on does not; a restart keeps open sessions."""
    arriving = Stream(spark, str(tmp_path), "k string, n int")
    out = str(tmp_path / "out")
    schema = "k string, session_start timestamp, session_end timestamp, n_events bigint"

    def start():
        source = logs.scan_stream(spark, f"{tmp_path}/in/*", "k string, n int", max_files=1)
        found = state.sessions_by_clock(source, ["k"], 4)
        return sinks.stream_to_table(found, f"{out}/table", f"{out}/checkpoint", interval="200 milliseconds")

    def closed():
        return {(r["k"], r["n_events"]) for r in spark.read.schema(schema).parquet(f"{out}/table").collect()}

    def wait_for(expected):
        limit = time.time() + 60
        while time.time() < limit and not (os.path.exists(f"{out}/table") and expected <= closed()):
            time.sleep(0.3)
        assert closed() == expected

    arriving.add([("a", 1), ("a", 2), (None, 3)])
    query = start()
    try:
        wait_for({("a", 2), (None, 1)})
        arriving.add([("a", 4)])
        limit = time.time() + 30
        while time.time() < limit and sum(p["numInputRows"] for p in query.recentProgress) < 4:
            time.sleep(0.1)
    finally:
        query.stop()
    query = start()
    try:
        arriving.add([("b", 5)])  # Spark looks at no clock after a restart before it has had an event
        wait_for({("a", 2), (None, 1), ("a", 1), ("b", 1)})
    finally:
        query.stop()
    for row in spark.read.schema(schema).parquet(f"{out}/table").collect():
        assert (row["session_end"] - row["session_start"]).total_seconds() >= 4


def test_stored_arrivals_give_the_sessions_of_the_batch_form(spark, readings):
    rows = [(i % 3, seconds(i * i % 97 + 40 * (i // 20)), 0.0) for i in range(60)]
    rows.sort(key=lambda r: r[1])
    for at in range(0, 60, 20):
        readings.add(rows[at:at + 20])
    readings.add([(9, seconds(1000), 0.0)])
    found = readings.run(lambda df: ev.stream_arrival_sessions(df, ["d"], 5, "ts"))
    expected = ev.sessions(spark.createDataFrame(rows, READING), ["d"], "ts", 5)
    columns = ["d", "session_start", "session_end", "n_events"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_arrival_is_stamped_once(spark, tmp_path):
    arriving = Stream(spark, str(tmp_path), "k string, arrival_order int")
    arriving.add([("a", 1), ("a", 2)])
    arriving.add([("a", 3)])
    stamped = arriving.run(ev.stamp_arrival)
    first = {r["arrival_order"]: r["arrival"] for r in stamped.collect()}
    assert first == {r["arrival_order"]: r["arrival"] for r in stamped.collect()}
    assert first[1] == first[2] <= first[3]
    with pytest.raises(ValueError):
        ev.stamp_arrival(stamped)


def test_grid_of_discretized_stream(spark, tmp_path):
    schema = "camera int, frame_number int, ssrc int, timestamp timestamp, data binary"
    rows = [(c, n, 0, START + dt.timedelta(milliseconds=200 * n), bytearray([c, n])) for n in range(40) for c in range(3)]
    stream = Stream(spark, str(tmp_path), schema)
    stream.add(rows[:60])
    stream.add(rows[60:])
    stream.add([(0, 99, 0, seconds(100), bytearray(b"x"))])
    stream.add([(0, 100, 0, seconds(101), bytearray(b"x"))])

    def grids(df):
        slots = df.withColumn("slot", times.discretize(F.col("timestamp"), 2)).withWatermark("timestamp", "1 second")
        return grid.grid_rows(grid.last_per_camera(slots, "timestamp", "500 milliseconds"))

    found = stream.run(grids).filter(F.col("window_start") < F.lit("2024-01-01 00:00:10")).collect()
    expected = grid.grid_rows(grid.last_per_camera(spark.createDataFrame(rows, schema), "timestamp", "500 milliseconds"))
    assert sorted(map(str, found)) == sorted(map(str, expected.collect()))


def test_frame_counter_goes_on_after_restart(spark, tmp_path):
    stream = Stream(spark, str(tmp_path), "camera int, window_start timestamp")

    def number(df):
        return state.number_frames(df, "camera", "window_start")

    stream.add([(1000, seconds(s)) for s in (3, 0, 7)] + [(1001, seconds(5))])
    stream.run(number)
    stream.add([(1000, seconds(s)) for s in (12, 9)])
    found = sorted((r["camera"], (r["window_start"] - START).seconds, r["frame_number"]) for r in stream.run(number).collect())
    assert found == [(1000, 0, 0), (1000, 3, 1), (1000, 7, 2), (1000, 9, 3), (1000, 12, 4), (1001, 5, 0)]


def test_batches_replace_themselves(spark, tmp_path, readings):
    readings.add([(1, seconds(1), 1.0)])
    readings.add([(2, seconds(2), 2.0)])

    def start(checkpoint):
        source = logs.scan_stream(spark, f"{tmp_path}/in/*", READING, max_files=1)
        sinks.stream_to_batches(source, f"{tmp_path}/batches", f"{tmp_path}/{checkpoint}",
                                lambda b: b.orderBy("ts")).awaitTermination()
        return sorted((r["batch"], r["d"]) for r in spark.read.parquet(f"{tmp_path}/batches").collect())

    assert start("first") == [(0, 1), (1, 2)]
    # All batches once more, as after a crash before the commit.
    assert start("second") == [(0, 1), (1, 2)]


def test_row_and_console_sinks(spark, tmp_path, readings):
    readings.add([(1, seconds(1), 1.0), (2, seconds(2), 2.0)])
    folder = str(tmp_path)

    class Writer:
        def open(self, partition_id, epoch_id):
            self.lines = []
            return True

        def process(self, row):
            self.lines.append(f"{row.d}={row.v}")

        def close(self, error):
            if self.lines:
                with open(f"{folder}/{self.lines[0]}.txt", "w") as file:
                    file.write("\n".join(self.lines))

    source = logs.scan_stream(spark, f"{folder}/in/*", READING)
    sinks.stream_to_rows(source, Writer(), f"{folder}/rows").awaitTermination()
    written = [p.read_text() for p in tmp_path.glob("*.txt")]
    assert sorted("\n".join(written).split()) == ["1=1.0", "2=2.0"]
    sinks.stream_to_console(source, f"{folder}/console", interval=None).awaitTermination()


def test_rate_source_and_interval_trigger(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", "20").load()
    keyed = rate.withColumn("key", times.value_bucket(F.col("value"), 5))
    query = sinks.stream_to_table(keyed, f"{tmp_path}/rate", f"{tmp_path}/checkpoint", interval="1 second")
    try:
        deadline = time.time() + 30
        while time.time() < deadline and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.5)
    finally:
        query.stop()
    rows = spark.read.parquet(f"{tmp_path}/rate").collect()
    assert rows and all(r["key"] == r["value"] // 5 for r in rows)


def test_rocksdb_state(spark, readings):
    previous = {name: spark.conf.get(name, None) for name in STREAMING_CONF}
    configure(spark, STREAMING_CONF)
    try:
        readings.add([(1, seconds(s), 1.0) for s in range(10)])
        readings.add([(1, seconds(100), 1.0)])
        counted = readings.run(lambda df: ev.window_counts(df.withWatermark("ts", "1 second"), ["d"], "ts", "10 seconds"))
        assert [(r["n_events"]) for r in counted.collect()] == [10]
    finally:
        for name, value in previous.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_streams_keep_state_off_the_heap(spark, readings):
    readings.add([(1, seconds(1), 1.0)])
    readings.run(lambda df: ev.window_counts(df.withWatermark("ts", "1 second"), ["d"], "ts", "10 seconds"))
    assert all(spark.conf.get(name) == value for name, value in STREAMING_CONF.items())


def test_a_filter_on_the_end_keeps_sessions_whole(spark):
    """Sessions that are still open at the end of a stream are chosen by their end, not by that of their events."""
    rows = [(1, seconds(s), 0.0) for s in (0, 4, 8, 12)] + [(2, seconds(1), 0.0)]
    found = ev.stream_sessions(spark.createDataFrame(rows, READING), ["d"], "ts", 5, "1 second")
    chosen = found.filter((F.col("session_end") > F.lit(seconds(10))) & (F.col("session_start") < F.lit(seconds(2))))
    assert [tuple(r) for r in chosen.collect()] == [(1, seconds(0), seconds(17), 4)]


def test_reassembly_calls_python_by_bucket_not_by_frame(spark, tmp_path):
    """300 frames are four states; long ids stay exact beside a NULL, and half a frame waits in its bucket."""
    stream = Stream(spark, str(tmp_path), CHUNK.replace("camera int", "camera long"))
    big, part = 2**53 + 1, (bytearray(b"x"), None)
    stream.add([(big + c, seconds(1), 0, 0, *part) for c in range(299)] + [(5, seconds(1), 1, 1, *part), (None, seconds(1), 0, 0, *part)])
    stream.add([(5, seconds(1), 0, 1, *part)])
    source = logs.scan_stream(spark, f"{stream.folder}/in/*", stream.schema, max_files=1)
    found = state.reassemble(source, ["camera", "ts"], "ts", "1 second", buckets=4)
    out = f"{tmp_path}/out"
    query = sinks.stream_to_table(found, f"{out}/table", f"{out}/checkpoint")
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(states) <= 4
    rows = spark.read.schema(found.schema).parquet(f"{out}/table").collect()
    assert {(r["camera"], r["n_chunks"], r["data"] and bytes(r["data"]), r["error"]) for r in rows} == {
        *((big + c, 1, b"x", None) for c in range(299)), (5, 2, b"xx", None), (None, 1, None, chunks.NO_KEY)}
    assert len(rows) == 301


def test_interval_join_keeps_few_rows_and_takes_no_state_apart_at_the_end(spark, readings):
    """40 rows within the first halves of their buckets are 40 rows of state a side, and pairs reach over borders."""
    rows = [(d, seconds(20 * s + 2), float(s)) for d in range(4) for s in range(10)]
    borders = [(9, seconds(s), float(s)) for s in (109, 110, 119, 120, 125, 129, 130)]
    batch = spark.createDataFrame(rows + borders, READING)

    def joined(df, join, keys):
        left = df.select("d", F.col("ts").alias("t1"), F.col("v").alias("v1"))
        return join(left, df.select("d", F.col("ts").alias("t2"), F.col("v").alias("v2")), keys, "t1", "t2", 10)

    readings.add(rows)
    readings.add(borders)
    source = logs.scan_stream(spark, f"{readings.folder}/in/*", READING, max_files=2)
    found, out = joined(source, ev.stream_interval_join, "d"), f"{readings.folder}/out"
    with sinks.no_idle_batches(spark):
        query = sinks.stream_to_table(found, f"{out}/table", f"{out}/checkpoint")
        query.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    assert all(p["numInputRows"] for p in query.recentProgress if p["stateOperators"])
    assert query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] <= 2 * 47 + len(borders)
    got = spark.read.schema(found.schema).parquet(f"{out}/table")
    columns = ["d", "t1", "t2", "v1", "v2"]
    expected = joined(batch, ev.interval_join, ["d"])
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))
