import random
import struct

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators import ordering
from sensorloom.sources import log as logs
from sensorloom.sources import sinks


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("log") / "table")
    rows = spark.range(4000).select(
        F.lit("plant").alias("scope"), F.when(F.col("id") % 5 == 0, "video").otherwise("sensors").alias("stream"),
        (F.col("id") % 4).alias("segment_id"), F.col("id").alias("offset"),
        (F.col("id") % 7).cast("string").alias("routing_key"),
        F.encode(F.concat(F.lit("event "), F.col("id").cast("string")), "UTF-8").alias("event"))
    rows.sort("offset").coalesce(1).write.parquet(folder)
    return folder


def offsets(df):
    return sorted((r["segment_id"], r["offset"]) for r in df.collect())


def test_scan_one_stream(spark, path):
    assert logs.scan(spark, path).count() == 4000
    assert logs.scan(spark, path, "plant", "video").count() == 800
    assert logs.scan(spark, path).schema.fieldNames() == [p.split()[0] for p in schemas.LOG.split(", ")]


def test_extent(spark, path):
    found = logs.extent(logs.scan(spark, path)).collect()
    assert sorted(tuple(r) for r in found) == [(s, s, 3996 + s + 1) for s in range(4)]


def test_between(spark, path):
    log = logs.scan(spark, path)
    start, end = {0: 100, 1: 200, 2: 0}, {0: 300, 1: 201, 3: 4000}
    expected = [(s, o) for s in (0, 1) for o in range(start[s], end[s]) if o % 4 == s]
    assert offsets(logs.between(log, start, end)) == sorted(expected)
    assert logs.between(log, None, {0: 8}).count() == 2
    assert logs.between(log, {0: 3992}, None).count() == 2
    assert logs.between(log, {}, {}).count() == 0
    assert logs.between(log, None, None).count() == 4000


def test_bounded_read_reaches_the_scan(spark, path):
    plan = logs.between(logs.scan(spark, path), {0: 100, 1: 200}, {0: 300, 1: 400})._jdf.queryExecution().toString()
    pushed = plan[plan.rindex("PushedFilters"):]
    assert "GreaterThanOrEqual(offset,100)" in pushed and "LessThan(offset,400)" in pushed


def test_cut_tables(spark, path):
    log = logs.scan(spark, path)
    cuts = spark.createDataFrame([(0, 100, 300), (0, 200, 320), (0, 900, 904), (1, 200, 201), (2, 5, 5), (3, None, 9), (1, 3990, None)],
                                 "segment_id long, from_offset long, to_offset long")
    ranges = [(0, 100, 320), (0, 900, 904), (1, 200, 201), (3, 0, 9), (1, 3990, 4000)]
    expected = [(s, o) for s, a, b in ranges for o in range(a, b) if o % 4 == s]
    assert offsets(logs.between_cuts(log, cuts)) == sorted(expected)
    assert logs.between_cuts(log, cuts.limit(0)).count() == 0
    tails = spark.createDataFrame([(0, 3990), (0, 3000), (1, 4000), (2, 3991)], "segment_id long, tail_offset long")
    ahead = [(s, o) for s, t in [(0, 3990), (1, 4000), (2, 3991), (3, 0)] for o in range(t, 4000) if o % 4 == s]
    assert offsets(logs.from_tail(log, tails)) == sorted(ahead)
    assert logs.from_tail(log, tails.limit(0)).count() == 4000


def test_cuts_of_events_without_a_segment(spark):
    log = spark.createDataFrame([(None, 1), (None, 5), (7, 5)], "segment_id long, offset long")
    cuts = spark.createDataFrame([(None, 2, 9)], "segment_id long, from_offset long, to_offset long")
    assert [tuple(r) for r in logs.between_cuts(log, cuts).collect()] == [(None, 5)]
    tails = cuts.selectExpr("segment_id", "5L AS tail_offset")
    assert sorted((tuple(r) for r in logs.from_tail(log, tails).collect()), key=repr) == [(7, 5), (None, 5)]


def test_named_table(spark, path):
    assert logs.register(logs.scan(spark, path), "events_by_name").count() == 4000
    assert spark.sql("SELECT count(*) AS n FROM events_by_name WHERE offset < 10").first()["n"] == 10


def test_routed_write_keeps_order_and_splits_a_hot_key(spark, tmp_path, many_partitions):
    events = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 50).cast("string")).alias("routing_key"),
        F.col("id").alias("offset")).orderBy(F.rand(1))
    path = str(tmp_path / "routed")
    sinks.write_routed(events, path, ["offset"])
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file")).collect()
    assert len(rows) == 9000
    files = sorted({r["file"] for r in rows})
    by_file = {f: [(r["routing_key"], r["offset"]) for r in rows if r["file"] == f] for f in files}
    in_order = [pair for f in files for pair in by_file[f]]
    assert in_order == sorted(in_order)
    assert sum(any(k == "0" for k, _ in by_file[f]) for f in files) > 1


def test_events_with_key(spark):
    frame = spark.createDataFrame([(3, 7)], "camera int, frame_number int")
    row = sinks.to_events(frame, F.col("camera").cast("string"), "camera", "frame_number").first()
    assert (row["routing_key"], bytes(row["event"])) == ("3", b'{"camera":3,"frame_number":7}')


def test_shuffled_does_not_depend_on_partitions(spark, tmp_path):
    rows = spark.range(500).withColumn("v", F.col("id") * 2)
    orders = [[r["id"] for r in sinks.shuffled(rows.repartition(n), ["id"], seed).collect()]
              for n, seed in ((1, 1), (7, 1), (7, 2))]
    assert orders[0] == orders[1] != orders[2]
    assert sorted(orders[0]) == list(range(500)) != orders[0]
    sinks.write_json(sinks.shuffled(rows, ["id"], 1), str(tmp_path / "out"))
    sinks.write_json(sinks.shuffled(rows, ["id"], 1), str(tmp_path / "out"))
    assert spark.read.schema("id long, v long").json(str(tmp_path / "out")).count() == 500


def test_sample(spark):
    rows = sinks.sample(spark.range(100).repartition(5), ["id"], 3, cached=True)
    assert [r["id"] for r in rows.collect()] == [0, 1, 2]
    rows.unpersist()


def test_file_per_frame(spark, tmp_path):
    frames = spark.range(12).select((F.col("id") % 3).cast("int").alias("camera"),
                                    (F.col("id") / 3).cast("int").alias("frame_number"), F.lit(b"x").alias("data"))
    sinks.write_per_frame(frames.filter("frame_number < 2"), str(tmp_path / "frames"))
    files = list((tmp_path / "frames").glob("camera=*/frame_number=*/*.parquet"))
    assert len(files) == 6


def test_blocks_of_a_log_are_bounded(spark):
    sizes = spark.range(10_000).groupBy(ordering.offset_block(F.col("id"), 10).alias("b")).count().collect()
    assert max(r["count"] for r in sizes) <= 1024


def test_payloads_in_log_order(spark):
    """Chunks have no key: frames are told apart by their order. The first and the last are cut off."""
    sizes = {0: [5, 16, 17, 40], 1: [1, 33]}
    rows, expected = [], []
    for segment, lengths in sizes.items():
        offset = 100 * segment
        for n, length in enumerate(lengths):
            payload = bytes((segment * 50 + n * 7 + i) % 256 for i in range(length))
            pieces = [payload[i:i + 8] for i in range(0, length, 8)]
            expected.append((segment, offset, payload))
            for i, piece in enumerate(pieces):
                rows.append((segment, offset, bytearray(struct.pack("!bxxxhh", 1, i, len(pieces) - 1) + piece)))
                offset += 3
    rows.append((0, 0, bytearray(struct.pack("!bxxxhh", 1, 2, 2) + b"end of an earlier one")))
    rows.append((1, 900, bytearray(struct.pack("!bxxxhh", 1, 0, 1) + b"not finished")))
    rows = [(s, o + 1, e) if (s, o) != (0, 0) or e[5] == 0 else (s, o, e) for s, o, e in rows]
    log = spark.createDataFrame(rows, "segment_id long, offset long, event binary").orderBy(F.rand(2)).repartition(4)
    for bits in (2, 20):
        whole = logs.scan_payloads(log, "chunked_v1", bits).collect()
        assert sorted((r["segment_id"], r["offset"] - 1, bytes(r["data"])) for r in whole) == sorted(expected)
        errors = logs.payload_errors(log, bits).collect()
        assert sorted((r["segment_id"], r["frame"], r["error"]) for r in errors) == [
            (0, 0, "index_not_next"), (1, 3, "count_differs")]
    assert logs.scan_payloads(log).count() == len(rows)
    with pytest.raises(ValueError):
        logs.scan_payloads(log, "other")


def _chunked(writer, payload, size):
    pieces = [payload[i:i + size] for i in range(0, len(payload), size)]
    return [(writer, bytearray(struct.pack("!bxxxhh", 1, i, len(pieces) - 1) + piece)) for i, piece in enumerate(pieces)]


def _interleaved(seed, gap=1):
    """Three writers that take turns at random, each sending frame after frame; offsets of first chunks by payload."""
    pick = random.Random(seed)
    streams = {w: [p for n in range(12) for p in _chunked(w, bytes(pick.randrange(256) for _ in range(pick.choice([1, 5, 9, 30]))), 4)]
               for w in ("a", "b", None)}
    rows, offset = [], 0
    while any(streams.values()):
        writer = pick.choice([w for w, left in streams.items() if left])
        rows.append((7, offset, *streams[writer].pop(0)))
        offset += gap
    return rows


def _frames_of(rows):
    """Each writer's events alone, one after another."""
    found = []
    for writer in ("a", "b", None):
        start, data = None, b""
        for _, offset, key, event in rows:
            if key == writer:
                _, index, final = struct.unpack("!bxxxhh", event[:8])
                start, data = (offset, bytes(event[8:])) if index == 0 else (start, data + event[8:])
                if index == final:
                    found.append((7, start, final + 1, data))
    return sorted(found)


@pytest.mark.parametrize("bits", [1, 3, 9])
def test_interleaved_writers_by_key(spark, bits):
    rows = _interleaved(1)
    log = spark.createDataFrame(rows, "segment_id long, offset long, routing_key string, event binary").repartition(3)
    whole = logs.scan_payloads(log, "chunked_v1", 2, by="routing_key", payload_bits=bits)
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in whole.collect()) == _frames_of(rows)
    assert logs.payload_errors(log, by="routing_key").count() == 0
    assert logs.payload_errors(log).count() > 0  # taken for one writer's
    lost = log.filter("offset <> 5")
    assert logs.payload_errors(lost, by="routing_key").count() <= 1
    assert logs.scan_payloads(lost, "chunked_v1", by="routing_key").count() >= len(_frames_of(rows)) - 1


def test_interleaved_writers_without_a_key(spark):
    """Writers that keep their turns: the oldest frame that expects an index is the right one."""
    pick = random.Random(3)
    rows, offset = [], 0
    for _ in range(20):
        order = pick.sample(["a", "b", None], 3)
        sent = {w: _chunked(w, bytes(pick.randrange(256) for _ in range(pick.choice([3, 8, 20]))), 4) for w in order}
        while any(sent.values()):
            for w in order:
                if sent[w]:
                    rows.append((7, offset, *sent[w].pop(0)))
                    offset += 1
    log = spark.createDataFrame(rows, "segment_id long, offset long, routing_key string, event binary").repartition(3)
    whole = logs.scan_payloads(log.drop("routing_key"), "chunked_v1", writers=3, payload_bits=4)
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in whole.collect()) == _frames_of(rows)


def test_a_frame_that_is_given_up_takes_no_other_frames_chunks(spark):
    events = _chunked("a", b"12345678", 4)[:1] + _chunked("a", b"abcdefgh", 4) + _chunked("a", b"ABCDEFGH", 4) + _chunked("b", b"x" * 12, 4)[1:2]
    log = spark.createDataFrame([(1, i, e) for i, (_, e) in enumerate(events)], "segment_id long, offset long, event binary")
    whole = logs.scan_payloads(log, "chunked_v1", writers=1)
    assert sorted((r["offset"], bytes(r["data"])) for r in whole.collect()) == [(1, b"abcdefgh"), (3, b"ABCDEFGH")]
    assert sorted((r["frame"], r["error"]) for r in logs.payload_errors(log, writers=1).collect()) == [
        (-6, "index_not_next"), (0, "count_differs")]
    with pytest.raises(ValueError):
        logs.chunked_frames(log, by="event", writers=2)


def test_segments_of_several_streams_are_apart(spark):
    rows = [("s", t, 1, i, e) for t in ("left", "right") for i, (_, e) in enumerate(_chunked(t, t.encode() * 3, 4))]
    log = spark.createDataFrame(rows, "scope string, stream string, segment_id long, offset long, event binary")
    whole = logs.scan_payloads(log, "chunked_v1")
    assert sorted((r["stream"], bytes(r["data"])) for r in whole.collect()) == [("left", b"left" * 3), ("right", b"right" * 3)]
    assert sorted((r["stream"], r["tail_offset"]) for r in logs.extent(log, logs.segment_columns(log)).collect()) == [("left", 3), ("right", 4)]
