import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.functions import codec
from sensorloom.operators import chunks
from tests import fixtures as fx

N = 16
KEYS = schemas.FILE_CHUNK_KEY


def read(spark, folder, ddl):
    return schemas.normalize_names(spark.read.json(folder, schema=ddl))


def times(rows):
    return sorted((r["timestamp"].strftime("%H:%M:%S.%f")[:-3], r["ssrc"]) for r in rows)


@pytest.fixture()
def writers(spark, tmp_path):
    return read(spark, fx.write(tmp_path / "in", *fx.WRITER_FILES), schemas.FILE_CHUNK)


def test_reassemble_two_writers(writers):
    rows = chunks.reassemble(writers, KEYS).collect()
    assert times(rows) == fx.COMPLETE
    assert {bytes(r["data"]) for r in rows} == {fx.WHOLE}
    assert {r["n_chunks"] for r in rows} == {4}


def test_errors_two_writers(writers):
    rows = chunks.errors(writers, KEYS).collect()
    assert sorted((r["timestamp"].strftime("%H:%M"), r["ssrc"], r["error"]) for r in rows) == [
        ("06:16", 501, chunks.SEQUENCE), ("06:16", 502, chunks.SEQUENCE),
        ("06:17", 901, chunks.SEQUENCE), ("06:17", 902, chunks.COUNT), ("06:40", 501, chunks.COUNT),
    ]


def test_join_equals_reassembly(writers):
    joined = chunks.join_chunks(writers.filter("final_chunk_index = 3"), KEYS, 4)
    rows = joined.withColumn("data", chunks.concat_chunks(4, null_safe=False)).collect()
    assert times(rows) == fx.COMPLETE
    assert {bytes(r["data"]) for r in rows} == {fx.WHOLE}


def test_join_is_one_shuffle_of_the_payload(writers):
    plan = chunks.join_chunks(writers, KEYS, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_join_of_copies_nulls_and_null_keys(spark):
    rows = [(1, 0, b"b"), (1, 0, b"a"), (1, 1, b"c"), (2, 0, None), (2, 1, b"d"), (3, 1, b"e"), (None, 0, b"f"), (None, 1, b"g")]
    parts = spark.createDataFrame(rows, "id int, chunk_index int, data binary")
    inner = {tuple(r) for r in chunks.join_chunks(parts, ["id"], 2).collect()}
    assert inner == {(1, b"a", b"c"), (2, None, b"d")}
    left = {tuple(r) for r in chunks.join_chunks(parts, ["id"], 2, "left").collect()}
    assert left == {(1, b"a", b"c"), (2, None, b"d"), (None, b"f", None)}
    twice = parts.union(parts.filter("id IS NULL").selectExpr("id", "chunk_index", "cast('h' as binary)"))
    lone = chunks.join_chunks(twice, ["id"], 2, "left").filter("id IS NULL").collect()
    assert sorted(tuple(r) for r in lone) == [(None, b"f", None), (None, b"h", None)]


def test_checks_of_the_frames(writers):
    frames = chunks.reassemble(writers, KEYS)
    row = frames.select(
        codec.is_checksum_correct(F.col("data")).alias("ok"), codec.checksum(F.col("data")).alias("stored"),
        F.crc32(codec.checked_payload(F.col("data"))).alias("found"), F.hex(codec.frame_hash(F.col("data"))).alias("h"),
    ).distinct().collect()
    stored, found = int.from_bytes(fx.WHOLE[:4], "big"), zlib.crc32(fx.WHOLE[4:])
    assert [tuple(r) for r in row] == [(False, stored, found, hashlib.sha1(fx.WHOLE).hexdigest()[:12].upper())]


def test_dedup_keeps_least_ssrc(writers):
    frames = chunks.reassemble(writers, KEYS)
    kept = chunks.dedup_frames(frames, ["timestamp", "camera"], ["ssrc"])
    assert times(kept.collect()) == [(fx.FIRST, 501), (fx.SECOND, 501), (fx.THIRD, 502)]


def test_joins_without_count(spark, tmp_path):
    ddl = "timestamp timestamp, camera int, chunk int, data binary"
    parts = read(spark, fx.write(tmp_path / "in", fx.PLAIN), ddl)
    for n, data in ((2, b"north east "), (4, fx.WHOLE)):
        rows = chunks.join_chunks(parts, ["timestamp", "camera"], n).select(
            "timestamp", chunks.concat_chunks(n, False).alias("data")).collect()
        assert sorted((r["timestamp"].minute, bytes(r["data"])) for r in rows) == [(15, data), (17, data)]


def test_numeric_chunks(spark, tmp_path):
    ddl = "timestamp timestamp, camera int, chunk int, data double"
    parts = read(spark, fx.write(tmp_path / "in", fx.NUMBERS), ddl)
    joined = chunks.join_chunks(parts, ["timestamp", "camera"], 2).collect()
    assert [(r["timestamp"].minute, r["data_0"], r["data_1"]) for r in joined] == [(15, 2.5, 7.5)]
    sums = parts.groupBy("timestamp", "camera").sum("data").collect()
    assert sorted((r["timestamp"].minute, r["sum(data)"]) for r in sums) == [(15, 50.0), (17, 6.0), (40, 9.0)]


def test_variable_chunk_count(spark, tmp_path):
    parts = read(spark, fx.write(tmp_path / "in", fx.VARIABLE), schemas.FILE_CHUNK)
    rows = chunks.join_chunks(parts.filter("final_chunk_index <= 2"), KEYS, 3, "left").select(
        "timestamp", chunks.concat_chunks(3, False).alias("plain"), chunks.concat_chunks(3, True).alias("safe"),
    ).orderBy("timestamp").collect()
    plain = [r["plain"] and bytes(r["plain"]) for r in rows]
    safe = [bytes(r["safe"]) for r in rows]
    assert plain == [b"north east south ", None, None]
    assert safe == [b"north east south ", b"north east ", b"north "]
    grouped = chunks.reassemble(parts, KEYS).orderBy("timestamp").collect()
    assert [bytes(r["data"]) for r in grouped] == safe


def frames_of_sizes(spark, sizes):
    rng = random.Random(7)
    rows = [(i, bytearray(rng.randbytes(n))) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "id int, data binary").withColumn("hash", codec.frame_hash(F.col("data")))


SIZES = [0, 1, N - 1, N, N + 1, 3 * N, 3 * N + 5, 40 * N]


def test_split_sizes(spark):
    parts = chunks.split(frames_of_sizes(spark, SIZES), N)
    counts = {r["id"]: (r["count"], r["last"]) for r in
              parts.groupBy("id").agg(F.count("*").alias("count"), F.max("final_chunk_index").alias("last")).collect()}
    expected = {i: (max(1, -(-n // N)),) * 2 for i, n in enumerate(SIZES)}
    assert counts == {i: (n, n - 1) for i, (n, _) in expected.items()}


def test_split_then_reassemble_is_identity(spark):
    frames = frames_of_sizes(spark, SIZES)
    parts = chunks.split(frames, N).orderBy(F.rand(3)).repartition(5)
    back = chunks.check_hash(chunks.reassemble(parts, ["id"], carry=["hash"]))
    assert {r["id"]: bytes(r["data"]) for r in back.collect()} == {r["id"]: bytes(r["data"]) for r in frames.collect()}
    assert back.filter("NOT is_hash_valid").count() == 0
    assert chunks.require_hash(back).count() == len(SIZES)


def test_split_v1_then_parse(spark):
    frames = frames_of_sizes(spark, SIZES)
    events = chunks.split_v1(frames, codec.V1_SLICE_OVERHEAD + N)
    parts = chunks.parse_v1(events)
    assert {r["version"] for r in parts.select("version").distinct().collect()} == {1}
    back = {r["id"]: bytes(r["data"]) for r in chunks.reassemble(parts, ["id"]).collect()}
    # An empty payload has no v1 chunk.
    assert back == {r["id"]: bytes(r["data"]) for r in frames.collect() if r["data"]}


def test_too_many_chunks_fail(spark):
    frames = spark.createDataFrame([(1, bytearray(chunks.MAX_CHUNKS + 1))], "id int, data binary")
    assert chunks.split(frames, 2).count() == chunks.MAX_CHUNKS // 2 + 1
    with pytest.raises(Exception, match="more than 32768 chunks"):
        chunks.split(frames, 1).count()


def expected_error(rows):
    """The checks one after the other over all chunks in index order."""
    rows = sorted(rows)
    finals = {f for _, f in rows}
    if len(finals) > 1:
        return chunks.FINAL_MISMATCH
    final = finals.pop()
    if any(not 0 <= i <= final for i, _ in rows):
        return chunks.INDEX_RANGE
    if [i for i, _ in rows] != list(range(len(rows))):
        return chunks.SEQUENCE
    return None if len(rows) == final + 1 else chunks.COUNT


def test_random_faults(spark):
    rng = random.Random(11)
    rows = []
    for frame in range(300):
        final = rng.randrange(0, 6)
        frame_rows = [(i, final) for i in range(final + 1)]
        for _ in range(rng.randrange(0, 3)):
            fault = rng.randrange(4)
            at = rng.randrange(len(frame_rows))
            if fault == 0 and len(frame_rows) > 1:
                frame_rows.pop(at)
            elif fault == 1:
                frame_rows.append(frame_rows[at])
            elif fault == 2:
                frame_rows[at] = (frame_rows[at][0], final + 1)
            else:
                frame_rows[at] = (rng.choice([-1, final + 2]), frame_rows[at][1])
        rows += [(frame, i, f, bytearray([i % 256])) for i, f in frame_rows]
    rng.shuffle(rows)
    parts = spark.createDataFrame(rows, "id int, chunk_index smallint, final_chunk_index smallint, data binary")
    by_frame = defaultdict(list)
    for frame, i, f, _ in rows:
        by_frame[frame].append((i, f))
    expected = {frame: expected_error(r) for frame, r in by_frame.items()}
    got = {r["id"]: r["error"] for r in chunks.errors(parts, ["id"]).collect()}
    assert got == {frame: e for frame, e in expected.items() if e}
    whole = {r["id"]: bytes(r["data"]) for r in chunks.reassemble(parts, ["id"]).collect()}
    assert whole == {frame: bytes(range(len(by_frame[frame]))) for frame, e in expected.items() if not e}


def test_hot_frame_of_copies(spark):
    """A frame with far more rows than chunks: reported, and out of the way of the good ones."""
    good = chunks.split(frames_of_sizes(spark, [N * 3] * 20), N).drop("hash")
    copies = spark.range(2 * chunks.MAX_CHUNKS).select(
        F.lit(99).alias("id"), F.lit(0).cast("smallint").alias("chunk_index"),
        F.lit(0).cast("smallint").alias("final_chunk_index"), F.lit(b"x").alias("data"))
    parts = good.unionByName(copies)
    assert chunks.reassemble(parts, ["id"]).count() == 20
    assert [(r["id"], r["n_rows"], r["error"]) for r in chunks.errors(parts, ["id"]).collect()] == [
        (99, 2 * chunks.MAX_CHUNKS, chunks.SEQUENCE)]


def test_rows_without_key_are_errors(spark):
    rows = [(None, 0, 0, bytearray(b"a")), (1, 0, 0, bytearray(b"b"))]
    parts = spark.createDataFrame(rows, "id int, chunk_index smallint, final_chunk_index smallint, data binary")
    assert [r["id"] for r in chunks.reassemble(parts, ["id"]).collect()] == [1]
    assert [(r["id"], r["error"]) for r in chunks.errors(parts, ["id"]).collect()] == [(None, chunks.NO_KEY)]


def test_wrong_hash(spark):
    frames = frames_of_sizes(spark, [5, 50]).withColumn("hash", F.when(F.col("id") == 1, F.lit(b"wrong!")).otherwise(F.col("hash")))
    back = chunks.reassemble(chunks.split(frames, N), ["id"], carry=["hash"])
    assert {r["id"]: r["is_hash_valid"] for r in chunks.check_hash(back).collect()} == {0: True, 1: False}
    with pytest.raises(Exception, match=chunks.HASH):
        chunks.require_hash(back).collect()


def test_hash_is_truncated_sha1(spark):
    data = b"some payload"
    row = spark.createDataFrame([(bytearray(data),)], "data binary").select(codec.frame_hash(F.col("data"))).first()
    assert bytes(row[0]) == hashlib.sha1(data).digest()[:6]
