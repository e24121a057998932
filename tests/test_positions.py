"""Streaming reassembly with payloads outside the state."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import codec
from sensorloom.streaming import positions

START = dt.datetime(2024, 5, 1)
SCHEMA = "camera string, timestamp timestamp, chunk_index smallint, final_chunk_index smallint, data binary, hash binary, segment_id bigint, offset bigint"
KEYS = ["camera", "timestamp"]


def chunk(offset, camera, second, index, final, data=None, digest=None):
    time = START + dt.timedelta(seconds=second) if second is not None else None
    data = f"{camera}{second}.{index};".encode() if data is None else data
    return (camera, time, index, final, bytearray(data), digest, 3, offset)


class Log:
    """A folder that grows by one file a step; the stream is stopped and started again after each."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def append(self, *rows):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def run(self, **more):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/log")
        query = positions.reassemble_to_table(
            stream, lambda s: s.read.schema(SCHEMA).parquet(f"{self.folder}/log"), KEYS, "timestamp", "5 seconds",
            self.folder, f"{self.folder}/checkpoint", buckets=3, **more)
        query.awaitTermination()
        return query

    def frames(self):
        rows = self.spark.read.parquet(f"{self.folder}/frames").collect()
        return sorted(((r["camera"], None if r["timestamp"] is None else (r["timestamp"] - START).seconds, r["n_chunks"],
                        None if r["data"] is None else bytes(r["data"]), r["error"]) for r in rows), key=repr)


@pytest.fixture()
def log(spark, tmp_path):
    return Log(spark, tmp_path)


def test_frames_come_with_their_last_chunk_over_restarts(log):
    log.append(chunk(0, "a", 1, 1, 2), chunk(1, "b", 1, 0, 0), chunk(2, "a", 1, 0, 2))
    log.run()
    assert log.frames() == [("b", 1, 1, b"b1.0;", None)]
    log.append(chunk(3, "a", 2, 0, 1), chunk(4, "a", 1, 2, 2))
    log.run()
    assert log.frames() == [("a", 1, 3, b"a1.0;a1.1;a1.2;", None), ("b", 1, 1, b"b1.0;", None)]
    log.append(chunk(5, "a", 2, 1, 1), chunk(6, "a", 1, 0, 2), chunk(7, "b", 1, 0, 0))  # two of them for the second time
    log.run()
    assert log.frames() == [("a", 1, 3, b"a1.0;a1.1;a1.2;", None), ("a", 2, 2, b"a2.0;a2.1;", None), ("b", 1, 1, b"b1.0;", None)]


def test_errors(log):
    whole = b"xy"
    log.append(
        chunk(0, "gap", 1, 0, 2), chunk(1, "gap", 1, 2, 2), chunk(2, "twice", 1, 0, 1), chunk(3, "twice", 1, 0, 1),
        chunk(4, "final", 1, 0, 1), chunk(5, "final", 1, 1, 2), chunk(6, "range", 1, 4, 2), chunk(7, "null", 1, None, 1),
        chunk(8, "nofinal", 1, 0, None), chunk(9, None, 1, 0, 0), chunk(10, "notime", None, 0, 0), chunk(11, None, 1, 0, 0),
        chunk(12, "hash", 1, 0, 0, whole, bytearray(b"badhash")), chunk(13, "short", 1, 0, 1))
    log.run()
    at_once = [
        ("final", 1, 2, None, "final_index_differs"), ("hash", 1, 1, None, "hash_differs"), ("nofinal", 1, 1, None, "final_index_differs"),
        ("notime", None, 1, None, "no_key"), ("null", 1, 1, None, "index_not_next"), ("range", 1, 1, None, "index_out_of_range"),
        ("twice", 1, 2, None, "index_not_next"), (None, 1, 2, None, "no_key")]
    assert log.frames() == sorted(at_once, key=repr)
    log.append(chunk(20, "later", 60, 0, 0))
    log.run()
    log.append(chunk(21, "later", 61, 0, 0))
    log.run()
    late = [("gap", 1, 2, None, "index_not_next"), ("short", 1, 1, None, "count_differs"),
            ("later", 0 + 60, 1, b"later60.0;", None), ("later", 61, 1, b"later61.0;", None)]
    assert log.frames() == sorted(at_once + late, key=repr)


def test_good_hash(log, spark):
    digest = spark.range(1).select(codec.frame_hash(F.encode(F.lit("payload"), "UTF-8"))).first()[0]
    log.append(chunk(0, "a", 1, 1, 1, b"load", digest), chunk(1, "a", 1, 0, 1, b"pay", digest))
    log.run()
    assert log.frames() == [("a", 1, 2, b"payload", None)]


def test_no_payload_in_the_state(log):
    log.append(*[chunk(i, "a", 1, i, 40, b"#" * 10_000) for i in range(40)])
    log.run()
    found = []
    for folder, _, files in os.walk(f"{log.folder}/checkpoint/state"):
        for name in files:
            with open(os.path.join(folder, name), "rb") as file:
                found.append(file.read())
    assert found and not any(b"#" * 100 in content for content in found)


def test_log_is_read_by_offset_range(spark, log):
    log.append(*[chunk(i, "a", i, 0, 0) for i in range(100)])
    found = spark.createDataFrame([("a", START + dt.timedelta(seconds=s), 1, None, [(0, 3, s)]) for s in (40, 44)],
                                  "camera string, timestamp timestamp, n_chunks bigint, error string, "
                                  "places array<struct<chunk_index: int, segment_id: bigint, offset: bigint>>")
    read = positions.fetch(found, spark.read.schema(SCHEMA).parquet(f"{log.folder}/log"), KEYS)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,40)" in plan and "LessThanOrEqual(offset,44)" in plan
    assert read.count() == 2


def test_places_are_listed_without_a_group_for_each_frame(monkeypatch):
    rows = pd.DataFrame({"key_0": ["b", "a", "b"], "key_1": [1, 2, 1], "chunk_index": [0, 0, 1], "segment_id": [3, 3, 4], "offset": [7, 8, 9]})
    monkeypatch.setattr(pd.DataFrame, "groupby", None)
    found = positions._listed(rows, ["key_0", "key_1"])
    assert found == {("b", 1): [{"chunk_index": 0, "segment_id": 3, "offset": 7}, {"chunk_index": 1, "segment_id": 4, "offset": 9}],
                     ("a", 2): [{"chunk_index": 0, "segment_id": 3, "offset": 8}]}
