"""One file per event: committed folders, repeated and failed writes."""

import os

import pytest
from pyspark.sql import functions as F

from sensorloom.sources import event_files


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "name string, data binary")


def content(spark, path):
    return sorted((r["name"], bytes(r["data"])) for r in event_files.read(spark, path).collect())


def n_files(path):
    return sum(not name.startswith(".") for _, _, files in os.walk(f"{path}/data") for name in files)


def test_files_hold_the_bytes_of_their_events(spark, tmp_path):
    path = str(tmp_path / "files")
    assert content(spark, path) == []
    given = [("a 1%20+.png", b"\x00\xff"), ("empty", b""), ("none", None), ("long", b"x" * 3_000_000)]
    event_files.write(rows(spark, *given), path, F.col("name"))
    assert content(spark, path) == sorted((n, d or b"") for n, d in given)
    event_files.write(rows(spark, ("later", b"1")), path, F.col("name"))
    assert ("later", b"1") in content(spark, path) and len(content(spark, path)) == 5
    event_files.write(rows(spark, ("x", b"")).where("false"), path, F.col("name"))
    assert len(content(spark, path)) == 5


def test_many_files_in_few_folders(spark, tmp_path):
    path = str(tmp_path / "files")
    frames = spark.range(500).select(F.concat(F.lit("f-"), F.col("id").cast("string")).alias("name"),
                                     F.col("id").cast("string").cast("binary").alias("data"))
    event_files.write(frames, path, F.col("name"))
    assert len(event_files.folders(spark, path)) <= 8
    assert content(spark, path) == sorted((f"f-{i}", str(i).encode()) for i in range(500))


def test_a_repeated_job_writes_once(spark, tmp_path):
    path = str(tmp_path / "files")
    for _ in range(2):
        event_files.write(rows(spark, ("a", b"1"), ("b", b"2")), path, F.col("name"), transaction="job-1")
    assert content(spark, path) == [("a", b"1"), ("b", b"2")]


@pytest.mark.parametrize("bad", ["b", "", "a/b", ".hidden", "_hidden", None])
def test_a_failed_write_shows_nothing(spark, tmp_path, bad):
    path = str(tmp_path / "files")
    event_files.write(rows(spark, ("kept", b"0")), path, F.col("name"))
    with pytest.raises(Exception, match="file"):
        event_files.write(rows(spark, ("b", b"1"), (bad, b"2")), path, F.col("name"))
    assert content(spark, path) == [("kept", b"0")]
    event_files.sweep(spark, path)
    assert content(spark, path) == [("kept", b"0")] and n_files(path) == 1
