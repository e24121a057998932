"""One file per event, holding the event's own bytes.

A folder has ``data/<attempt>`` folders, each written by one attempt of a task with many files in it, and a manifest,
a transactional table of the attempts that count. Files of failed or repeated attempts have no entry, so they are
never read; the files of one ``write`` appear together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorloom.sources.transactions import TransactionalTable
from sensorloom.workspace import LARGE_ROW_CONF, configure

# A row for each folder, and one for each empty file, which Spark's reader passes over.
_MANIFEST = "folder string, empty_file string, n_files bigint, n_bytes bigint"
_CONTENT = "name string, data binary"


def _manifest(spark: SparkSession, path: str) -> TransactionalTable:
    return TransactionalTable(spark, f"{path.rstrip('/')}/manifest", _MANIFEST)


def _uri(spark: SparkSession, path: str) -> str:
    """The path with its file system, which tasks open with pyarrow."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toString().removeprefix("file:")


def write(df: DataFrame, path: str, name: Column, data: str = "data", transaction: str | None = None) -> None:
    """A file for each row, called ``name``, with the bytes of ``data`` (null: an empty file).

    Names must be plain (no separator, not empty, no leading dot or underscore) and different from each other: a task
    that meets a bad or repeated name fails, and nothing of the write is seen. Rows with equal names are in one task.
    A job that may run again names its ``transaction``: written once, it stays as it is. The number of files is
    what takes time, so the partitions are given by number: adaptive execution would join them by size.
    """
    spark = configure(df.sparkSession, LARGE_ROW_CONF)
    root = f"{_uri(spark, path).rstrip('/')}/data"

    def entries(*columns: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                                          names=["folder", "empty_file", "n_files", "n_bytes"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(root)
        attempt, seen, n_bytes = uuid.uuid4().hex, set(), 0
        for batch in batches:
            empty = []
            for called, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not called or "/" in called or called[0] in "._":
                    raise ValueError(f"not a file name: {called!r}")
                if called in seen:
                    raise ValueError(f"two rows for the file {called!r}")
                if not seen:
                    files.create_dir(f"{base}/{attempt}", recursive=True)
                seen.add(called)
                content = value.as_py() or b""
                with files.open_output_stream(f"{base}/{attempt}/{called}") as out:
                    out.write(content)
                n_bytes += len(content)
                if not content:
                    empty.append(called)
            if empty:
                yield entries([attempt] * len(empty), empty, [None] * len(empty), [None] * len(empty))
        if seen:
            yield entries([attempt], [None], [len(seen)], [n_bytes])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = df.select(name.cast("string").alias("name"), F.col(data).cast("binary").alias("data")).repartition(tasks, "name")
    with _manifest(spark, path).begin(transaction) as writing:
        writing.write(named.mapInArrow(put, _MANIFEST))


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold committed files: one for each task that wrote any, not one for each file."""
    found = _manifest(spark, path).read().where("empty_file is null").select("folder").collect()
    return sorted(row["folder"] for row in found)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(name, data) of the committed files. The same name from two writes gives two rows."""
    found = folders(spark, path)
    if not found:
        return spark.createDataFrame([], StructType.fromDDL(_CONTENT))
    files = spark.read.format("binaryFile").load([f"{path.rstrip('/')}/data/{folder}" for folder in found])
    empty = _manifest(spark, path).read().where("empty_file is not null").select(
        F.col("empty_file").alias("name"), F.lit(b"").alias("data"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("content").alias("data")).union(empty)


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of attempts that no entry names. Only while nothing is being written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/data")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    known = set(folders(spark, path))
    gone = [status.getPath() for status in files.listStatus(folder) if status.getPath().getName() not in known]
    for attempt in gone:
        files.delete(attempt, True)
    return sorted(attempt.getName() for attempt in gone)
