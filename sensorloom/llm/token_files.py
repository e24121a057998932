"""Token ids in Arrow files of fixed-size-list batches: equal-length sequences and masks, read by position."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.llm import tokens
from sensorloom.workspace import run_dir

END_ID = 2
SEQUENCE = 2048
ROWS = 64  # sequences of a batch: 512 KB of ids
FILE_TEXT_BYTES = 256 << 20

MANIFEST = "part int, file string, documents string, n_documents bigint, n_tokens bigint"


def _schema(length: int, vocabulary: int) -> pa.Schema:
    """Ids in the narrowest type that holds the vocabulary; masks of one bit for each id, set where it is no pad."""
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.uint8(), length // 8))])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if path[:5] != "file:" else path)


class _SequenceWriter:
    """Cuts a stream of ids into sequences and writes them in batches of ROWS; the last is filled up with pads."""

    def __init__(self, sink, length: int, vocabulary: int) -> None:
        self.length, self.schema = length, _schema(length, vocabulary)
        self.kind = self.schema.field("ids").type.value_type.to_pandas_dtype()
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.waiting = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.ids.append(ids.astype(self.kind))
        self.waiting += len(ids)
        if self.waiting >= self.length * ROWS:
            self._write(self.waiting // (self.length * ROWS) * self.length * ROWS)

    def _write(self, n: int) -> None:
        ids, width = np.concatenate(self.ids), self.length * ROWS
        self.ids, self.waiting = [ids[n:]], self.waiting - min(n, len(ids))
        for at in range(0, n, width):
            part = ids[at:min(at + width, n)]
            fill = -len(part) % self.length
            mask = np.packbits(np.concatenate([np.ones(len(part), np.uint8), np.zeros(fill, np.uint8)]), bitorder="little")
            part = np.concatenate([part, np.zeros(fill, self.kind)])
            self.writer.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(part), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length // 8)], schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._write(self.waiting)
        self.writer.close()


def write(documents: DataFrame, path: str, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all texts to Arrow files below ``path``; the manifest, one row for each file, in order.

    Documents stand in ascending doc_id order (null first, ties by text hash and text), each followed by
    ``end_id``; a null text is an empty one, which leaves the end id alone. A file holds a range of doc_ids as
    one stream of ids, cut into sequences of ``length`` (a multiple of 8) with masks that mark pads; beside it
    lies an Arrow file of (doc_id, start, n_tokens) with the documents' places in the stream. An empty table has
    no file. Tasks write under names of their own and only the names of those that ended are in the manifest,
    so a task that is run again leaves no trace in what is read. ``path`` must be one that pyarrow reaches too.
    """
    spark = documents.sparkSession
    ordered = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "tie", F.xxhash64("text"))
    total = ordered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(total // FILE_TEXT_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = ordered.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, stem = TaskContext.get().partitionId(), uuid.uuid4().hex
        system, folder = _place(path)
        system.create_dir(folder, recursive=True)
        writer, sink, ids, starts, sizes, at = None, None, [], [], [], 0
        for batch in batches:
            for doc_id, encoded in zip(batch.column("doc_id"), tokens.encode_column(batch.column("text"), tokenizer)):
                if writer is None:
                    sink = system.open_output_stream(f"{folder}/{part:06}-{stem}.arrow")
                    writer = _SequenceWriter(sink, length, tokens.encoder(tokenizer).tokenizer.get_vocab_size())
                stream = np.append(encoded, np.uint32(end_id))
                writer.add(stream)
                ids.append(doc_id.as_py())
                starts.append(at)
                sizes.append(len(stream))
                at += len(stream)
        if writer is not None:
            writer.close()
            sink.close()
            index = pa.table({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                              "n_tokens": pa.array(sizes, pa.int64())})
            with system.open_output_stream(f"{folder}/{part:06}-{stem}.docs.arrow") as out, \
                    pa.ipc.new_file(out, index.schema) as file:
                file.write_table(index)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "file": f"{path}/{part:06}-{stem}.arrow", "documents": f"{path}/{part:06}-{stem}.docs.arrow",
                "n_documents": len(ids), "n_tokens": at}], schema=pa.schema([
                    ("part", pa.int32()), ("file", pa.string()), ("documents", pa.string()),
                    ("n_documents", pa.int64()), ("n_tokens", pa.int64())]))

    ordered.mapInArrow(encode, MANIFEST).write.parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` with ``base``, the ids in all files before each."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Random access to one file: a sequence is a view of its batch, without a copy where the file is mapped."""

    def __init__(self, path: str) -> None:
        system, place = _place(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(place) if local else system.open_input_file(place))
        self.length = self.file.schema.field("ids").type.list_size

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return 0 if n == 0 else (n - 1) * ROWS + self.file.get_batch(n - 1).num_rows

    def _row(self, column: str, i: int, width: int) -> np.ndarray:
        values = self.file.get_batch(i // ROWS).column(column).flatten().to_numpy()
        return values[i % ROWS * width:(i % ROWS + 1) * width]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``; the mask has 8 ids to a byte, the first lowest."""
        return self._row("ids", i, self.length), self._row("mask", i, self.length // 8)

    def stream(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from position ``start`` of the file's stream, batch by batch."""
        per_batch = ROWS * self.length
        while n > 0:
            values = self.file.get_batch(start // per_batch).column("ids").flatten().to_numpy()
            piece = values[start % per_batch:start % per_batch + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, (system, place) = TokenFile(row["file"]), _place(row["documents"])
            with system.open_input_file(place) as source:
                for docs in map(pa.ipc.open_file(source).get_batch, range(pa.ipc.open_file(source).num_record_batches)):
                    starts, sizes, sums = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy(), []
                    for start, n in zip(starts, sizes, strict=True):
                        crc = 0
                        for piece in ids.stream(int(start), int(n)):
                            crc = zlib.crc32(piece.astype("<u4"), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), pa.array(starts + row["base"]), docs.column("n_tokens"),
                         pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for each document, from the files of a manifest; one task for each file."""
    return files.repartition(max(1, files.count()), "part").mapInArrow(
        _checked, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(documents: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    return read_documents(write(documents, path or run_dir(documents.sparkSession, "tokens"), tokenizer))
