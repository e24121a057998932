"""A log in segments that grows by transactions, and a streaming source whose offsets are positions in it.

``SegmentLog`` writes the files of a transaction in folders by segment and in offset order, and its commit entry
says which offsets of each segment the transaction holds. The source ``segment_log`` starts at the earliest event, at
the tail or at given cuts. It opens no file of transactions that lie ahead of its start, and reads no row
group of files that do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from sensorloom.sources.transactions import TransactionalTable, collect

NAME = "segment_log"


def _required(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"an event without {name}"))).cast("bigint").alias(name)


class SegmentLog(TransactionalTable):
    """A log (segment_id, offset, any others). Offsets of a segment grow from one transaction to the next."""

    def _stage(self, rows: DataFrame, folder: str) -> None:
        others = [c for c in rows.columns if c not in ("segment_id", "offset")]
        checked = rows.select(_required("segment_id"), _required("offset"), *others)
        ordered = checked.repartitionByRange("segment_id", "offset").sortWithinPartitions("segment_id", "offset")
        ordered.write.mode("append").partitionBy("segment_id").parquet(folder)

    def _note(self, transaction: str) -> dict:
        staged = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{transaction}")
        found = staged.groupBy("segment_id").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
        return {"ranges": {str(r["segment_id"]): [r["low"], r["high"]] for r in found}}

    def tails(self) -> dict[int, int]:
        """One past the last committed offset of each segment, from the commit entries alone."""
        return _tails(self._state()[1])


def _tails(notes: dict[str, dict]) -> dict[int, int]:
    tails: dict[int, int] = {}
    for note in notes.values():
        for segment, (_, high) in note["ranges"].items():
            tails[int(segment)] = max(tails.get(int(segment), 0), high + 1)
    return tails


@dataclass
class Piece(InputPartition):
    """A file of one segment, and the offset from which its events are wanted."""

    path: str
    segment: int
    start: int | None


class PositionReader(DataSourceStreamReader):
    """Offsets name the last commit that was read, the cuts at which the query began, and the tails, to look at.

    A commit is read as a whole, so that its events come once, whatever their offsets. The cuts apply to all.
    """

    def __init__(self, schema: StructType, options: dict) -> None:
        self.names, self.start = schema.fieldNames(), options.get("start", "earliest")
        self.files, self.path = pafs.FileSystem.from_uri(options["path"])

    def _notes(self) -> tuple[int, dict[str, dict]]:
        listed = self.files.get_file_info(pafs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        numbers = sorted(int(f.base_name.removesuffix(".json")) for f in listed
                         if f.base_name.endswith(".json") and not f.base_name.startswith("."))

        def entry(number: int) -> dict:
            with self.files.open_input_stream(f"{self.path}/commits/{number:012d}.json") as stream:
                return json.loads(stream.read())

        return (numbers[-1] if numbers else -1), collect(numbers, entry)

    def initialOffset(self) -> dict:
        last, notes = self._notes()
        if self.start == "earliest":
            return {"commit": -1, "cuts": {}, "tails": {}}
        if self.start == "tail":
            return {"commit": last, "cuts": {}, "tails": _text_keys(_tails(notes))}
        cuts = {str(int(segment)): int(offset) for segment, offset in json.loads(self.start).items()}
        return {"commit": -1, "cuts": cuts, "tails": {}}

    def latestOffset(self) -> dict:
        last, notes = self._notes()
        return {"commit": last, "tails": _text_keys(_tails(notes))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        cuts = self._cuts(start)
        pieces = []
        for name, note in self._notes()[1].items():
            if start["commit"] < note["commit"] <= end["commit"]:
                for segment, (_, high) in note["ranges"].items():
                    cut = cuts.get(segment)
                    if cut is None or high >= cut:
                        listed = self.files.get_file_info(pafs.FileSelector(f"{self.path}/data/{name}/segment_id={segment}"))
                        pieces += [Piece(f.path, int(segment), cut) for f in listed if f.base_name.endswith(".parquet")]
        return pieces

    def _cuts(self, start: dict) -> dict[str, int]:
        if "cuts" in start:
            return start["cuts"]
        return {} if self.start in ("earliest", "tail") else {str(int(s)): int(o) for s, o in json.loads(self.start).items()}

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_file(partition.path) as file:
            parquet = pq.ParquetFile(file)
            place = parquet.schema_arrow.names.index("offset")
            groups = []
            for i in range(parquet.num_row_groups):
                known = parquet.metadata.row_group(i).column(place).statistics
                if partition.start is None or known is None or not known.has_min_max or known.max >= partition.start:
                    groups.append(i)
            stored = [name for name in self.names if name != "segment_id"]
            for batch in parquet.iter_batches(row_groups=groups, columns=list(dict.fromkeys([*stored, "offset"]))):
                if partition.start is not None:
                    batch = batch.filter(pc.greater_equal(batch.column("offset"), partition.start))
                segment = pa.array([partition.segment] * batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([segment if n == "segment_id" else batch.column(n) for n in self.names], names=self.names)


def _text_keys(tails: dict[int, int]) -> dict[str, int]:
    return {str(segment): tail for segment, tail in sorted(tails.items())}


class LogSource(DataSource):
    """``spark.readStream.format("segment_log").schema(...)`` with the options ``path`` and ``start``.

    ``start`` is ``earliest``, ``tail``, or a JSON object from segment to first offset; segments that it does not name
    are read from their start. A restarted query goes on where its checkpoint says.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> PositionReader:
        return PositionReader(schema, dict(self.options))


def stream(log: SegmentLog, start: str | dict[int, int] = "earliest", spark: SparkSession | None = None) -> DataFrame:
    """The committed events of the log as a stream, from ``earliest``, the ``tail`` as of now, or given cuts."""
    spark = spark or log.spark
    spark.dataSource.register(LogSource)
    text = start if isinstance(start, str) else json.dumps(_text_keys(start))
    return spark.readStream.format(NAME).schema(log.schema).option("path", log.path).option("start", text).load()
