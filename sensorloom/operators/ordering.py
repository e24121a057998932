"""Row numbers and running totals along an order, without one task per key.

A plain window sends all rows of a key to one task. Here the order is cut into blocks of bounded size: each
block is numbered on its own, and the small table of block totals gives every block its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.workspace import materialize

BLOCK_BITS = 20
SPAN_BITS = 10  # blocks of a span, as a power of two


def offset_block(offset: Column, bits: int = BLOCK_BITS) -> Column:
    """Blocks of an integer order that has no duplicates: at most 2**bits rows each."""
    return F.shiftright(offset, bits)


def with_range_part(df: DataFrame, by: list[str]) -> DataFrame:
    """Add ``_part``, the number of the row's range along ``by``, for orders without a natural block.

    Spark samples the ranges so that they have about equal size. They are written to the shared folder, as
    another sampling could cut elsewhere.
    """
    return materialize(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))


def prefix_sum(df: DataFrame, keys: list[str], order: list[str], block: list[Column], value: Column,
               name: str, total: str | None = None) -> DataFrame:
    """Add the running total of ``value`` in each key along ``order``, and the key's total if named.

    ``block`` must grow with ``order``, its last column be an integer, and ``order`` have no ties. NULL is a
    key like any other. Blocks are added up in spans of 2**SPAN_BITS, and the spans in turn, so that one task
    gets a key's spans and not its blocks.
    """
    names = [f"_block_{i}" for i in range(len(block))]
    blocked = df.withColumns({**dict(zip(names, block)), "_value": value.cast("bigint")})
    group = [*keys, *names]
    span = [*keys, *names[:-1], "_span"]
    sums = (
        blocked.groupBy(*group).agg(F.sum("_value").alias("_sum"))
        .withColumn("_span", F.shiftright(F.col(names[-1]), SPAN_BITS))
    )
    before = Window.partitionBy(*keys).orderBy(*names[:-1], "_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sums.groupBy(*span).agg(F.sum("_sum").alias("_sum")).select(
        *[F.col(c).alias(f"_of_{c}") for c in span], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
        *([F.sum("_sum").over(Window.partitionBy(*keys)).alias(total)] if total else []))
    inside = Window.partitionBy(*span).orderBy(names[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = _null_safe(sums.withColumn("_start", F.coalesce(F.sum("_sum").over(inside), F.lit(0))), spans, span).select(
        *[F.col(c).alias(f"_of_{c}") for c in group], (F.col("_base") + F.col("_start")).alias("_start"), *([total] if total else []))
    rows = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        _null_safe(blocked.withColumn("_inside", F.sum("_value").over(rows)), starts, group)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .select(*df.columns, *([total] if total else []), name)
    )


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Join on columns that ``right`` has with the prefix ``_of_``; NULL equals NULL."""
    return left.join(right, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])


def position(df: DataFrame, keys: list[str], order: list[str], block: list[Column], name: str) -> DataFrame:
    """Add the 1-based row number in each key."""
    return prefix_sum(df, keys, order, block, F.lit(1), name)


def row_number(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """As ``position``, for any order without ties: the blocks are sampled ranges."""
    ranged = with_range_part(df, [*keys, *order])
    return position(ranged, keys, order, [F.col("_part")], name).drop("_part")


def commit_groups(events: DataFrame, writer: list[str], order: list[str], block: list[Column],
                  commit: Column, at_end: str = "abort") -> DataFrame:
    """Add ``txn``, the 0-based transaction of each event of a writer; ``commit`` marks a last event.

    Events after the last commit belong to an open transaction: ``abort`` drops them, as closing a writer
    does, and ``commit`` keeps them, as a stream that ends normally does.
    """
    marked = events.withColumn("_commit", F.coalesce(commit.cast("int"), F.lit(0)))
    summed = prefix_sum(marked, writer, order, block, F.col("_commit"), "_seen", total="_commits")
    txn = summed.withColumn("txn", F.col("_seen") - F.col("_commit"))
    if at_end == "abort":
        txn = txn.filter(F.col("txn") < F.col("_commits"))
    elif at_end != "commit":
        raise ValueError("at_end must be 'abort' or 'commit'")
    return txn.drop("_commit", "_seen", "_commits")


def ordered_vectors(df: DataFrame, keys: list[str], order: list[str], block: list[Column], value: str,
                    length: int = 4096) -> DataFrame:
    """The values of each key in order, as vectors of ``length`` values (the last may be shorter).

    ``part`` counts the vectors of a key from 0, so that a key of any size is never one row.
    """
    placed = position(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, block, "_pos")
    cut = placed.withColumn("part", F.floor((F.col("_pos") - 1) / length))
    pairs = F.sort_array(F.collect_list(F.struct("_pos", F.col(value).cast("double").alias("v"))))
    return cut.groupBy(*keys, "part").agg(F.transform(pairs, lambda p: p["v"]).alias("vector"))
