import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one key."""
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 20), i, rng.randrange(5), rng.random() < 0.1) for i in range(3000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, offset long, v int, commit boolean").cache()


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("bits", [3, 7, 20])
def test_position_equals_window(skewed, bits):
    block = [ordering.offset_block(F.col("offset"), bits)]
    mine = ordering.position(skewed, ["k"], ["offset"], block, "p")
    plain = skewed.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("offset")))
    assert rows_of(mine, "k", "offset", "p") == rows_of(plain, "k", "offset", "p")
    assert mine.columns == [*skewed.columns, "p"]


def test_row_number_on_sampled_ranges(skewed, many_partitions):
    mine = ordering.row_number(skewed, ["k"], ["v", "offset"], "p")
    plain = skewed.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("v", "offset")))
    assert rows_of(mine, "k", "offset", "p") == rows_of(plain, "k", "offset", "p")


def test_sampled_ranges_split_a_hot_key(skewed, many_partitions):
    parts = ordering.with_range_part(skewed, ["k", "v", "offset"])
    sizes = parts.groupBy("_part").count().collect()
    assert len(sizes) > 4
    assert max(r["count"] for r in sizes) < skewed.count() / 3


def test_prefix_sum_and_total(skewed):
    block = [ordering.offset_block(F.col("offset"), 4)]
    mine = ordering.prefix_sum(skewed, ["k"], ["offset"], block, F.col("v"), "s", total="t")
    run = Window.partitionBy("k").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = skewed.withColumns({"s": F.sum("v").over(run), "t": F.sum("v").over(Window.partitionBy("k"))})
    assert rows_of(mine, "k", "offset", "s", "t") == rows_of(plain, "k", "offset", "s", "t")


def test_commit_groups(spark):
    flags = {"a": [0, 1, 0, 0, 1, 0, 0], "b": [0, 0], "c": [1, 1]}
    rows = [(w, i, bool(f)) for w, fs in flags.items() for i, f in enumerate(fs)]
    events = spark.createDataFrame(rows, "w string, offset long, commit boolean")
    block = [ordering.offset_block(F.col("offset"), 1)]
    aborted = ordering.commit_groups(events, ["w"], ["offset"], block, F.col("commit"))
    assert rows_of(aborted, "w", "offset", "txn") == [
        ("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("a", 4, 1), ("c", 0, 0), ("c", 1, 1)]
    kept = ordering.commit_groups(events, ["w"], ["offset"], block, F.col("commit"), at_end="commit")
    assert rows_of(kept, "w", "offset", "txn") == rows_of(aborted, "w", "offset", "txn")[:5] + [
        ("a", 5, 2), ("a", 6, 2), ("b", 0, 0), ("b", 1, 0), ("c", 0, 0), ("c", 1, 1)]
    with pytest.raises(ValueError):
        ordering.commit_groups(events, ["w"], ["offset"], block, F.col("commit"), at_end="other")


def test_ordered_vectors_are_bounded_and_whole(skewed):
    block = [ordering.offset_block(F.col("offset"), 5)]
    vectors = ordering.ordered_vectors(skewed, ["k"], ["offset"], block, "v", length=64)
    whole = {}
    for row in vectors.orderBy("k", "part").collect():
        assert len(row["vector"]) <= 64
        whole.setdefault(row["k"], []).extend(row["vector"])
    expected = {}
    for row in skewed.orderBy("offset").collect():
        expected.setdefault(row["k"], []).append(float(row["v"]))
    assert whole == expected
