import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.functions import udfs
from sensorloom.operators import events as ev
from sensorloom.operators import ordering

START = 1704067200


def at(spark, rows):
    """(device, seconds) rows as readings."""
    frame = spark.createDataFrame([(d, s, i) for i, (d, s) in enumerate(rows)], "d int, s long, i int")
    return frame.select("d", "i", F.timestamp_seconds(F.col("s") + START).alias("ts"))


def session_rows(df):
    return sorted(tuple(r) for r in df.select("d", "session_start", "session_end", "n_events").collect())


@pytest.mark.parametrize("gap", [1, 7, 60])
def test_sessions_equal_session_window(spark, gap):
    rng = random.Random(gap)
    # A third of the readings are from one device, many of them at the same time.
    rows = at(spark, [(0 if i % 3 == 0 else rng.randrange(1, 6), rng.randrange(0, 800)) for i in range(900)])
    built_in = rows.groupBy("d", F.session_window("ts", f"{gap} seconds").alias("w")).agg(
        F.count("*").alias("n_events")).select("d", F.col("w.start").alias("session_start"),
                                               F.col("w.end").alias("session_end"), "n_events")
    assert session_rows(ev.sessions(rows, ["d"], "ts", gap)) == session_rows(built_in)


def test_session_ends_only_after_the_gap(spark):
    rows = at(spark, [(1, 0), (1, 10), (1, 21)])
    found = session_rows(ev.sessions(rows, ["d"], "ts", 10))
    assert [(r[1].second, r[2].second, r[3]) for r in found] == [(0, 20, 2), (21, 31, 1)]


def test_interval_join_equals_plain_join(spark):
    rng = random.Random(2)
    rows = at(spark, [(0 if i % 3 == 0 else rng.randrange(1, 5), rng.randrange(0, 300)) for i in range(300)])
    left = rows.select("d", F.col("ts").alias("t1"), F.col("i").alias("i1"))
    right = rows.select("d", F.col("ts").alias("t2"), F.col("i").alias("i2"))
    mine = ev.interval_join(left, right, ["d"], "t1", "t2", 2)
    plain = left.join(right, "d").filter("t1 >= t2 AND t1 < t2 + INTERVAL 2 SECONDS")
    pairs = [sorted((r["d"], r["i1"], r["i2"]) for r in df.collect()) for df in (mine, plain)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 300


def test_interval_is_half_open(spark):
    left = at(spark, [(1, 10)]).select("d", F.col("ts").alias("t1"))
    right = at(spark, [(1, 8), (1, 9), (1, 10), (1, 11), (2, 10)]).select("d", F.col("ts").alias("t2"))
    found = ev.interval_join(left, right, ["d"], "t1", "t2", 2)
    assert sorted(r["t2"].second for r in found.collect()) == [9, 10]


VALUES = [(7, -4.0), (7, 12.5), (7, 0.5), (8, 31.0), (9, 2.25), (9, 2.75)]
MEANS = {7: 3.0, 8: 31.0, 9: 2.5, None: 4.0}


def test_window_mean(spark):
    frame = spark.createDataFrame(VALUES, "id int, v double")
    expected = sorted((i, v, MEANS[i]) for i, v in VALUES)
    with_null = spark.createDataFrame([*VALUES, (None, 3.0), (None, 5.0)], "id int, v double")
    found = [tuple(r) for r in ev.window_mean(with_null, ["id"], "v", "mean_v").collect()]
    assert sorted(found, key=repr) == sorted([*expected, (None, 3.0, 4.0), (None, 5.0, 4.0)], key=repr)
    # The Pandas aggregate over a whole window, as a user may write it for small groups.
    whole = Window.partitionBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    with_udf = frame.withColumn("mean_v", udfs.pandas_mean("v").over(whole))
    assert sorted(tuple(r) for r in with_udf.collect()) == expected


def test_ratio_of_random_points(spark):
    points = spark.range(200_000).select(F.rand(1).alias("x"), F.rand(2).alias("y"))
    row = ev.ratio_estimate(points, F.col("x"), F.col("y")).first()
    assert row["n_points"] == 200_000 and abs(row["estimate"] - 3.1416) < 0.02


def test_hot_key_sum_in_blocks(spark):
    frame = spark.range(10_000).select((F.col("id") % 3).alias("k"), "id", (F.col("id") * 0.5).alias("v"))
    parts = frame.groupBy("k", ordering.offset_block(F.col("id"), 8).alias("b")).agg(udfs.pandas_sum("v").alias("p"))
    got = {r["k"]: r["s"] for r in parts.groupBy("k").agg(F.sum("p").alias("s")).collect()}
    assert got == {r["k"]: r["s"] for r in frame.groupBy("k").agg(F.sum("v").alias("s")).collect()}


@pytest.mark.parametrize("size, slide", [(60, 60), (60, 20), (7, 1), (300, 10)])
def test_panes_equal_sliding_windows(spark, size, slide):
    rng = random.Random(size)
    rows = at(spark, [(0 if i % 3 == 0 else rng.randrange(1, 6), rng.randrange(-200, 2000)) for i in range(600)] + [(9, 5), (9, 1900)])
    rows = rows.unionByName(rows.limit(5).withColumn("d", F.lit(None).cast("int")))
    want = ev.window_counts(rows, ["d"], "ts", f"{size} seconds", f"{slide} seconds").collect()
    undated = rows.limit(3).withColumn("ts", F.lit(None).cast("timestamp"))
    got = ev.pane_counts(rows.unionByName(undated), ["d"], "ts", size, slide).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want))) and len(got) > 100
    with pytest.raises(ValueError):
        ev.pane_counts(rows, ["d"], "ts", size + 1, size)


def test_panes_shuffle_two_rows_each(spark):
    rows = at(spark, [(i % 2, i) for i in range(1000)])
    counted = ev.pane_counts(rows, ["d"], "ts", 600, 1)
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") >= 2  # the changes of a pane, and the windows at the very end
    assert plan.index("Generate explode") < plan.index("Window [")
