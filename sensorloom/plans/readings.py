"""Event-time windows, interval join, sessions and features of readings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.functions import times, udfs
from sensorloom.operators import events as ev
from sensorloom.operators import ordering
from sensorloom.plans.tables import ARRIVALS_SQL, arrivals, LOG_SQL, SEGMENTS, plain, readings, scaled, scaled_sql, table

INTERVAL = 2 * 3600
GAP = 600
DAY, HOUR, MINUTE = 86_400, 3600, 60
FPS = 15
VECTOR_LENGTH = 256
LOW, HIGH, PERIOD_MILLIS, OFFSET_MILLIS = 20.0, 400.0, 86_400_000.0, 21_600_000.0


def interval_sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = rows.select("device_id", F.col("timestamp").alias("timestamp1"), F.col("event_id").alias("event_id1"))
    right = rows.select("device_id", F.col("timestamp").alias("timestamp2"), F.col("event_id").alias("event_id2"))
    return left, right


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = interval_sides(readings(table(spark, sf_dir, "events")))
    pairs = ev.interval_join(left, right, ["device_id"], "timestamp1", "timestamp2", INTERVAL)
    return pairs.select("device_id", "event_id1", "event_id2", plain("timestamp1"), plain("timestamp2"))


def discretize_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(table(spark, sf_dir, "events"))
    return rows.select("event_id", times.discretize(F.col("timestamp"), FPS).cast("timestamp_ntz").alias("slot_15"),
                       times.discretize(F.col("timestamp"), 2).cast("timestamp_ntz").alias("slot_2"))


def _buckets(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", times.value_bucket(F.col("temp_celsius"), 5))


def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _buckets(readings(table(spark, sf_dir, "events")))
    counted = ev.window_counts(rows, ["key"], "timestamp", "2 hours", "1 hour")
    return counted.select("key", plain("window_start"), plain("window_end"), "n_events")


def sliding_count_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a day that start every minute: 1,440 of them hold each event."""
    rows = readings(table(spark, sf_dir, "events"))
    counted = ev.pane_counts(rows, ["event_type"], "timestamp", DAY, MINUTE)
    return counted.select("event_type", plain("window_start"), plain("window_end"), "n_events")


def session_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.sessions(readings(table(spark, sf_dir, "events")), ["device_id"], "timestamp", GAP)
    return found.select("device_id", plain("session_start"), plain("session_end"), "n_events")


def arrival_session_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.sessions(arrivals(table(spark, sf_dir, "events")), ["device_id"], "arrival", GAP)
    return found.select("device_id", plain("session_start"), plain("session_end"), "n_events")


def _cents(vector: Column) -> Column:
    """A vector as text of hundredths."""
    return F.array_join(F.transform(vector, lambda v: F.round(v * 100).cast("bigint").cast("string")), ",")


def ordered_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of each device in log order, as vectors."""
    events = table(spark, sf_dir, "events").select(
        "user_id", (F.col("user_id") % SEGMENTS).alias("segment_id"), F.col("event_id").alias("offset"), "value"
    )
    block = [F.col("segment_id"), ordering.offset_block(F.col("offset"))]
    vectors = ordering.ordered_vectors(events, ["user_id"], ["segment_id", "offset"], block, "value", VECTOR_LENGTH)
    dense = vectors.withColumn("vector", array_to_vector("vector"))
    values = vector_to_array("vector")
    return dense.select("user_id", "part", F.size(values).alias("n_values"), _cents(values).alias("cents"))


def window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    means = ev.window_mean(rows, ["user_id"], "value", "mean_value")
    return means.select("event_id", "user_id", scaled(F.col("mean_value"), 4).alias("mean_e4"))


def frame_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return ordering.row_number(rows, ["user_id"], ["ts", "event_id"], "row_number").select(
        "user_id", "event_id", "row_number")


def sensor_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(table(spark, sf_dir, "events"))
    expected = times.sinusoid(F.unix_millis("timestamp"), LOW, HIGH, PERIOD_MILLIS, OFFSET_MILLIS)
    return rows.select("event_id", scaled(expected, 3).alias("expected_e3"),
                       scaled(F.col("temp_celsius") - expected, 3).alias("residual_e3"))


def agg_sum_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("sum_value"))


def agg_arrow_sum_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a grouped-aggregate Pandas UDF, for aggregates that only Python has: a key is one call."""
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(F.round(udfs.pandas_sum("value"), 2).alias("sum_value"))


def udf_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered functions called in SQL."""
    udfs.register(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("named_events")
    return spark.sql("SELECT event_type, round(pandas_sum(value), 2) AS sum_value FROM named_events GROUP BY event_type")


def window_mean_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean over a whole partition by a Pandas UDF, as a user may write it for small partitions."""
    whole = Window.partitionBy("user_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    means = table(spark, sf_dir, "events").withColumn("mean_value", udfs.pandas_mean("value").over(whole))
    return means.select("event_id", "user_id", scaled(F.col("mean_value"), 4).alias("mean_e4"))


def null_key_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row number, running total and mean per device, where some readings have no device."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("user_id") % 10, F.lit(3)).alias("device_id"), "value")
    block = [ordering.offset_block(F.col("event_id"), 4)]
    placed = ordering.position(rows, ["device_id"], ["event_id"], block, "row_number")
    summed = ordering.prefix_sum(placed, ["device_id"], ["event_id"], block, F.col("event_id"), "seen", total="all_ids")
    means = ev.window_mean(summed, ["device_id"], "value", "mean_value")
    return means.select("event_id", "device_id", "row_number", "seen", "all_ids", scaled(F.col("mean_value"), 4).alias("mean_e4"))


def ratio_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point of the unit square for each event, from the MD5 of its id."""
    digest = F.md5(F.col("event_id").cast("string").cast("binary"))
    points = table(spark, sf_dir, "events").select(digest.alias("d"))
    x, y = (F.conv(F.substring("d", start, 8), 16, 10).cast("double") / 2**32 for start in (1, 9))
    return ev.ratio_estimate(points, x, y).withColumn("estimate", F.round("estimate", 6))


QUERIES = {f.__name__: f for f in (
    interval_join, discretize_time, sliding_count, sliding_count_panes, session_count, arrival_session_count, ordered_vector, window_mean,
    frame_row_number, sensor_residual, agg_sum_per_key, agg_arrow_sum_per_key,
    udf_by_name, window_mean_pandas, null_key_numbers, ratio_estimate,
)}

SLIDING_SQL = """
    SELECT trunc(value / 5)::INT AS key, window_start, window_start + INTERVAL 2 HOUR AS window_end,
           count(*) AS n_events
    FROM (SELECT value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS window_start
          FROM events)
    GROUP BY ALL
"""
def panes_sql(slide: int) -> str:
    """Each pane as long as the slide in all windows of a day that hold it."""
    return f"""
    SELECT event_type, make_timestamp(w * {slide * 1_000_000}) AS window_start,
           make_timestamp(w * {slide * 1_000_000}) + INTERVAL 1 DAY AS window_end, sum(n)::BIGINT AS n_events
    FROM (SELECT event_type, n, unnest(range(p - {DAY // slide - 1}, p + 1)) AS w FROM (
        SELECT event_type, epoch_us(ts) // {slide * 1_000_000} AS p, count(*) AS n FROM events GROUP BY ALL))
    GROUP BY event_type, w"""


def _session_sql(events: str) -> str:
    return f"""
    SELECT user_id AS device_id, min(ts) AS session_start, max(ts) + INTERVAL {GAP} SECOND AS session_end,
           count(*) AS n_events
    FROM (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
          FROM (SELECT user_id, ts, event_id,
                       coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                + INTERVAL {GAP} SECOND, true)::INT AS opens FROM {events}))
    GROUP BY user_id, session
"""


SESSION_SQL = _session_sql("events")
ARRIVAL_SESSION_SQL = _session_sql(f"({ARRIVALS_SQL})")
INTERVAL_SQL = f"""
    SELECT a.user_id AS device_id, a.event_id AS event_id1, b.event_id AS event_id2,
           a.ts AS timestamp1, b.ts AS timestamp2
    FROM events a JOIN events b
      ON a.user_id = b.user_id AND a.ts >= b.ts AND a.ts < b.ts + INTERVAL {INTERVAL} SECOND
"""


def _slot_sql(fps: int) -> str:
    return f"make_timestamp((epoch_us(ts) * {fps} // 1000000) * 1000000 // {fps})"


_EXPECTED_SQL = f"""({HIGH} - {LOW})::DOUBLE * (0.5 * sin(2.0 * pi() * (epoch_us(ts) // 1000 - {OFFSET_MILLIS}::DOUBLE)
                 / {PERIOD_MILLIS}::DOUBLE) + 0.5) + {LOW}::DOUBLE"""

ORACLES = {
    "interval_join": INTERVAL_SQL,
    "discretize_time": f"SELECT event_id, {_slot_sql(FPS)} AS slot_15, {_slot_sql(2)} AS slot_2 FROM events",
    "sliding_count": SLIDING_SQL,
    "sliding_count_panes": panes_sql(MINUTE),
    "session_count": SESSION_SQL,
    "arrival_session_count": ARRIVAL_SESSION_SQL,
    "ordered_vector": f"""
        SELECT user_id, (p - 1) // {VECTOR_LENGTH} AS part, count(*)::INT AS n_values,
               string_agg(round(value * 100)::BIGINT::VARCHAR, ',' ORDER BY p) AS cents
        FROM (SELECT e.user_id, e.value, row_number() OVER (PARTITION BY e.user_id
                     ORDER BY l.segment_id, l."offset") AS p
              FROM events e JOIN ({LOG_SQL}) l ON l."offset" = e.event_id)
        GROUP BY ALL""",
    "window_mean": f"""
        SELECT event_id, user_id, {scaled_sql('mean', 4)} AS mean_e4
        FROM (SELECT event_id, user_id, avg(value) OVER (PARTITION BY user_id) AS mean FROM events)""",
    "frame_row_number": """
        SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_number
        FROM events""",
    "sensor_residual": f"""
        SELECT event_id, {scaled_sql(_EXPECTED_SQL, 3)} AS expected_e3,
               {scaled_sql(f'value - ({_EXPECTED_SQL})', 3)} AS residual_e3
        FROM events""",
    "agg_sum_per_key": "SELECT user_id, round(sum(value), 2) AS sum_value FROM events GROUP BY user_id",
    "agg_arrow_sum_per_key": "SELECT user_id, round(sum(value), 2) AS sum_value FROM events GROUP BY user_id",
    "udf_by_name": "SELECT event_type, round(sum(value), 2) AS sum_value FROM events GROUP BY event_type",
    "window_mean_pandas": f"""
        SELECT event_id, user_id, {scaled_sql('mean', 4)} AS mean_e4
        FROM (SELECT event_id, user_id, avg(value) OVER (PARTITION BY user_id) AS mean FROM events)""",
    "null_key_numbers": f"""
        SELECT event_id, device_id, row_number() OVER w AS row_number, sum(event_id) OVER w ::BIGINT AS seen,
               (sum(event_id) OVER (PARTITION BY device_id))::BIGINT AS all_ids,
               {scaled_sql('avg(value) OVER (PARTITION BY device_id)', 4)} AS mean_e4
        FROM (SELECT event_id, nullif(user_id % 10, 3) AS device_id, value FROM events)
        WINDOW w AS (PARTITION BY device_id ORDER BY event_id)""",
    "ratio_estimate": """
        WITH p AS (SELECT ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS x,
                          ('0x' || substr(md5(event_id::VARCHAR), 9, 8))::BIGINT / 4294967296.0::DOUBLE AS y
                   FROM events)
        SELECT count(*) AS n_points, sum((x * x + y * y <= 1)::INT)::BIGINT AS n_inside,
               round(avg((x * x + y * y <= 1)::INT) * 4, 6) AS estimate
        FROM p""",
}
