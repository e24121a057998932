"""Event-time operators on readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.times import floor_div


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                  seconds: int) -> DataFrame:
    """Pairs with equal keys and ``right_ts <= left_ts < right_ts + seconds``.

    Both sides are cut into time buckets as wide as the interval, and a right row stands in its own and in
    the next one. A hot key is then spread over its buckets, and only rows close in time are compared.
    Columns other than the keys must have different names.
    """
    width = seconds * 1_000_000
    bucket = floor_div(_micros(right_ts), width)
    near = right.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1)))
    base = left.withColumn("_bucket", floor_div(_micros(left_ts), width))
    age = _micros(left_ts) - _micros(right_ts)
    return base.join(near, [*keys, "_bucket"]).filter((age >= 0) & (age < width)).drop("_bucket")


def stream_interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                         seconds: int, delay: str = "60 seconds") -> DataFrame:
    """The same on streams: watermarks on both sides, so that Spark can drop state, and time buckets.

    Every row is a row of state, so that the buckets are twice as wide as the interval, and only a right row of a
    bucket's second half stands in the next one too.
    """
    width = 2 * seconds * 1_000_000
    first, last = floor_div(_micros(right_ts), width), floor_div(_micros(right_ts) + (seconds * 1_000_000 - 1), width)
    a = left.withWatermark(left_ts, delay).withColumn("_bucket", floor_div(_micros(left_ts), width)).alias("a")
    b = right.withWatermark(right_ts, delay).withColumn("_bucket", F.explode(F.sequence(first, last))).alias("b")
    interval = F.expr(f"INTERVAL {seconds} SECONDS")
    on = (
        (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a._bucket") == F.col("b._bucket"))
        & (F.col(f"a.{left_ts}") >= F.col(f"b.{right_ts}"))
        & (F.col(f"a.{left_ts}") < F.col(f"b.{right_ts}") + interval)
    )
    return a.join(b, on).drop(F.col(f"b.{key}")).drop("_bucket")


def sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int) -> DataFrame:
    """Sessions per key: a new one starts when more than the gap has passed. Ends at last event + gap.

    Events of one key in the same gap-wide time slot always share a session, so they are aggregated first,
    on the map side. The window then sees one row per slot, however many events a key has.
    """
    gap = gap_seconds * 1_000_000
    slots = df.groupBy(*keys, floor_div(_micros(ts), gap).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    order = Window.partitionBy(*keys).orderBy("_slot")
    apart = _micros("_first") - F.lag(_micros("_last")).over(order) > gap
    numbered = slots.withColumn("_start", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "_session", F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias("session_start"),
        (F.max("_last") + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("session_end"),
        F.sum("_n").alias("n_events"),
    ).drop("_session")


def stream_sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int, delay: str) -> DataFrame:
    """``sessions`` on a stream that takes rows up to ``delay`` late, or as a batch.

    Start and end are aggregates, not fields of the window: Spark takes the window for a grouping key, and moves a
    filter on its fields to the events, before they are merged, where it would cut the beginning off a session.
    """
    session = F.session_window(ts, f"{gap_seconds} seconds")
    counted = df.withWatermark(ts, delay).groupBy(*keys, session).agg(
        F.min(ts).alias("session_start"),
        (F.max(ts) + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("session_end"),
        F.count(F.lit(1)).alias("n_events"),
    )
    return counted.select(*keys, "session_start", "session_end", "n_events")


def stamp_arrival(df: DataFrame, name: str = "arrival") -> DataFrame:
    """Add the time of arrival, to be written with the events.

    On a stream it is the time of the micro-batch, and the file sink takes a batch once: what is read from its table
    has one arrival, however often it is read.
    """
    if name in df.columns:
        raise ValueError(f"events have a column {name} already")
    return df.withColumn(name, F.current_timestamp())


def stream_arrival_sessions(df: DataFrame, keys: list[str], gap_seconds: int, arrival: str = "arrival") -> DataFrame:
    """Sessions by stored arrivals, on a stream of the table in which they stand; ``sessions`` is the batch form.

    Arrivals do not fall from one micro-batch to the next, so nothing is late and a session closes as soon as the
    greatest arrival seen is past its end. ``streaming.state.sessions_by_clock`` closes them without further events.
    """
    return stream_sessions(df, keys, arrival, gap_seconds, "0 seconds")


def window_counts(df: DataFrame, keys: list[str], ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Events per key and tumbling or sliding window. Works on a stream that has a watermark."""
    counted = df.groupBy(*keys, F.window(ts, size, slide)).agg(F.count(F.lit(1)).alias("n_events"))
    return counted.select(*keys, F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), "n_events")


def pane_counts(df: DataFrame, keys: list[str], ts: str, size_seconds: int, slide_seconds: int) -> DataFrame:
    """As ``window_counts`` for sliding windows, from one partial count per key and pane as long as the slide.

    No row is copied for the windows that hold it. A pane adds its count at its first window and takes it away
    behind its last one; between two such changes all windows of a key have the running sum. A key's task
    gets two small rows a pane. Rows without a time are in no window.
    """
    panes_of_window, rest = divmod(size_seconds, slide_seconds)
    if rest or panes_of_window < 1:
        raise ValueError("the window must be a multiple of its slide")
    slide = slide_seconds * 1_000_000
    panes = df.filter(F.col(ts).isNotNull()).groupBy(*keys, floor_div(_micros(ts), slide).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_n"))
    changes = panes.select(*keys, F.inline(F.array(
        F.struct((F.col("_pane") - panes_of_window + 1).alias("_at"), F.col("_n").alias("_change")),
        F.struct((F.col("_pane") + 1).alias("_at"), (-F.col("_n")).alias("_change")))))
    order = Window.partitionBy(*keys).orderBy("_at")
    summed = changes.withColumns({
        "n_events": F.sum("_change").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.lead("_at").over(order),
    })
    spans = summed.filter((F.col("n_events") > 0) & (F.col("_next") > F.col("_at")))
    windows = spans.withColumn("_window", F.explode(F.sequence(F.col("_at"), F.col("_next") - 1)))
    return windows.select(*keys, F.timestamp_micros(F.col("_window") * slide).alias("window_start"),
                          F.timestamp_micros((F.col("_window") + panes_of_window) * slide).alias("window_end"), "n_events")


def stream_pane_counts(df: DataFrame, keys: list[str], ts: str, size: str, slide: str, delay: str) -> DataFrame:
    """The same on a stream: a first aggregate over panes, and a second over windows of panes."""
    panes = df.withWatermark(ts, delay).groupBy(*keys, F.window(ts, slide).alias("pane")).agg(F.count(F.lit(1)).alias("_n"))
    counted = panes.groupBy(*keys, F.window("pane", size, slide)).agg(F.sum("_n").alias("n_events"))
    return counted.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_events")


def window_mean(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Add the mean of ``value`` over all rows with the same keys, to each row.

    A window over whole partitions would gather each key in one task; the means are aggregated map-side and
    joined back, where Spark splits the partition of a hot key.
    """
    means = df.groupBy(*[F.col(k).alias(f"_mean_{k}") for k in keys]).agg(F.avg(value).alias(name))
    return df.join(means, [F.col(k).eqNullSafe(F.col(f"_mean_{k}")) for k in keys], "left").select(*df.columns, name)


def ratio_estimate(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """Four times the share of points of the unit square that lie in the quarter circle."""
    inside = (x * x + y * y <= 1).cast("int")
    return points.agg(F.count(F.lit(1)).alias("n_points"), F.sum(inside).alias("n_inside"),
                      (F.avg(inside) * 4).alias("estimate"))
