"""Run a stream over what its source holds, and read the result as a table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from sensorloom.sources import sinks
from sensorloom.workspace import run_dir


def to_table(df: DataFrame, name: str) -> DataFrame:
    """Process everything available with the exactly-once file sink; the result is in the shared folder."""
    base = run_dir(df.sparkSession, name)
    sinks.stream_to_table(df, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/table")


def to_finished_table(df: DataFrame, rest: Callable[[datetime], DataFrame], name: str) -> DataFrame:
    """``to_table`` for a stream of windows over a source that has an end.

    In append mode the windows that the last watermark has not passed are not in the sink. ``rest`` gives them,
    as a batch over the same source: it gets the watermark, and returns the windows that end after it. No row of
    theirs was ever late, so they are whole.
    """
    base = run_dir(df.sparkSession, name)
    query = sinks.stream_to_table(df, f"{base}/table", f"{base}/checkpoint")
    query.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {})]
    watermark = datetime.fromisoformat(max(marks)) if marks else datetime.fromtimestamp(0, timezone.utc)
    found = df.sparkSession.read.schema(df.schema).parquet(f"{base}/table")
    return found.unionByName(rest(watermark))


def to_batches(df: DataFrame, name: str, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same through ``foreachBatch``."""
    base = run_dir(df.sparkSession, name)
    sinks.stream_to_batches(df, f"{base}/table", f"{base}/checkpoint", prepare).awaitTermination()
    return df.sparkSession.read.parquet(f"{base}/table")
