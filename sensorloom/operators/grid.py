"""Many cameras to one grid frame per time window."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorloom.functions import frames as px
from sensorloom.operators.ordering import offset_block, position


def last_per_camera(frames: DataFrame, ts: str, window: str | Column, value: str = "data",
                    place: list[str] | None = None) -> DataFrame:
    """The last ``value`` of each camera in each ``window``, by (time, frame number, ssrc).

    A window is the length of tumbling windows, or a column such as the discretized time.

    Partial results merge, so that the map side sends one frame per camera and window. Works on a stream
    that has a watermark. For a table with large values name as ``place`` columns without NULL that tell all
    rows apart, such as segment and offset: the winners are chosen on narrow columns, and their values alone are
    fetched by place, so that no payload is sorted or takes part in an aggregate.
    """
    if place is not None:
        slot = F.window(ts, window) if isinstance(window, str) else window
        narrow = frames.select(slot.alias("window"), "camera", F.struct(
            ts, "frame_number", "ssrc", *[F.col(c).alias(f"_of_{c}") for c in place]).alias("_order"))
        won = narrow.groupBy("window", "camera").agg(F.max("_order").alias("_last"))
        won = won.select("window", F.col("camera").alias("_camera"), "_last.*").withColumnRenamed(ts, "last_ts")
        values = frames.select(*[F.col(c).alias(f"_at_{c}") for c in place], F.col(value).alias("_value"))
        found = won.join(values, [F.col(f"_of_{c}") == F.col(f"_at_{c}") for c in place])
        return found.select("window", F.col("_camera").alias("camera"), F.col("_value").alias(value), "frame_number", "last_ts")
    order = F.struct(ts, "frame_number", "ssrc")
    last = F.max_by(F.struct(F.col(value), F.col("frame_number"), F.col(ts).alias("last_ts")), order)
    slot = F.window(ts, window) if isinstance(window, str) else window.alias("window")
    grouped = frames.groupBy(slot, "camera").agg(last.alias("_last"))
    return grouped.select("window", "camera", F.col(f"_last.{value}").alias(value),
                          F.col("_last.frame_number").alias("frame_number"),
                          F.col("_last.last_ts").alias("last_ts"))


def grid_rows(last: DataFrame, value: str = "data") -> DataFrame:
    """One row per window: its time, the cameras' last values in camera order, and the grid size.

    ``last`` has one row per camera and window, so the list is as long as there are cameras.
    """
    tile = F.struct("camera", F.col(value).alias("value"))
    grouped = last.groupBy("window").agg(
        F.sort_array(F.collect_list(tile)).alias("tiles"),
        F.max("last_ts").alias("timestamp"),
        F.max("camera").alias("_max_camera"),
    )
    # Tiles are placed by camera number, so the grid must hold the greatest number, not just the count.
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "timestamp", F.size("tiles").alias("n_cameras"),
        px.grid_size(F.col("_max_camera") + 1).alias("grid_size"), "tiles",
    )


def cells(last: DataFrame, width: int, height: int) -> DataFrame:
    """Pixel position of each camera's tile in its window's grid."""
    sizes = last.groupBy("window").agg(px.grid_size(F.max("camera") + 1).alias("grid_size"))
    placed = last.join(sizes, "window")
    size = F.col("grid_size")
    return placed.withColumns({
        "x": px.cell_x(F.col("camera"), size, width),
        "y": px.cell_y(F.col("camera"), size, height),
    })


def sources(last: DataFrame, ts: Column) -> DataFrame:
    """Per window, the camera, frame number and time of each tile, as JSON."""
    item = F.struct("camera", "frame_number", ts.alias("timestamp"))
    listed = last.groupBy("window").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("source"))
    return listed.select(F.col("window.start").alias("window_start"), "source")


def compose(rows: DataFrame, width: int, height: int, background: int = 0, channels: int = 1) -> DataFrame:
    """Add the canvas bytes and size to ``grid_rows`` of raw tiles of the same size."""
    tiles = F.map_from_entries(F.transform("tiles", lambda t: F.struct(t["camera"], t["value"])))
    size = F.col("grid_size")
    return rows.withColumns({
        "canvas_width": px.canvas_side(size, width),
        "canvas_height": px.canvas_side(size, height),
        "data": px.compose(tiles, size, width, height, background, channels=channels),
    }).drop("tiles")


def compose_in_pandas(last: DataFrame, width: int, height: int, background: int = 0,
                      channels: int = 1) -> DataFrame:
    """The canvas per window with a grouped-map function; the same as ``compose``.

    A group is one window of ``last_per_camera``: one tile per camera.
    """
    schema = StructType([last.schema["window"], *StructType.fromDDL(
        "canvas_width int, canvas_height int, n_cameras int, data binary")])

    def paint(tiles: pd.DataFrame) -> pd.DataFrame:
        size = math.ceil(math.sqrt(tiles["camera"].max() + 1))
        down, across = ((size * (side + px.MARGIN) - px.MARGIN) for side in (height, width))
        canvas = np.full((down, across, channels), background, np.uint8)
        for camera, raw in zip(tiles["camera"], tiles["data"]):
            y, x = (camera // size) * (height + px.MARGIN), (camera % size) * (width + px.MARGIN)
            canvas[y:y + height, x:x + width] = np.frombuffer(raw, np.uint8).reshape(height, width, channels)
        return pd.DataFrame({"window": tiles["window"].iloc[:1], "canvas_width": across, "canvas_height": down,
                             "n_cameras": len(tiles), "data": [canvas.tobytes()]})

    return last.select("window", "camera", "data").groupBy("window").applyInPandas(paint, schema)


def number_frames(rows: DataFrame, micros_per_window: int, camera: str = "camera") -> DataFrame:
    """Add ``frame_number``: 0-based, one per non-empty window, in window order, per output camera."""
    index = F.floor(F.unix_micros(F.col("window_start").cast("timestamp")) / micros_per_window)
    numbered = position(rows, [camera], ["window_start"], [offset_block(index)], "_position")
    return numbered.withColumn("frame_number", F.col("_position") - 1).drop("_position")
