"""Arrow UDFs, for work on raw pixel bytes that has no built-in expression, and for SQL registration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructType

from sensorloom.functions import resample


@pandas_udf(DoubleType())
def mean_score_bytes(data: pd.Series) -> pd.Series:
    """Mean byte over 255 of each raw frame; null for a null or empty one."""
    sizes = data.str.len().fillna(0).to_numpy(np.int64)
    filled = sizes > 0
    scores = np.full(len(data), np.nan)
    if filled.any():
        values = np.frombuffer(b"".join(data[filled]), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        scores[filled] = np.add.reduceat(values, starts, dtype=np.int64) / sizes[filled] / 255
    return pd.Series(scores)


@pandas_udf(DoubleType())
def pandas_sum(values: pd.Series) -> float:
    """Grouped aggregate, one Python call per group of bounded size."""
    return float(values.sum())


@pandas_udf(DoubleType())
def pandas_mean(values: pd.Series) -> float:
    """Grouped or window aggregate over groups of bounded size."""
    return float(values.mean())


def resize_bytes(width: int, height: int, out_width: int, out_height: int, channels: int = 1) -> Callable:
    """A UDF that resizes raw frames of one size to any other; the same result as ``block_mean``."""
    resample.axis_weights(width, out_width), resample.axis_weights(height, out_height)

    @pandas_udf(BinaryType())
    def resize(data: pd.Series) -> pd.Series:
        present = data.notna()
        if not present.any():
            return data
        small = resample.area_means(resample.of_bytes(list(data[present]), height, width, channels), out_height, out_width)
        return _placed(present, [row.tobytes() for row in small.astype(np.uint8)])

    return resize


def resize_area(out_width: int, out_height: int, channels: int = 1) -> Callable:
    """A UDF of (data, width, height) that resizes raw frames of many sizes; NULL where any of the three is."""
    resample.axis_weights(out_width, out_width), resample.axis_weights(out_height, out_height)

    @pandas_udf(BinaryType())
    def resize(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(data), dtype=object)
        sizes = pd.DataFrame({"width": width, "height": height})[data.notna()].dropna().astype(np.int64)
        for (w, h), rows in sizes.groupby(["width", "height"]).groups.items():
            small = resample.area_means(resample.of_bytes(list(data[rows]), int(h), int(w), channels), out_height, out_width)
            for row, raw in zip(rows, small.astype(np.uint8), strict=True):
                found[row] = raw.tobytes()
        return found

    return resize


def _placed(present: pd.Series, values: list) -> pd.Series:
    """The values at the places that are present, None elsewhere."""
    rest = iter(values)
    return pd.Series([next(rest) if there else None for there in present], dtype=object)


def block_mean(width: int, height: int, out_width: int, out_height: int, channels: int = 1) -> Callable:
    """A UDF that resizes frames given as arrays of pixel values; the same result as ``resize_bytes``."""
    resample.axis_weights(width, out_width), resample.axis_weights(height, out_height)

    @pandas_udf(ArrayType(IntegerType()))
    def resize(pixels: pd.Series) -> pd.Series:
        present = pixels.notna()
        if not present.any():
            return pixels
        frames = np.concatenate(list(pixels[present])).reshape(-1, height, width, channels)
        small = resample.area_means(frames, out_height, out_width)
        return _placed(present, list(small.reshape(int(present.sum()), -1).astype(np.int32)))

    return resize


@udtf(returnType=StructType().add("chunk_index", IntegerType()).add("final_chunk_index", IntegerType())
      .add("data", BinaryType()))
class SplitPayload:
    """``SELECT * FROM split_payload(data, size)``; jobs use ``operators.chunks.split``."""

    def eval(self, data: bytes, size: int):
        if data is None:
            return
        last = max(len(data) - 1, 0) // size
        for index in range(last + 1):
            yield index, last, data[index * size:(index + 1) * size]


def register(spark: SparkSession) -> None:
    """Make the functions callable by name in SQL."""
    spark.udf.register("mean_score_bytes", mean_score_bytes)
    spark.udf.register("pandas_sum", pandas_sum)
    spark.udf.register("pandas_mean", pandas_mean)
    spark.udtf.register("split_payload", SplitPayload)
