"""Area resampling of whole batches of frames, to any size."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SLICE_VALUES = 1 << 22  # of the frames that are resampled at a time


@lru_cache(maxsize=64)
def axis_weights(size: int, out_size: int) -> tuple[np.ndarray, np.ndarray]:
    """A sparse matrix along one axis: per output pixel its input pixels and the lengths that they share.

    Both are arrays of (out_size, most inputs of an output). Lengths are in units of 1/out_size of an input
    pixel, so that all are whole numbers and each row adds up to ``size``; rows with fewer inputs have zeros.
    """
    if size < 1 or out_size < 1:
        raise ValueError("sizes must be positive")
    out = np.arange(out_size, dtype=np.int64)[:, None]
    first = out * size // out_size
    across = int((((out + 1) * size - 1) // out_size - first).max()) + 1
    inputs = first + np.arange(across)
    shared = np.minimum((inputs + 1) * out_size, (out + 1) * size) - np.maximum(inputs * out_size, out * size)
    return np.minimum(inputs, size - 1), np.maximum(shared, 0)


def _along(values: np.ndarray, axis: int, out_size: int) -> np.ndarray:
    inputs, shared = axis_weights(values.shape[axis], out_size)
    shape = [1] * values.ndim
    shape[axis] = out_size
    total = np.zeros(values.shape[:axis] + (out_size,) + values.shape[axis + 1:], np.int64)
    for k in range(inputs.shape[1]):
        total += values.take(inputs[:, k], axis) * shared[:, k].reshape(shape)
    return total


def area_means(frames: np.ndarray, out_height: int, out_width: int) -> np.ndarray:
    """Mean of the area under each output pixel, rounded half up; ``frames`` is (n, height, width, channels).

    A pixel that an output covers in part counts in part. All sums are whole numbers, so nothing depends on
    the order of adding; enlarging works the same way.
    """
    n, height, width, channels = frames.shape
    out = np.empty((n, out_height, out_width, channels), np.int64)
    step = max(1, SLICE_VALUES // max(1, height * width * channels))
    area = height * width
    for i in range(0, n, step):
        total = _along(_along(frames[i:i + step], 1, out_height), 2, out_width)
        out[i:i + step] = (2 * total + area) // (2 * area)
    return out


def of_bytes(data: list[bytes], height: int, width: int, channels: int) -> np.ndarray:
    """Raw frames of one size as an array."""
    size = height * width * channels
    for raw in data:
        if len(raw) != size:
            raise ValueError(f"a frame of {len(raw)} bytes is not {width} x {height} with {channels} channels")
    return np.frombuffer(b"".join(data), np.uint8).reshape(-1, height, width, channels)
