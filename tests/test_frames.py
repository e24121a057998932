import datetime as dt
import math
import random
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import frames as px
from sensorloom.functions import resample, udfs
from sensorloom.operators import grid

START = dt.datetime(2024, 1, 1)


def raw_frames(spark, rows):
    """(camera, frame number, milliseconds, raw bytes)."""
    return spark.createDataFrame(
        [(c, n, c + 100, START + dt.timedelta(milliseconds=ms), bytearray(raw)) for c, n, ms, raw in rows],
        "camera int, frame_number int, ssrc int, timestamp timestamp, data binary")


def random_frame(rng, width, height, channels=1):
    return rng.integers(0, 256, width * height * channels, dtype=np.uint8)


@pytest.mark.parametrize("width,height,out_width,out_height,channels", [
    (8, 8, 4, 4, 1), (8, 4, 2, 2, 3), (6, 9, 2, 3, 1), (4, 4, 4, 4, 3), (10, 10, 1, 1, 1), (640, 480, 40, 40, 3)])
def test_block_mean(spark, width, height, out_width, out_height, channels):
    rng = np.random.default_rng(1)
    images = [random_frame(rng, width, height, channels) for _ in range(3)]
    frame = spark.createDataFrame([(i, [int(p) for p in image], bytearray(image.tobytes())) for i, image in enumerate(images)],
                                  "i int, pixels array<int>, data binary")
    rows = frame.select(
        "i", udfs.block_mean(width, height, out_width, out_height, channels)("pixels").alias("a"),
        udfs.resize_bytes(width, height, out_width, out_height, channels)("data").alias("b")).collect()
    for row in rows:
        blocks = images[row["i"]].reshape(out_height, height // out_height, out_width, width // out_width, channels)
        expected = np.floor(blocks.astype(float).mean(axis=(1, 3)) + 0.5).astype(int).ravel().tolist()
        assert row["a"] == expected == list(row["b"])


def overlaps(size, out_size):
    """The share of each input pixel in each output pixel, as exact fractions."""
    return [[max(Fraction(0), min(Fraction(i + 1), Fraction((o + 1) * size, out_size)) - max(Fraction(i), Fraction(o * size, out_size)))
             for i in range(size)] for o in range(out_size)]


@pytest.mark.parametrize("width,height,out_width,out_height,channels", [
    (8, 8, 5, 3, 1), (7, 5, 4, 4, 3), (3, 2, 7, 5, 1), (1, 1, 3, 3, 1), (9, 4, 1, 4, 2), (6, 6, 6, 5, 1)])
def test_area_means_as_fractions(width, height, out_width, out_height, channels):
    image = random_frame(np.random.default_rng(2), width, height, channels).reshape(height, width, channels)
    across, down = overlaps(width, out_width), overlaps(height, out_height)
    area = Fraction(width * height, out_width * out_height)
    want = [[[math.floor(sum(int(image[y, x, c]) * across[ox][x] * down[oy][y] for y in range(height) for x in range(width)) / area
                         + Fraction(1, 2)) for c in range(channels)] for ox in range(out_width)] for oy in range(out_height)]
    assert resample.area_means(image[None], out_height, out_width)[0].tolist() == want


def test_resize_to_sizes_of_the_camera_jobs(spark):
    """640 x 480 in colour to 100 x 100, 84 x 84 and 50 x 50, against dense matrices."""
    image = random_frame(np.random.default_rng(3), 640, 480, 3)
    frame = spark.createDataFrame([(bytearray(image.tobytes()),)] * 3, "data binary")
    for out in (100, 84, 50):
        across, down = (np.array(overlaps(n, out), float) for n in (640, 480))
        exact = np.einsum("oy,yxc,px->opc", down, image.reshape(480, 640, 3).astype(float), across) * out * out / (640 * 480)
        for row in frame.select(udfs.resize_bytes(640, 480, out, out, 3)("data").alias("b")).collect():
            got = np.frombuffer(bytes(row["b"]), np.uint8).reshape(out, out, 3)
            assert np.abs(got - exact).max() <= 0.5 + 1e-9


def test_resize_of_many_sizes(spark):
    rng = np.random.default_rng(4)
    sizes = [(8, 8), (5, 7), (8, 8), (1, 3), (20, 11)]
    images = [random_frame(rng, w, h) for w, h in sizes]
    rows = [(i, bytearray(image.tobytes()), w, h) for i, (image, (w, h)) in enumerate(zip(images, sizes))]
    rows += [(5, None, 8, 8), (6, bytearray(b"a"), None, 1), (7, bytearray(b"a"), 1, None)]
    frame = spark.createDataFrame(rows, "i int, data binary, width int, height int")
    found = {r["i"]: r["b"] for r in frame.select("i", udfs.resize_area(4, 3)("data", "width", "height").alias("b")).collect()}
    for i, (image, (w, h)) in enumerate(zip(images, sizes)):
        assert bytes(found[i]) == resample.area_means(image.reshape(1, h, w, 1), 3, 4).astype(np.uint8).tobytes()
    assert found[5] is found[6] is found[7] is None


def test_resize_of_a_frame_of_another_size(spark):
    frame = spark.createDataFrame([(bytearray(b"abc"),)], "data binary")
    with pytest.raises(Exception, match="a frame of 3 bytes is not 2 x 2"):
        frame.select(udfs.resize_bytes(2, 2, 1, 1)("data")).collect()
    with pytest.raises(ValueError):
        udfs.resize_area(0, 4)


def test_mean_score(spark):
    frame = spark.createDataFrame([([0, 255], bytearray([0, 255])), ([255] * 4, bytearray([255] * 4)), (None, None)],
                                  "pixels array<int>, data binary")
    rows = frame.select(px.mean_score(F.col("pixels")).alias("a"), udfs.mean_score_bytes("data").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(0.5, 0.5), (1.0, 1.0), (None, None)]


def test_udfs_of_null_frames(spark):
    frame = spark.createDataFrame([(None, None), ([1, 3], bytearray([1, 3])), (None, None)], "pixels array<int>, data binary")
    rows = frame.select(udfs.block_mean(2, 1, 1, 1)("pixels").alias("a"), udfs.resize_bytes(2, 1, 1, 1)("data").alias("b"))
    assert [tuple(r) for r in rows.collect()] == [(None, None), ([2], bytearray([2])), (None, None)]
    assert [tuple(r) for r in rows.limit(1).collect()] == [(None, None)]


def paint(tiles, size, width, height, channels, background):
    side_x, side_y = (width + 1) * size - 1, (height + 1) * size - 1
    canvas = np.full((side_y, side_x, channels), background, np.uint8)
    for camera, tile in tiles.items():
        x, y = camera % size * (width + 1), camera // size * (height + 1)
        canvas[y:y + height, x:x + width] = tile.reshape(height, width, channels)
    return canvas.tobytes()


@pytest.mark.parametrize("cameras", [[0], [0, 1, 2, 3], [0, 9], [2, 3, 7], list(range(10))])
@pytest.mark.parametrize("width,height,channels,background", [(3, 2, 1, 0), (2, 4, 3, 128)])
def test_compose(spark, cameras, width, height, channels, background):
    """Also for cameras {0, 9}, which do not fit a grid made for two, and tiles that are not square."""
    rng = np.random.default_rng(4)
    tiles = {c: random_frame(rng, width, height, channels) for c in cameras}
    frames = raw_frames(spark, [(c, 0, 100, t.tobytes()) for c, t in tiles.items()])
    last = grid.last_per_camera(frames, "timestamp", "500 milliseconds")
    size = math.ceil(math.sqrt(max(cameras) + 1))
    expected = paint(tiles, size, width, height, channels, background)
    row = grid.compose(grid.grid_rows(last), width, height, background, channels).first()
    assert (row["canvas_width"], row["canvas_height"]) == ((width + 1) * size - 1, (height + 1) * size - 1)
    assert bytes(row["data"]) == expected
    other = grid.compose_in_pandas(last, width, height, background, channels).first()
    assert bytes(other["data"]) == expected and other["canvas_height"] == row["canvas_height"]
    assert other["window"]["start"] == row["window_start"]


def test_last_image_of_each_camera(spark):
    rng = random.Random(9)
    rows = [(c, n, n * 130, bytes([c, n])) for c in range(4) for n in range(30)]
    # The same time twice: the later frame number counts.
    rows += [(0, 30, 29 * 130, b"last")]
    rng.shuffle(rows)
    last = grid.last_per_camera(raw_frames(spark, rows).repartition(6), "timestamp", "500 milliseconds")
    found = {(r["window"]["start"], r["camera"]): bytes(r["data"]) for r in last.collect()}
    expected = {}
    for c, n, ms, raw in sorted(rows, key=lambda r: (r[2], r[1])):
        expected[(START + dt.timedelta(milliseconds=ms // 500 * 500), c)] = raw
    assert found == expected
    windows = grid.grid_rows(last).orderBy("window_start").collect()
    assert [w["n_cameras"] for w in windows] == [4] * len(windows)
    assert [t["camera"] for t in windows[0]["tiles"]] == [0, 1, 2, 3]


def test_output_frames_are_numbered_in_window_order(spark):
    rows = [(c, n, ms, b"x") for c in range(2) for n, ms in enumerate([0, 400, 2600, 2700, 9000])]
    last = grid.last_per_camera(raw_frames(spark, rows), "timestamp", "500 milliseconds")
    grids = grid.grid_rows(last).select("window_start", F.lit(1000).alias("camera"))
    numbered = grid.number_frames(grids, 500_000).orderBy("window_start").collect()
    assert [(r["window_start"] - START).total_seconds() for r in numbered] == [0.0, 2.5, 9.0]
    assert [r["frame_number"] for r in numbered] == [0, 1, 2]


def png(width, height, colour_type):
    def block(kind, data):
        return struct.pack("!I", len(data)) + kind + data + struct.pack("!I", zlib.crc32(kind + data))
    header = struct.pack("!IIBBBBB", width, height, 8, colour_type, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + block(b"IHDR", header) + block(b"IDAT", zlib.compress(b"")) + block(b"IEND", b"")


def test_png_metadata(spark):
    images = [png(84, 50, 2), png(100, 100, 6), b"GIF89a something else that is no PNG"]
    frame = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(images)], "i int, data binary")
    found = frame.withColumns(px.png_metadata(F.col("data"))).orderBy("i").collect()
    assert [(r["width"], r["height"], r["components"]) for r in found] == [(84, 50, 3), (100, 100, 4), (None,) * 3]
    text = frame.withColumns(px.png_metadata(F.col("data"))).filter("i = 0").select(px.describe(
        F.lit(3), F.lit(7), F.col("width"), F.col("height"), F.col("components"), F.octet_length("data"))).first()[0]
    assert text == f"camera 3, frame 7, 84x50x3, {len(images[0])} bytes"
    made = spark.range(1).select(px.png_header(F.lit(84), F.lit(50), 2).alias("h")).first()["h"]
    assert bytes(made) == images[0][:26]


def test_functions_by_name(spark):
    udfs.register(spark)
    frame = spark.createDataFrame([(1, bytearray([0, 255])), (2, bytearray(b"abcdefg"))], "id int, data binary")
    frame.createOrReplaceTempView("raw_frames")
    score = spark.sql("SELECT mean_score_bytes(data) AS s FROM raw_frames WHERE id = 1").first()["s"]
    assert score == 0.5
    parts = spark.sql("SELECT id, c.* FROM raw_frames, LATERAL split_payload(data, 3) c WHERE id = 2").collect()
    assert [(r["chunk_index"], r["final_chunk_index"], bytes(r["data"])) for r in sorted(parts)] == [
        (0, 2, b"abc"), (1, 2, b"def"), (2, 2, b"g")]
    total = spark.sql("SELECT pandas_sum(CAST(id AS DOUBLE)) AS s, pandas_mean(CAST(id AS DOUBLE)) AS m FROM raw_frames")
    assert tuple(total.first()) == (3.0, 1.5)
