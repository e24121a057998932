"""Grids of cameras, pixel operators and frame metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import codec, times, udfs
from sensorloom.functions import frames as px
from sensorloom.operators import grid
from sensorloom.plans.tables import FRAMES_SQL, TILE, pixel_frames, plain, readings, scaled, scaled_sql, table
from sensorloom.sources import event_files, sinks
from sensorloom.workspace import run_dir

WINDOW_MILLIS = 500
HALF = TILE // 2
HEAD_FRAMES = 20
ODD_WIDTH, ODD_HEIGHT = 5, 3
OUT_CAMERA = 1000  # fixed value: the number of the grid's own camera
GREY = 0
BACKGROUND = 128


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixel_frames(table(spark, sf_dir, "embeddings"))


def _last(spark: SparkSession, sf_dir: str, value: str = "pixels") -> DataFrame:
    return grid.last_per_camera(_frames(spark, sf_dir), "timestamp", f"{WINDOW_MILLIS} milliseconds", value,
                                place=["camera", "frame_number"])


def hex_text(pixels: Column) -> Column:
    return F.hex(px.to_bytes(pixels))


def grid_last_per_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grid.grid_rows(_last(spark, sf_dir), "pixels")
    images = F.transform("tiles", lambda t: F.concat_ws(":", t["camera"].cast("string"), hex_text(t["value"])))
    return rows.select(plain("window_start"), plain("timestamp"), "n_cameras", F.array_join(images, " ").alias("images"))


def table_tumble_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid as SQL over a named table: last reading of each device per 100 ms, marked with the window end."""
    readings(table(spark, sf_dir, "events")).createOrReplaceTempView("video")
    return spark.sql("""
        SELECT 0 AS camera, '' AS routing_key, CAST(w.end AS TIMESTAMP_NTZ) AS timestamp,
               count(*) AS n_images, CAST(max(timestamp) AS TIMESTAMP_NTZ) AS last_timestamp,
               array_join(transform(sort_array(collect_list(struct(device_id, event_id))),
                                    x -> concat(x.device_id, ':', x.event_id)), ' ') AS images
        FROM (SELECT window(timestamp, '100 milliseconds') AS w, device_id,
                     max_by(event_id, struct(timestamp, event_id)) AS event_id, max(timestamp) AS timestamp
              FROM video GROUP BY window(timestamp, '100 milliseconds'), device_id)
        GROUP BY w
    """)


def grid_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid.cells(_last(spark, sf_dir, "ssrc"), TILE, TILE)
    return cells.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "camera",
                        "grid_size", "x", "y",
                        px.canvas_side(F.col("grid_size"), TILE).alias("canvas_side"))


def grid_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = grid.sources(_last(spark, sf_dir, "ssrc"), codec.iso_millis(F.col("last_ts")))
    return listed.select(plain("window_start"), "source")


def grid_frame_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grid.grid_rows(_last(spark, sf_dir, "ssrc"), "ssrc").select(
        "window_start", "timestamp", F.lit(OUT_CAMERA).alias("camera"))
    numbered = grid.number_frames(rows, WINDOW_MILLIS * 1000)
    return numbered.select("camera", plain("window_start"), plain("timestamp"), "frame_number")


def frame_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = udfs.block_mean(TILE, TILE, HALF, HALF)("pixels")
    return _frames(spark, sf_dir).select("camera", "frame_number", hex_text(small).alias("small_hex"))


def frame_resize_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on raw bytes, with an Arrow UDF."""
    raw = _frames(spark, sf_dir).select("camera", "frame_number", px.to_bytes(F.col("pixels")).alias("data"))
    small = udfs.resize_bytes(TILE, TILE, HALF, HALF)("data")
    return raw.select("camera", "frame_number", F.hex(small).alias("small_hex"))


def frame_resize_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of three sizes, the whole one and its upper part or left part, to a size that divides none."""
    pixels, odd = F.col("pixels"), F.col("frame_number") % 3
    height = F.when(odd == 1, TILE - 1).otherwise(TILE)
    width = F.when(odd == 2, TILE // 2).otherwise(TILE)
    cut = (
        F.when(odd == 1, F.slice(pixels, 1, TILE * (TILE - 1)))
        .when(odd == 2, F.filter(pixels, lambda p, i: i % TILE < TILE // 2)).otherwise(pixels)
    )
    raw = _frames(spark, sf_dir).select("camera", "frame_number", px.to_bytes(cut).alias("data"), width.alias("width"), height.alias("height"))
    small = udfs.resize_area(ODD_WIDTH, ODD_HEIGHT)("data", "width", "height")
    return raw.select("camera", "frame_number", F.hex(small).alias("small_hex"))


def grid_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = _last(spark, sf_dir).withColumn("data", px.to_bytes(F.col("pixels"))).drop("pixels")
    canvas = grid.compose(grid.grid_rows(last), TILE, TILE)
    return canvas.select(plain("window_start"), "canvas_width", "canvas_height", F.hex("data").alias("canvas_hex"))


def grid_compose_in_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slot of 1/2 s per grid frame, on a grey background, with a grouped-map function."""
    frames = _frames(spark, sf_dir).withColumn("data", px.to_bytes(F.col("pixels")))
    last = grid.last_per_camera(frames, "timestamp", times.discretize(F.col("timestamp"), 2), place=["camera", "frame_number"])
    canvas = grid.compose_in_pandas(last, TILE, TILE, BACKGROUND)
    return canvas.select(F.col("window").cast("timestamp_ntz").alias("discrete_timestamp"), "canvas_width",
                         "canvas_height", "n_cameras", F.hex("data").alias("canvas_hex"))


def frame_mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = px.mean_score(F.col("pixels"))
    return _frames(spark, sf_dir).select("camera", "frame_number", scaled(score, 6).alias("score_e6"))


def frame_mean_score_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on raw bytes, with an Arrow UDF."""
    raw = _frames(spark, sf_dir).select("camera", "frame_number", px.to_bytes(F.col("pixels")).alias("data"))
    return raw.select("camera", "frame_number", scaled(udfs.mean_score_bytes("data"), 6).alias("score_e6"))


def frame_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and components as read from the header of a PNG with the frame's pixels behind it."""
    header = px.png_header(F.lit(TILE), F.floor(F.size("pixels") / TILE), GREY)
    raw = _frames(spark, sf_dir).select("camera", "frame_number",
                                        F.concat(header, px.to_bytes(F.col("pixels"))).alias("data"))
    found = raw.withColumns(px.png_metadata(F.col("data")))
    text = px.describe(F.col("camera"), F.col("frame_number"), F.col("width"), F.col("height"),
                       F.col("components"), F.octet_length("data"))
    return found.select("camera", "frame_number", px.frame_name(F.col("camera"), F.col("frame_number")).alias("name"),
                        text.alias("description"))


def frame_head_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first frames of each camera written to a folder per frame, counted next to all frames."""
    frames = _frames(spark, sf_dir).select("camera", "frame_number", px.to_bytes(F.col("pixels")).alias("data"))
    path = run_dir(spark, "head")
    sinks.write_per_frame(frames.filter(F.col("frame_number") < HEAD_FRAMES), path)
    head = spark.read.schema(frames.schema).parquet(path).groupBy("camera").agg(
        F.count(F.lit(1)).alias("n_head"), F.sum(F.octet_length("data")).alias("n_head_bytes"))
    whole = frames.groupBy("camera").agg(F.count(F.lit(1)).alias("n_frames"))
    return whole.join(head, "camera", "left").select("camera", "n_frames", *[
        F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_head", "n_head_bytes")])


def frame_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's bytes in a file of their own, read back."""
    frames = _frames(spark, sf_dir).select("camera", "frame_number", px.to_bytes(F.col("pixels")).alias("data"))
    path = run_dir(spark, "files")
    event_files.write(frames, path, F.format_string("camera-%d-frame-%d.raw", "camera", "frame_number"))
    return event_files.read(spark, path).select("name", F.octet_length("data").alias("n_bytes"), F.hex("data").alias("data_hex"))


def group_frames_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of all cameras with the same number: how many, the last time, the brightest score."""
    frames = _frames(spark, sf_dir)
    return frames.groupBy("frame_number").agg(
        F.count(F.lit(1)).alias("n_frames"), F.max("timestamp").cast("timestamp_ntz").alias("timestamp"),
        scaled(F.max(px.mean_score(F.col("pixels"))), 6).alias("max_score_e6"),
    )


QUERIES = {f.__name__: f for f in (
    grid_last_per_camera, table_tumble_grid, grid_layout, grid_sources, grid_frame_number, frame_resize,
    frame_resize_bytes, frame_resize_area, grid_compose, grid_compose_in_pandas, frame_mean_score, frame_mean_score_bytes, frame_metadata,
    frame_head_filter, frame_files, group_frames_by_number,
)}

_HEX = "array_to_string(list_transform({}, lambda p: printf('%02X', p)), '')"
LAST_SQL = f"""
    SELECT w AS window_start, camera, arg_max(pixels, (ts, frame_number, ssrc)) AS pixels,
           arg_max(frame_number, (ts, frame_number, ssrc)) AS frame_number, max(ts) AS ts
    FROM (SELECT *, make_timestamp(epoch_us(ts) // {WINDOW_MILLIS * 1000} * {WINDOW_MILLIS * 1000}) AS w
          FROM ({FRAMES_SQL}))
    GROUP BY w, camera
"""
GRID_SQL = f"""
    SELECT window_start, max(ts) AS timestamp, count(*)::INT AS n_cameras,
           string_agg(camera || ':' || {_HEX.format('pixels')}, ' ' ORDER BY camera) AS images
    FROM ({LAST_SQL}) GROUP BY window_start
"""
_CELLS_SQL = f"""
    SELECT window_start, camera, pixels, g AS grid_size, (camera % g * {TILE + 1})::INT AS x,
           (camera // g * {TILE + 1})::INT AS y, (g * {TILE + 1} - 1)::INT AS canvas_side
    FROM (SELECT *, ceil(sqrt(max(camera) OVER (PARTITION BY window_start) + 1))::INT AS g FROM ({LAST_SQL}))
"""
_SMALL_SQL = f"""
    SELECT camera, frame_number, list(v ORDER BY o) AS small FROM (
        SELECT camera, frame_number, o, ((sum(p) * 2 + 4) // 8)::INT AS v FROM (
            SELECT camera, frame_number, unnest(pixels) AS p,
                   (unnest(range(64)) // 16) * {HALF} + (unnest(range(64)) % 8) // 2 AS o FROM ({FRAMES_SQL}))
        GROUP BY ALL)
    GROUP BY ALL
"""
_RESIZE_SQL = f"SELECT camera, frame_number, {_HEX.format('small')} AS small_hex FROM ({_SMALL_SQL})"
# Each pixel with each output pixel that it shares a part of, in units of 1/ODD_WIDTH and 1/ODD_HEIGHT.
_AREA_SQL = f"""
    SELECT camera, frame_number, list(v ORDER BY oy, ox) AS small FROM (
        SELECT camera, frame_number, ox, oy, ((2 * sum(p * sx * sy) + w * h) // (2 * w * h))::INT AS v FROM (
            SELECT *, least((x + 1) * {ODD_WIDTH}, (ox + 1) * w) - greatest(x * {ODD_WIDTH}, ox * w) AS sx,
                   least((y + 1) * {ODD_HEIGHT}, (oy + 1) * h) - greatest(y * {ODD_HEIGHT}, oy * h) AS sy
            FROM (SELECT *, i % {TILE} AS x, i // {TILE} AS y FROM (
                SELECT camera, frame_number, unnest(pixels) AS p, unnest(range({TILE * TILE})) AS i,
                       CASE WHEN frame_number % 3 = 2 THEN {TILE // 2} ELSE {TILE} END AS w,
                       CASE WHEN frame_number % 3 = 1 THEN {TILE - 1} ELSE {TILE} END AS h FROM ({FRAMES_SQL}))),
                 (SELECT unnest(range({ODD_WIDTH})) AS ox), (SELECT unnest(range({ODD_HEIGHT})) AS oy)
            WHERE x < w AND y < h)
        WHERE sx > 0 AND sy > 0 GROUP BY camera, frame_number, ox, oy, w, h)
    GROUP BY ALL
"""
_SCORE_SQL = f"""
    SELECT camera, frame_number, {scaled_sql('list_sum(pixels)::DOUBLE / len(pixels) / 255.0::DOUBLE', 6)} AS score_e6
    FROM ({FRAMES_SQL})
"""

_CANVAS_SQL = f"""
    WITH c AS ({_CELLS_SQL}),
         pixel AS (SELECT window_start, x + i % {TILE} AS px, y + i // {TILE} AS py, p
                   FROM (SELECT window_start, x, y, unnest(pixels) AS p, unnest(range({TILE * TILE})) AS i FROM c)),
         canvas AS (SELECT window_start, side, i % side AS px, i // side AS py, i
                    FROM (SELECT window_start, side, unnest(range(side * side)) AS i
                          FROM (SELECT DISTINCT window_start, canvas_side AS side FROM c)))
    SELECT a.window_start, side, i, p
    FROM canvas a LEFT JOIN pixel b ON a.window_start = b.window_start AND a.px = b.px AND a.py = b.py
"""
_CANVAS_HEX = "string_agg(printf('%02X', coalesce(p, {})), '' ORDER BY i)"

ORACLES = {
    "grid_last_per_camera": GRID_SQL,
    "table_tumble_grid": """
        SELECT 0 AS camera, '' AS routing_key, make_timestamp(w + 100000) AS timestamp, count(*) AS n_images,
               max(ts) AS last_timestamp, string_agg(user_id || ':' || event_id, ' ' ORDER BY user_id) AS images
        FROM (SELECT epoch_us(ts) // 100000 * 100000 AS w, user_id, arg_max(event_id, (ts, event_id)) AS event_id,
                     max(ts) AS ts FROM events GROUP BY ALL)
        GROUP BY w""",
    "grid_layout": f"SELECT window_start, camera, grid_size, x, y, canvas_side FROM ({_CELLS_SQL})",
    "grid_sources": f"""
        SELECT window_start,
               to_json(list({{'camera': camera, 'frame_number': frame_number,
                              'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')}} ORDER BY camera))::VARCHAR AS source
        FROM ({LAST_SQL}) GROUP BY window_start""",
    "grid_frame_number": f"""
        SELECT {OUT_CAMERA} AS camera, window_start, max(ts) AS timestamp,
               row_number() OVER (ORDER BY window_start) - 1 AS frame_number
        FROM ({LAST_SQL}) GROUP BY window_start""",
    "frame_resize": _RESIZE_SQL,
    "frame_resize_bytes": _RESIZE_SQL,
    "frame_resize_area": f"SELECT camera, frame_number, {_HEX.format('small')} AS small_hex FROM ({_AREA_SQL})",
    "grid_compose": f"""
        SELECT window_start, side AS canvas_width, side AS canvas_height, {_CANVAS_HEX.format(0)} AS canvas_hex
        FROM ({_CANVAS_SQL}) GROUP BY window_start, side""",
    "grid_compose_in_pandas": f"""
        SELECT c.window_start AS discrete_timestamp, side AS canvas_width, side AS canvas_height, n_cameras,
               canvas_hex
        FROM (SELECT window_start, side, {_CANVAS_HEX.format(BACKGROUND)} AS canvas_hex
              FROM ({_CANVAS_SQL}) GROUP BY window_start, side) c
        JOIN ({GRID_SQL}) g ON c.window_start = g.window_start""",
    "frame_mean_score": _SCORE_SQL,
    "frame_mean_score_bytes": _SCORE_SQL,
    "frame_metadata": f"""
        SELECT camera, frame_number, printf('camera-%03d-frame-%05d', camera, frame_number) AS name,
               printf('camera %d, frame %d, %dx%dx%d, %d bytes', camera, frame_number, {TILE},
                      len(pixels) // {TILE}, 1, len(pixels) + 26) AS description
        FROM ({FRAMES_SQL})""",
    "frame_head_filter": f"""
        SELECT camera, count(*) AS n_frames, count(*) FILTER (frame_number < {HEAD_FRAMES}) AS n_head,
               (sum(len(pixels)) FILTER (frame_number < {HEAD_FRAMES}))::BIGINT AS n_head_bytes
        FROM ({FRAMES_SQL}) GROUP BY camera""",
    "frame_files": f"""
        SELECT printf('camera-%d-frame-%d.raw', camera, frame_number) AS name, len(pixels)::INT AS n_bytes,
               {_HEX.format('pixels')} AS data_hex
        FROM ({FRAMES_SQL})""",
    "group_frames_by_number": f"""
        SELECT frame_number, count(*) AS n_frames, max(ts) AS timestamp,
               {scaled_sql('max(list_sum(pixels)::DOUBLE / len(pixels) / 255.0::DOUBLE)', 6)} AS max_score_e6
        FROM ({FRAMES_SQL}) GROUP BY frame_number""",
}
