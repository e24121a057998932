"""The streaming forms. Each runs over its whole table and stops; the result is what the sink holds.

The windows that the last watermark has not passed are added when the source has come to its end.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import codec, times, udfs
from sensorloom.functions import frames as px
from sensorloom.operators import chunks, grid
from sensorloom.operators import events as ev
from sensorloom.plans import camera_frames, payloads, readings
from sensorloom.plans import logs as logs_plan
from sensorloom.plans.tables import (
    CHUNKS_SQL, FRAMES_SQL, SEGMENTS, TILE, arrivals, log, payload_chunks, pixel_frames, plain, scaled, table, table_stream,
)
from sensorloom.plans.tables import readings as as_readings
from sensorloom.sources import log as logs
from sensorloom.sources import segment_log, sinks
from sensorloom.sources.segment_log import SegmentLog
from sensorloom.streaming import frames, positions, run, state
from sensorloom.workspace import run_dir

DELAY = "10 seconds"
FRAME_KEYS = ["doc_id", "timestamp"]
FILES = 4


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table_stream(spark, sf_dir, "events"))


def stream_json_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as JSON files with base64 payloads, read as a stream with a declared schema."""
    parts = payload_chunks(table(spark, sf_dir, "documents"))
    path = run_dir(spark, "json-chunks")
    sinks.write_json(parts.select("doc_id", "timestamp", F.col("chunk_index").alias("chunk"),
                                  (F.col("final_chunk_index") + 1).alias("num_chunks"), "data"), path)
    stream = logs.json_stream(spark, path, "doc_id long, timestamp timestamp, chunk int, num_chunks int, data binary")
    read = stream.select("doc_id", "timestamp", "chunk", "num_chunks", F.sha1("data").alias("data_sha1"))
    return run.to_table(read, "stream-json").withColumn("timestamp", plain("timestamp"))


def _joined(spark: SparkSession, sf_dir: str, condition: str, how: str, name: str) -> DataFrame:
    """Chunk joins as one keyed aggregate: a frame comes when the watermark has passed its time."""
    def frames_of(documents: DataFrame) -> DataFrame:
        parts = payloads.thirds(documents).filter(condition).withWatermark("timestamp", DELAY)
        joined = chunks.join_chunks(parts, FRAME_KEYS, payloads.JOIN_CHUNKS, how)
        return joined.select(
            *FRAME_KEYS, F.sha1(chunks.concat_chunks(payloads.JOIN_CHUNKS, False)).alias("plain_sha1"),
            F.sha1(chunks.concat_chunks(payloads.JOIN_CHUNKS, True)).alias("safe_sha1"))

    # Chunks without a key wait for nothing: the stream has given them all.
    return _finished(spark, sf_dir, name, "documents", frames_of, "timestamp", F.col("doc_id").isNotNull())


def stream_chunk_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of exactly three chunks."""
    found = _joined(spark, sf_dir, "final_chunk_index = 2", "inner", "stream-chunk-join")
    return found.select("doc_id", F.col("plain_sha1").alias("data_sha1"))


def stream_chunk_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of up to three chunks."""
    found = _joined(spark, sf_dir, "final_chunk_index <= 2", "left", "stream-chunk-left")
    return found.select("doc_id", "plain_sha1", "safe_sha1")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device and hour; which reading survives is open, so only the keys are kept."""
    rows = _readings(spark, sf_dir).select(F.date_trunc("hour", "timestamp").alias("hour"), "device_id")
    kept = rows.withWatermark("hour", DELAY).dropDuplicates(["hour", "device_id"])
    return run.to_table(kept, "stream-dedup").withColumn("hour", plain("hour"))


def stream_chunk_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = payload_chunks(table_stream(spark, sf_dir, "documents"))
    found = run.to_table(state.reassemble(parts, FRAME_KEYS, "timestamp", DELAY), "stream-reassemble")
    return found.select("doc_id", plain("timestamp"), F.col("n_chunks").cast("bigint").alias("n_chunks"),
                        F.sha1("data").alias("data_sha1"), "error")


def stream_chunk_reassemble_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one batch job per micro-batch in place of a Python call per frame."""
    parts = payload_chunks(table_stream(spark, sf_dir, "documents"))
    base = run_dir(spark, "stream-reassemble-batches")
    frames.reassemble_to_table(parts, FRAME_KEYS, "timestamp", base, f"{base}/checkpoint").awaitTermination()
    found = spark.read.schema(frames.frame_schema(parts, FRAME_KEYS)).parquet(f"{base}/frames")
    return found.select("doc_id", plain("timestamp"), "n_chunks", F.sha1("data").alias("data_sha1"), "error")


def stream_chunk_reassemble_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with payloads outside the state, from a chunk log of three parts that are a micro-batch each.

    Every other chunk comes three seconds late, so that frames go on over the end of a part.
    """
    documents = table(spark, sf_dir, "documents")
    parts = payload_chunks(documents).withColumns({
        "segment_id": F.col("doc_id") % SEGMENTS, "offset": F.col("doc_id") * chunks.MAX_CHUNKS + F.col("chunk_index")})
    base = run_dir(spark, "stream-reassemble-positions")
    late = F.col("doc_id") + F.when(F.col("chunk_index") % 2 == 1, 3).otherwise(0)
    ends = documents.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    step = ((ends["high"] or 0) - (ends["low"] or 0) + 4) // 3 + 1
    files = max(FILES, spark.sparkContext.defaultParallelism)
    for i in range(3):
        start = (ends["low"] or 0) + i * step
        parts.filter((late >= start) & (late < start + step)).repartition(files).write.mode("append").parquet(f"{base}/log")
    stream = logs.scan_stream(spark, f"{base}/log", parts.schema, max_files=files)

    def log(session: SparkSession) -> DataFrame:
        return session.read.schema(parts.schema).parquet(f"{base}/log")

    positions.reassemble_to_table(stream, log, FRAME_KEYS, "timestamp", DELAY, base, f"{base}/checkpoint").awaitTermination()
    found = spark.read.schema(frames.frame_schema(parts, FRAME_KEYS)).parquet(f"{base}/frames")
    return found.select("doc_id", plain("timestamp"), "n_chunks", F.sha1("data").alias("data_sha1"), "error")


def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = readings.interval_sides(_readings(spark, sf_dir))
    pairs = ev.stream_interval_join(left, right, "device_id", "timestamp1", "timestamp2", readings.INTERVAL)
    with sinks.no_idle_batches(spark):
        found = run.to_table(pairs, "stream-interval-join")
    return found.select("device_id", "event_id1", "event_id2", plain("timestamp1"), plain("timestamp2"))


def _finished(spark: SparkSession, sf_dir: str, name: str, source: str, windows: Callable[[DataFrame], DataFrame],
              end: str = "window_end", open_rows: Column | None = None,
              last: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``windows`` over the table as a stream, with those still open at its end; ``last`` goes behind the choice.

    ``open_rows`` are those that may be open at all.
    """
    def rest(watermark: datetime) -> DataFrame:
        batch = windows(table(spark, sf_dir, source)).filter(F.col(end) > F.lit(watermark))
        return last(batch if open_rows is None else batch.filter(open_rows))

    return run.to_finished_table(last(windows(table_stream(spark, sf_dir, source))), rest, name)


def stream_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    def windows(events: DataFrame) -> DataFrame:
        rows = as_readings(events).withColumn("key", times.value_bucket(F.col("temp_celsius"), 5))
        return ev.window_counts(rows.withWatermark("timestamp", DELAY), ["key"], "timestamp", "2 hours", "1 hour")

    found = _finished(spark, sf_dir, "stream-sliding", "events", windows)
    return found.select("key", plain("window_start"), plain("window_end"), "n_events")


def stream_sliding_count_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a day that start every hour, from counts by hour."""
    def windows(events: DataFrame) -> DataFrame:
        return ev.stream_pane_counts(as_readings(events), ["event_type"], "timestamp", "1 day", "1 hour", DELAY)

    found = _finished(spark, sf_dir, "stream-panes", "events", windows)
    return found.select("event_type", plain("window_start"), plain("window_end"), "n_events")


def stream_session_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    def windows(events: DataFrame) -> DataFrame:
        return ev.stream_sessions(as_readings(events), ["device_id"], "timestamp", readings.GAP, DELAY)

    found = _finished(spark, sf_dir, "stream-sessions", "events", windows, "session_end")
    return found.select("device_id", plain("session_start"), plain("session_end"), "n_events")


def stream_arrival_session_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by the stored time of arrival."""
    def windows(events: DataFrame) -> DataFrame:
        return ev.stream_arrival_sessions(arrivals(events), ["device_id"], readings.GAP)

    found = _finished(spark, sf_dir, "stream-arrivals", "events", windows, "session_end")
    return found.select("device_id", plain("session_start"), plain("session_end"), "n_events")


def _grids(value: str) -> Callable[[DataFrame], DataFrame]:
    """Two aggregates in a row: per camera and window, then per window."""
    def windows(embeddings: DataFrame) -> DataFrame:
        images = pixel_frames(embeddings).withWatermark("timestamp", "1 second")
        last = grid.last_per_camera(images, "timestamp", f"{camera_frames.WINDOW_MILLIS} milliseconds", value)
        return grid.grid_rows(last, value)

    return windows


def stream_grid_last_per_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _finished(spark, sf_dir, "stream-grid", "embeddings", _grids("pixels"))
    images = F.transform("tiles", lambda t: F.concat_ws(
        ":", t["camera"].cast("string"), camera_frames.hex_text(t["value"])))
    return found.select(plain("window_start"), plain("timestamp"), "n_cameras",
                        F.array_join(images, " ").alias("images"))


def stream_grid_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shrink each frame, compose one grid frame per window and write it as chunked JSON events."""
    resize = udfs.block_mean(TILE, TILE, camera_frames.HALF, camera_frames.HALF)

    def windows(embeddings: DataFrame) -> DataFrame:
        images = pixel_frames(embeddings).withColumn("data", px.to_bytes(resize("pixels")))
        return grid.grid_rows(grid.last_per_camera(images.withWatermark("timestamp", "1 second"), "timestamp",
                                                   f"{camera_frames.WINDOW_MILLIS} milliseconds"))

    def events(rows: DataFrame) -> DataFrame:
        canvas = grid.compose(rows, camera_frames.HALF, camera_frames.HALF)
        frame = canvas.select(F.lit(camera_frames.OUT_CAMERA).alias("camera"), "window_start", "timestamp", "data",
                              codec.frame_hash(F.col("data")).alias("hash"))
        return sinks.to_events(chunks.split(frame, 64), codec.routing_key(F.col("camera")),
                               "camera", "window_start", "timestamp", "data", "hash", "chunk_index", "final_chunk_index")

    written = _finished(spark, sf_dir, "stream-grid-sink", "embeddings", windows, last=events)
    ddl = ("camera int, window_start timestamp, timestamp timestamp, data binary, hash binary, "
           "chunk_index smallint, final_chunk_index smallint")
    parts = codec.decode_json(written, ddl, mode="FAILFAST")
    whole = chunks.check_hash(chunks.reassemble(parts, ["camera", "window_start", "timestamp"], carry=["hash"]))
    return whole.select("camera", plain("window_start"), plain("timestamp"), "n_chunks",
                        F.octet_length("data").alias("n_bytes"), "is_hash_valid")


def stream_grid_frame_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output frame counter, kept in state by a second stream over the table of grid frames."""
    def named(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(camera_frames.OUT_CAMERA).alias("camera"), "window_start")

    rows = _finished(spark, sf_dir, "stream-grid-windows", "embeddings", _grids("ssrc"), last=named)
    path = run_dir(spark, "stream-grid-table")
    rows.write.parquet(path)
    windows = logs.scan_stream(spark, path, rows.schema)
    found = run.to_table(state.number_frames(windows, "camera", "window_start"), "stream-grid-number")
    return found.select("camera", plain("window_start"), "frame_number")


def stream_camera_grid_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole camera job: chunks to frames, shrink, last per camera, grid, number, chunks, write by key.

    Frames come out of the chunk stream per micro-batch; a second stream makes one grid of each window. The
    written events are read back and put together again.
    """
    keys = ["camera", "frame_number", "ssrc", "timestamp"]
    images = pixel_frames(table_stream(spark, sf_dir, "embeddings")).withColumn("data", px.to_bytes(F.col("pixels")))
    parts = chunks.split(images.select(*keys, "data", codec.frame_hash(F.col("data")).alias("hash")), 24)
    base = run_dir(spark, "camera-job")
    frames.reassemble_to_table(parts, keys, "timestamp", base, f"{base}/checkpoint").awaitTermination()
    schema, resize = frames.frame_schema(parts, keys), udfs.resize_bytes(TILE, TILE, camera_frames.HALF, camera_frames.HALF)

    def windows(found: DataFrame) -> DataFrame:
        small = found.filter("error IS NULL").withWatermark("timestamp", "1 second").withColumn("data", resize("data"))
        return grid.grid_rows(grid.last_per_camera(small, "timestamp", f"{camera_frames.WINDOW_MILLIS} milliseconds"))

    folder = f"{base}/frames/batch=*"
    rows = run.to_finished_table(
        windows(logs.scan_stream(spark, folder, schema)),
        lambda mark: windows(spark.read.schema(schema).parquet(folder)).filter(F.col("window_end") > F.lit(mark)), "camera-grid")
    canvas = grid.compose(rows, camera_frames.HALF, camera_frames.HALF).withColumn("camera", F.lit(camera_frames.OUT_CAMERA))
    numbered = grid.number_frames(canvas, camera_frames.WINDOW_MILLIS * 1000).select(
        "camera", "window_start", "frame_number", "data", codec.frame_hash(F.col("data")).alias("hash"))
    fields = ["camera", "window_start", "frame_number", "data", "hash", "chunk_index", "final_chunk_index"]
    events = chunks.split(numbered, 64).select(
        codec.routing_key(F.col("camera")).alias("routing_key"), "frame_number", "chunk_index",
        codec.encode_json(*fields).alias("event"))
    sinks.write_routed(events, f"{base}/grids", ["frame_number", "chunk_index"])
    ddl = ("camera int, window_start timestamp, frame_number bigint, data binary, hash binary, "
           "chunk_index smallint, final_chunk_index smallint")
    read = codec.decode_json(spark.read.schema(events.schema).parquet(f"{base}/grids").select("event"), ddl, mode="FAILFAST")
    whole = chunks.check_hash(chunks.reassemble(read, ["camera", "window_start", "frame_number"], carry=["hash"]))
    return whole.select("camera", plain("window_start"), "frame_number", "n_chunks",
                        F.octet_length("data").alias("n_bytes"), "is_hash_valid")


def stream_table_tumble_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table form on a stream: JSON events with row time, tumbling windows of 100 ms."""
    path = run_dir(spark, "json-frames")
    rows = pixel_frames(table(spark, sf_dir, "embeddings")).select("camera", "frame_number", "timestamp")
    sinks.write_json(rows, path)

    def windows(frames: DataFrame) -> DataFrame:
        marked = frames.withWatermark("timestamp", "100 milliseconds")
        return marked.groupBy(F.window("timestamp", "100 milliseconds")).agg(
            F.count(F.lit(1)).alias("n_frames"), F.max("frame_number").alias("last_frame"),
        ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_frames", "last_frame")

    found = run.to_finished_table(
        windows(logs.json_stream(spark, path, rows.schema)),
        lambda watermark: windows(spark.read.schema(rows.schema).json(path)).filter(F.col("window_end") > F.lit(watermark)),
        "stream-tumble")
    return found.select(plain("window_start"), plain("window_end"), "n_frames", "last_frame")


def stream_tail_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at the tail of the log as it was at the middle of its time span."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.select(micros.alias("m")).agg(F.expr("(min(m) + max(m)) div 2")).scalar()
    tails = logs.extent(log(events.filter(micros <= middle)))
    ahead = logs.from_tail(log(table_stream(spark, sf_dir, "events")), tails)
    return run.to_table(ahead.select("segment_id", "offset", "routing_key"), "stream-tail")


def stream_tail_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by log position: what came before the middle is one transaction, of which no file is opened."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.select(micros.alias("m")).agg(F.expr("(min(m) + max(m)) div 2")).scalar()
    rows = events.withColumn("_early", F.coalesce(micros <= middle, F.lit(False)))
    written = log(events)
    kept = SegmentLog(spark, run_dir(spark, "segment-log"), written.schema)
    with kept.begin("before") as transaction:
        transaction.write(log(rows.filter("_early")))
    cuts = kept.tails()
    with kept.begin("after") as transaction:
        transaction.write(log(rows.filter("NOT _early")))
    ahead = segment_log.stream(kept, cuts)
    return run.to_table(ahead.select("segment_id", "offset", "routing_key"), "stream-tail-positions")


def stream_routed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by routing key in three micro-batches, each key numbered on from one to the next."""
    events = log(table(spark, sf_dir, "events")).select("routing_key", "offset")
    ends = events.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
    low, step = ends["low"] or 0, ((ends["high"] or 0) - (ends["low"] or 0)) // 3 + 1
    base = run_dir(spark, "stream-routed")
    for i in range(3):
        part = events.filter(F.col("offset").between(low + i * step, low + (i + 1) * step - 1))
        part.repartition(FILES).write.mode("append").parquet(f"{base}/log")
    stream = logs.scan_stream(spark, f"{base}/log", events.schema, max_files=FILES)
    numbered = state.number_events(stream, "routing_key", ["offset"], spark.sparkContext.defaultParallelism)
    sinks.stream_routed(numbered, f"{base}/routed", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(numbered.schema).parquet(f"{base}/routed/batch=*").select("routing_key", "offset", "position")


def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score frames and write each micro-batch in frame order."""
    images = pixel_frames(table_stream(spark, sf_dir, "embeddings"))
    scores = images.select("camera", "frame_number", scaled(px.mean_score(F.col("pixels")), 6).alias("score_e6"))

    def prepare(batch: DataFrame) -> DataFrame:
        return batch.orderBy("frame_number", "camera")

    return run.to_batches(scores, "stream-batches", prepare).select("camera", "frame_number", "score_e6")


QUERIES = {f.__name__: f for f in (
    stream_json_chunks, stream_chunk_join_inner, stream_chunk_join_left, stream_camera_grid_job, stream_dedup, stream_chunk_reassemble,
    stream_chunk_reassemble_batches, stream_chunk_reassemble_positions, stream_interval_join,
    stream_sliding_count, stream_sliding_count_panes, stream_session_count,
    stream_arrival_session_count, stream_grid_last_per_camera, stream_grid_sink,
    stream_grid_frame_number, stream_table_tumble_grid, stream_tail_read, stream_tail_positions, stream_routed_write,
    stream_foreach_batch,
)}


# A grid of g x g tiles of 4 x 4 with margin 1; g from the greatest camera.
_SINK_SQL = f"""
    SELECT window_start, timestamp, (5 * g - 1) * (5 * g - 1) AS n_bytes
    FROM (SELECT window_start, max(ts) AS timestamp, ceil(sqrt(max(camera) + 1))::INT AS g
          FROM ({camera_frames.LAST_SQL}) GROUP BY window_start)
"""

ORACLES = {
    "stream_json_chunks": f"""
        SELECT doc_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS timestamp, chunk_index::INT AS chunk,
               (final_chunk_index + 1)::INT AS num_chunks, sha1(data) AS data_sha1
        FROM ({CHUNKS_SQL})""",
    "stream_chunk_join_inner": payloads.ORACLES["chunk_join_inner"],
    "stream_chunk_join_left": payloads.ORACLES["chunk_join_left"],
    "stream_camera_grid_job": f"""
        SELECT {camera_frames.OUT_CAMERA} AS camera, window_start,
               row_number() OVER (ORDER BY window_start) - 1 AS frame_number,
               ((n_bytes + 63) // 64)::BIGINT AS n_chunks, n_bytes, true AS is_hash_valid
        FROM ({_SINK_SQL})""",
    "stream_dedup": "SELECT DISTINCT date_trunc('hour', ts) AS hour, user_id AS device_id FROM events",
    "stream_chunk_reassemble": f"""
        SELECT doc_id, timestamp, n_chunks, data_sha1, NULL::VARCHAR AS error
        FROM ({payloads.ORACLES['chunk_reassemble']})""",
    "stream_chunk_reassemble_batches": f"""
        SELECT doc_id, timestamp, n_chunks, data_sha1, NULL::VARCHAR AS error
        FROM ({payloads.ORACLES['chunk_reassemble']})""",
    "stream_chunk_reassemble_positions": f"""
        SELECT doc_id, timestamp, n_chunks, data_sha1, NULL::VARCHAR AS error
        FROM ({payloads.ORACLES['chunk_reassemble']})""",
    "stream_interval_join": readings.INTERVAL_SQL,
    "stream_sliding_count": readings.SLIDING_SQL,
    "stream_sliding_count_panes": readings.panes_sql(readings.HOUR),
    "stream_session_count": readings.SESSION_SQL,
    "stream_arrival_session_count": readings.ARRIVAL_SESSION_SQL,
    "stream_grid_last_per_camera": camera_frames.GRID_SQL,
    "stream_grid_sink": f"""
        SELECT {camera_frames.OUT_CAMERA} AS camera, window_start, timestamp,
               ((n_bytes + 63) // 64)::BIGINT AS n_chunks, n_bytes, true AS is_hash_valid
        FROM ({_SINK_SQL})""",
    "stream_grid_frame_number": f"""
        SELECT {camera_frames.OUT_CAMERA} AS camera, window_start,
               row_number() OVER (ORDER BY window_start) - 1 AS frame_number
        FROM ({camera_frames.GRID_SQL})""",
    "stream_table_tumble_grid": f"""
        SELECT w AS window_start, w + INTERVAL 100 MILLISECOND AS window_end, count(*) AS n_frames,
               max(frame_number) AS last_frame
        FROM (SELECT make_timestamp(epoch_us(ts) // 100000 * 100000) AS w, frame_number FROM ({FRAMES_SQL}))
        GROUP BY w""",
    "stream_tail_read": logs_plan.ORACLES["log_tail_read"],
    "stream_tail_positions": logs_plan.ORACLES["log_tail_read"],
    "stream_routed_write": """
        SELECT user_id::VARCHAR AS routing_key, event_id AS "offset",
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position
        FROM events""",
    "stream_foreach_batch": camera_frames.ORACLES["frame_mean_score"],
}
