"""Log access, decoding and encoding, transactions, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import codec
from sensorloom.operators import ordering
from sensorloom.plans.tables import (
    CHUNKS_SQL, LOG_SQL, SEGMENTS, log, payload_chunks, readings, table,
)
from sensorloom.sources import log as logs
from sensorloom.sources import sinks
from sensorloom.sources.transactions import TransactionalTable
from sensorloom.workspace import run_dir

COMMIT_PERIOD = 10
WRITERS = 4
ABORTED = (2, 1)  # writer and transaction
SEED = 1
SAMPLE = 1000


def log_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(table(spark, sf_dir, "events")).groupBy("segment_id").agg(F.count(F.lit(1)).alias("n_events"))


def log_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.extent(log(table(spark, sf_dir, "events")))


def log_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second and the fourth quarter of each segment's extent, and once more a part of the second."""
    events = log(table(spark, sf_dir, "events"))
    cuts = logs.extent(events).selectExpr("segment_id", "head_offset AS h", "tail_offset - head_offset AS n").selectExpr(
        "segment_id", "stack(3, h + n div 4, h + n div 2, h + n div 3, h + n div 2,"
        " h + 3 * n div 4, CAST(NULL AS BIGINT)) AS (from_offset, to_offset)")
    return logs.between_cuts(events, cuts).select(
        "segment_id", "offset", codec.decode_text(F.col("event")).alias("event_text")
    )


def log_tail_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tail as it was at the middle of the log's time span, and everything after it."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.select(micros.alias("m")).agg(F.expr("(min(m) + max(m)) div 2"))
    before = events.filter(micros <= middle.scalar())
    return logs.from_tail(log(events), logs.extent(log(before))).select("segment_id", "offset", "routing_key")


def sql_view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs.register(log(table(spark, sf_dir, "events")), "sensor_log")
    return spark.sql("""
        SELECT routing_key, count(*) AS n_events, min(offset) AS first_offset
        FROM sensor_log GROUP BY routing_key
    """)


def decode_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("event"))
    text = codec.decode_text(F.col("event"))
    return events.select("doc_id", text.alias("event_string"), F.octet_length("event").alias("n_bytes"))


def decode_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.encode("props", "UTF-8").alias("event"))
    return codec.decode_json(raw, "k int").withColumnRenamed("k", "reading")


def json_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two event types are given bad JSON: one without the field, one cut off."""
    props = (
        F.when(F.col("event_type") == "click", F.replace("props", F.lit("k"), F.lit("other")))
        .when(F.col("event_type") == "error", F.replace("props", F.lit("}"), F.lit("")))
        .otherwise(F.col("props"))
    )
    raw = table(spark, sf_dir, "events").select("event_type", F.encode(props, "UTF-8").alias("event"))
    checked = codec.decode_required(raw, "k int", ["k"])
    return checked.groupBy("event_type", F.coalesce("decode_error", F.lit("good")).alias("status")).agg(
        F.count(F.lit(1)).alias("n_events"), F.coalesce(F.sum("k"), F.lit(0)).alias("sum_k")
    )


def encode_json_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    event = codec.encode_json("event_id", "user_id", "event_type", F.encode("props", "UTF-8").alias("data"))
    return events.select("event_id", codec.decode_text(event).alias("event_text"))


def iso_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings_ = readings(table(spark, sf_dir, "events"))
    return readings_.select("event_id", codec.iso_millis(F.col("timestamp")).alias("iso_time"))


def routed_write_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by routing key, read back, number the events of each key."""
    path = run_dir(spark, "routed")
    sinks.write_routed(log(table(spark, sf_dir, "events")), path, ["offset"])
    written = spark.read.parquet(path)
    numbered = ordering.position(
        written, ["routing_key"], ["offset"], [ordering.offset_block(F.col("offset"))], "key_position"
    )
    return numbered.select("routing_key", "offset", "key_position")


def txn_commit_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of documents by one writer per language; every tenth frame's last chunk commits."""
    events = payload_chunks(table(spark, sf_dir, "documents"), carry=["lang"])
    commit = (F.col("chunk_index") == F.col("final_chunk_index")) & (F.col("doc_id") % COMMIT_PERIOD == 0)
    # 32 frames of at most 32,768 chunks make a block of at most 2**20 rows.
    block = ordering.offset_block(F.col("doc_id"), 5)
    grouped = ordering.commit_groups(events, ["lang"], ["doc_id", "chunk_index"], [block], commit)
    return grouped.select("lang", "doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), "txn")


def txn_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers with two transactions each, of which one is aborted after writing; what a reader then sees."""
    schema = "writer bigint, doc_id bigint, chunk_index smallint, data binary"
    events = payload_chunks(table(spark, sf_dir, "documents")).withColumn("writer", F.col("doc_id") % WRITERS)
    target = TransactionalTable(spark, run_dir(spark, "transactions"), schema)
    half = F.col("doc_id") % COMMIT_PERIOD < COMMIT_PERIOD // 2
    for writer in range(WRITERS):
        for part, rows in enumerate((half, ~half)):
            transaction = target.begin(f"writer-{writer}-{part}")
            transaction.write(events.filter((F.col("writer") == writer) & rows).select("writer", "doc_id", "chunk_index", "data"))
            if (writer, part) == ABORTED:
                transaction.abort()
            else:
                transaction.commit()
    return target.read().select("writer", "doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), F.sha1("data").alias("data_sha1"))


def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings in random order as JSON, read back."""
    path = run_dir(spark, "export")
    rows = readings(table(spark, sf_dir, "events"))
    sinks.write_json(sinks.shuffled(rows, ["event_id"], SEED), path)
    exported = spark.read.schema(rows.schema).json(path)
    return exported.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def limit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return sinks.sample(events, ["event_id"], SAMPLE)


QUERIES = {f.__name__: f for f in (
    log_scan_count, log_extent, log_bounded_read, log_tail_read, sql_view_scan, decode_utf8, decode_flatten,
    json_required_fields, encode_json_event, iso_millis, routed_write_layout, txn_commit_groups, txn_write_read,
    training_export, limit_sample,
)}

_EVENT_TEXT = "to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::VARCHAR"

ORACLES = {
    "log_scan_count": f"SELECT segment_id, count(*) AS n_events FROM ({LOG_SQL}) GROUP BY segment_id",
    "log_extent": f"""
        SELECT segment_id, min("offset") AS head_offset, max("offset") + 1 AS tail_offset
        FROM ({LOG_SQL}) GROUP BY segment_id""",
    "log_bounded_read": f"""
        WITH l AS (SELECT user_id % {SEGMENTS} AS segment_id, event_id AS "offset", {_EVENT_TEXT} AS event_text
                   FROM events),
             e AS (SELECT segment_id, min("offset") AS h, max("offset") + 1 AS t FROM l GROUP BY segment_id)
        SELECT l.segment_id, l."offset", l.event_text FROM l JOIN e ON l.segment_id = e.segment_id
        WHERE l."offset" >= h + (t - h) // 4 AND l."offset" < h + (t - h) // 2
           OR l."offset" >= h + 3 * (t - h) // 4""",
    "log_tail_read": f"""
        WITH l AS ({LOG_SQL}),
             m AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS middle FROM events),
             t AS (SELECT segment_id, max("offset") + 1 AS tail FROM l, m WHERE epoch_us(ts) <= middle
                   GROUP BY segment_id)
        SELECT l.segment_id, "offset", user_id::VARCHAR AS routing_key
        FROM l LEFT JOIN t ON l.segment_id = t.segment_id WHERE "offset" >= coalesce(tail, "offset")""",
    "sql_view_scan": """
        SELECT user_id::VARCHAR AS routing_key, count(*) AS n_events, min(event_id) AS first_offset
        FROM events GROUP BY user_id""",
    "decode_utf8": """
        SELECT doc_id, decode(encode(text)) AS event_string, octet_length(encode(text))::INT AS n_bytes
        FROM documents""",
    "decode_flatten": "SELECT event_id, json_extract(props, '$.k')::INT AS reading FROM events",
    "json_required_fields": """
        SELECT event_type,
               CASE event_type WHEN 'click' THEN 'missing k' WHEN 'error' THEN 'malformed' ELSE 'good' END AS status,
               count(*) AS n_events,
               sum(CASE WHEN event_type IN ('click', 'error') THEN 0
                   ELSE json_extract(props, '$.k')::INT END)::BIGINT AS sum_k
        FROM events GROUP BY event_type""",
    "encode_json_event": """
        SELECT event_id, to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type,
                                  'data': to_base64(encode(props))})::VARCHAR AS event_text
        FROM events""",
    "iso_millis": """
        SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_time
        FROM events""",
    "routed_write_layout": """
        SELECT user_id::VARCHAR AS routing_key, event_id AS "offset",
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS key_position
        FROM events""",
    "txn_commit_groups": f"""
        WITH c AS (SELECT d.lang, c.doc_id, c.chunk_index::INT AS chunk_index,
                          (c.chunk_index = c.final_chunk_index AND c.doc_id % {COMMIT_PERIOD} = 0)::INT AS commit_flag
                   FROM ({CHUNKS_SQL}) c JOIN documents d ON c.doc_id = d.doc_id),
             s AS (SELECT *, sum(commit_flag) OVER (PARTITION BY lang ORDER BY doc_id, chunk_index) AS seen,
                          sum(commit_flag) OVER (PARTITION BY lang) AS commits FROM c)
        SELECT lang, doc_id, chunk_index, (seen - commit_flag)::BIGINT AS txn
        FROM s WHERE seen - commit_flag < commits""",
    "txn_write_read": f"""
        SELECT doc_id % {WRITERS} AS writer, doc_id, chunk_index::INT AS chunk_index, sha1(data) AS data_sha1 FROM ({CHUNKS_SQL})
        WHERE NOT (doc_id % {WRITERS} = {ABORTED[0]} AND doc_id % {COMMIT_PERIOD} >= {COMMIT_PERIOD // 2})""",
    "training_export": """
        SELECT event_id, user_id AS device_id, ts AS timestamp, event_type, value AS temp_celsius FROM events""",
    "limit_sample": f"SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT {SAMPLE}",
}
