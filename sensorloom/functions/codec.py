"""Event bytes to typed columns and back: text, JSON, chunk header, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the chunk header: signed version byte, 3 reserved bytes, then two
# big-endian signed 16-bit integers (chunk index, final chunk index).
V1_VERSION = 1
V1_HEADER_BYTES = 8
V1_SLICE_OVERHEAD = 4096
HASH_BYTES = 6
CHECKSUM_BYTES = 4
CORRUPT = "_corrupt"


def decode_text(event: Column) -> Column:
    return F.decode(event, "UTF-8")


def decode_json(df: DataFrame, ddl: str, event: str = "event", mode: str = "PERMISSIVE") -> DataFrame:
    """Parse the JSON in the binary column ``event`` and put its fields beside the other columns."""
    parsed = F.from_json(decode_text(F.col(event)), ddl, {"mode": mode})
    others = [name for name in df.columns if name != event]
    return df.select(*others, parsed.alias("_parsed")).select(*others, "_parsed.*")


def decode_required(df: DataFrame, ddl: str, required: list[str], event: str = "event") -> DataFrame:
    """Like ``decode_json``, with a ``decode_error`` column: NULL, ``malformed`` or ``missing <field>``.

    A field with an explicit null is there.
    Good rows go on, the others to an error table; use ``require`` to fail the job instead.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(decode_text(F.col(event)), f"{ddl}, {CORRUPT} string", options)
    others = [name for name in df.columns if name != event]
    fields = StructType.fromDDL(ddl).fieldNames()
    present = F.json_object_keys(decode_text(F.col(event)))
    missing = F.coalesce(*[
        F.when(~F.array_contains("_present", name), F.lit(f"missing {name}")) for name in required
    ])
    error = F.when(F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull(), F.lit("malformed"))
    return (
        df.select(*others, parsed.alias("_parsed"), present.alias("_present"))
        .select(*others, *[f"_parsed.{name}" for name in fields],
                F.coalesce(error, missing).alias("decode_error"))
    )


def require(df: DataFrame) -> DataFrame:
    """Fail on the first row that ``decode_required`` marked."""
    checked = F.when(F.col("decode_error").isNotNull(), F.raise_error(F.col("decode_error")).cast("string"))
    return df.filter(checked.isNull()).drop("decode_error")


def encode_json(*columns: Column | str) -> Column:
    """UTF-8 JSON bytes of the columns; binary values become base64 text."""
    return F.encode(F.to_json(F.struct(*columns)), "UTF-8")


def _int16_hex(value: Column) -> Column:
    return F.lpad(F.hex(F.pmod(value.cast("int"), F.lit(65536))), 4, "0")


def _int16(data: Column, position: int) -> Column:
    unsigned = F.conv(F.hex(F.substring(data, position, 2)), 16, 10).cast("int")
    return F.when(unsigned > 32767, unsigned - 65536).otherwise(unsigned).cast("smallint")


def v1_event(chunk_index: Column, final_chunk_index: Column, payload: Column) -> Column:
    """Header and payload of one chunked event."""
    start = F.lit(f"{V1_VERSION:02X}000000")
    header = F.unhex(F.concat(start, _int16_hex(chunk_index), _int16_hex(final_chunk_index)))
    return F.concat(header, payload)


def v1_fields(event: Column) -> dict[str, Column]:
    """version, chunk_index, final_chunk_index and data of a chunked event."""
    version = F.conv(F.hex(F.substring(event, 1, 1)), 16, 10).cast("int")
    return {
        "version": F.when(version > 127, version - 256).otherwise(version).cast("tinyint"),
        "chunk_index": _int16(event, 5),
        "final_chunk_index": _int16(event, 7),
        "data": F.substring(event, V1_HEADER_BYTES + 1, 2**31 - 1),
    }


def with_checksum(data: Column) -> Column:
    """The payload behind its CRC32, as 4 big-endian bytes."""
    return F.concat(F.unhex(F.lpad(F.hex(F.crc32(data)), 2 * CHECKSUM_BYTES, "0")), data)


def checksum(data: Column) -> Column:
    """The stored CRC32 (unsigned)."""
    return F.conv(F.hex(F.substring(data, 1, CHECKSUM_BYTES)), 16, 10).cast("bigint")


def checked_payload(data: Column) -> Column:
    return F.substring(data, CHECKSUM_BYTES + 1, 2**31 - 1)


def is_checksum_correct(data: Column) -> Column:
    return (F.octet_length(data) >= CHECKSUM_BYTES) & (checksum(data) == F.crc32(checked_payload(data)))


def frame_hash(data: Column) -> Column:
    """The first 6 bytes of the SHA-1."""
    return F.substring(F.unhex(F.sha1(data)), 1, HASH_BYTES)


def is_hash_valid(data: Column, expected: Column) -> Column:
    return frame_hash(data) == expected


def iso_millis(timestamp: Column) -> Column:
    """UTC text, whatever the time zone of the session."""
    utc = F.to_utc_timestamp(timestamp, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def routing_key(camera: Column) -> Column:
    return camera.cast("string")
