"""Registry frames: magic byte 0, four bytes of schema id, payload.

All of it is built-in column functions, so it stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_BYTES = 5


def checked_frame(frame: Column) -> Column:
    """The frame itself; fails on a missing magic byte or a cut header."""
    well_formed = (F.length(frame) >= HEADER_BYTES) & (
        F.substring(frame, 1, 1) == F.lit(b"\x00")
    )
    return F.when(frame.isNull() | well_formed, frame).otherwise(
        F.raise_error(F.concat(F.lit("not a registry frame: "), F.hex(F.substring(frame, 1, 16))))
    )


def schema_id(frame: Column) -> Column:
    """Schema id of a frame, NULL for NULL."""
    return F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("int")


def payload(frame: Column) -> Column:
    """What follows the header, whole, NULL for NULL."""
    return F.substring(frame, HEADER_BYTES + 1, 2**31 - 1)


def split_frames(messages: DataFrame) -> DataFrame:
    """Cut key and value into schema id and payload."""
    key, value = checked_frame(F.col("key")), checked_frame(F.col("value"))
    return messages.withColumns(
        {
            "keySchemaId": schema_id(key),
            "key": payload(key),
            "valueSchemaId": schema_id(value),
            "value": payload(value),
        }
    )


def frame(schema_id: Column, body: Column) -> Column:
    """Put a header in front of a payload."""
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id), 8, "0")))
    return F.concat(header, body)
