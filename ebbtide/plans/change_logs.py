"""Change logs derived from plain tables, decoded or as captured messages."""

from __future__ import annotations

import base64
import json
import struct
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.frames import frame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOPIC = "dbserver1.inventory.products"

_VALUE_FIELDS = [
    {"name": "id", "type": "long"},
    {"name": "name", "type": "string"},
    {"name": "weight", "type": "double"},
    {"name": "description", "type": "string"},
]
_REVISION = {"name": "revision", "type": ["null", "long"]}


def _envelope(fields: list[dict]) -> str:
    image = {"type": "record", "name": "Value", "fields": fields}
    return json.dumps(
        {
            "type": "record",
            "name": "Envelope",
            "fields": [
                {"name": "before", "type": ["null", image]},
                {"name": "after", "type": ["null", "Value"]},
                {"name": "op", "type": "string"},
            ],
        }
    )


# The schemas the messages are written with, by registry id.
AVRO_SCHEMAS = {
    1: json.dumps({"type": "record", "name": "Key", "fields": [{"name": "id", "type": "long"}]}),
    2: _envelope(_VALUE_FIELDS),
    3: _envelope([*_VALUE_FIELDS, _REVISION]),
}


def _connect_struct(fields: dict[str, str]) -> dict:
    return {
        "type": "struct",
        "optional": True,
        "fields": [{"field": name, "type": t, "optional": True} for name, t in fields.items()],
    }


def _connect_envelope(fields: dict[str, str]) -> str:
    images = [{**_connect_struct(fields), "field": name} for name in ("before", "after")]
    op = {"field": "op", "type": "string", "optional": True}
    return json.dumps({"type": "struct", "optional": False, "fields": [*images, op]})


_CONNECT_FIELDS = {"id": "int64", "name": "string", "weight": "double", "description": "string"}
CONNECT_KEY = json.dumps(_connect_struct({"id": "int64"}))
CONNECT_VALUES = {
    2: _connect_envelope(_CONNECT_FIELDS),
    3: _connect_envelope({**_CONNECT_FIELDS, "revision": "int64"}),
}


def event_changes(events: DataFrame) -> DataFrame:
    """One change of a product, keyed by user, per event.

    Every second row is written with a schema that has one more column.
    """
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "view", "r")
        .otherwise("u")
    )
    wide = F.col("event_id") % 2 == 1
    image = F.struct(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("weight"),
        F.col("props").alias("description"),
        F.when(wide, F.col("event_id")).alias("revision"),
    )
    return events.select(
        F.struct(F.col("user_id").alias("id")).alias("key"),
        F.struct(
            F.when(op.isin("u", "d"), image).alias("before"),
            F.when(op != "d", image).alias("after"),
            op.alias("op"),
        ).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.lit(1).alias("keySchemaId"),
        F.when(wide, 3).otherwise(2).alias("valueSchemaId"),
    )


def _varint(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _avro_text(text: str) -> bytes:
    body = text.encode()
    return _varint(len(body)) + body


@F.pandas_udf(T.BinaryType())
def _avro_long(values: pd.Series) -> pd.Series:
    return values.map(_varint)


@F.pandas_udf(T.BinaryType())
def _avro_image(
    ids: pd.Series, names: pd.Series, weights: pd.Series, descriptions: pd.Series
) -> pd.Series:
    rows = zip(ids, names, weights, descriptions)
    return pd.Series(
        [_varint(i) + _avro_text(n) + struct.pack("<d", w) + _avro_text(d) for i, n, w, d in rows]
    )


def _messages(changes: DataFrame, key: Column, value: Column) -> DataFrame:
    """Columns of captured messages, with the key and value given."""
    return changes.select(
        key.alias("key"),
        value.alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        "timestampType",
    )


def avro_messages(changes: DataFrame) -> DataFrame:
    """Changes of event_changes as framed Avro messages."""
    some = F.coalesce("value.after", "value.before")
    wide = F.col("valueSchemaId") == 3
    image = F.concat(
        _avro_image(*[some.getField(f["name"]) for f in _VALUE_FIELDS]),
        F.when(wide, F.concat(F.lit(b"\x02"), _avro_long(F.coalesce(some["revision"], F.lit(0))))).otherwise(
            F.lit(b"")
        ),
    )

    def branch(side: str) -> Column:
        here = F.col(f"value.{side}").isNotNull()
        return F.when(here, F.concat(F.lit(b"\x02"), image)).otherwise(F.lit(b"\x00"))

    op = F.concat(F.lit(b"\x02"), F.col("value.op").cast("binary"))
    return _messages(
        changes,
        frame(F.col("keySchemaId"), _avro_long(F.col("key.id"))),
        frame(F.col("valueSchemaId"), F.concat(branch("before"), branch("after"), op)),
    )


def _tagged(number: int, kind: int, body: bytes) -> bytes:
    return bytes([number << 3 | kind]) + body


def _plain_varint(n: int) -> bytes:
    n, out = n % 2**64, bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _sized(body: bytes) -> bytes:
    return _plain_varint(len(body)) + body


@F.pandas_udf(T.BinaryType())
def _protobuf_key(ids: pd.Series) -> pd.Series:
    return ids.map(lambda i: _tagged(1, 0, _plain_varint(i)))


@F.pandas_udf(T.BinaryType())
def _protobuf_value(
    ids: pd.Series, names: pd.Series, weights: pd.Series, descriptions: pd.Series, ops: pd.Series
) -> pd.Series:
    def value(i, name, weight, description, op) -> bytes:
        image = (
            _tagged(1, 0, _plain_varint(i))
            + _tagged(2, 2, _sized(name.encode()))
            + _tagged(3, 1, struct.pack("<d", weight))
            + _tagged(4, 2, _sized(description.encode()))
        )
        before = _tagged(1, 2, _sized(image)) if op in "ud" else b""
        after = _tagged(2, 2, _sized(image)) if op != "d" else b""
        return before + after + _tagged(3, 2, _sized(op.encode()))

    rows = zip(ids, names, weights, descriptions, ops)
    return pd.Series([value(*row) for row in rows])


def protobuf_schemas() -> dict[int, str]:
    """Descriptor sets of the Protobuf messages, in base 64, by registry id."""
    from google.protobuf import descriptor_pb2

    kinds = descriptor_pb2.FieldDescriptorProto
    scalar = {"long": kinds.TYPE_INT64, "string": kinds.TYPE_STRING, "double": kinds.TYPE_DOUBLE}

    def message(name: str, fields: dict[str, str]):
        out = descriptor_pb2.DescriptorProto(name=name)
        for number, (field, kind) in enumerate(fields.items(), 1):
            made = out.field.add(name=field, number=number, label=kinds.LABEL_OPTIONAL)
            if kind in scalar:
                made.type = scalar[kind]
            else:
                made.type, made.type_name = kinds.TYPE_MESSAGE, f".{kind}"
        return out

    def in_base_64(file: str, *messages) -> str:
        made = descriptor_pb2.FileDescriptorProto(name=file, syntax="proto2")
        made.message_type.extend(messages)
        data = descriptor_pb2.FileDescriptorSet(file=[made]).SerializeToString()
        return base64.b64encode(data).decode()

    envelope = message("Envelope", {"before": "Value", "after": "Value", "op": "string"})
    image = message("Value", {f["name"]: f["type"] for f in _VALUE_FIELDS})
    return {
        1: in_base_64("key.proto", message("Key", {"id": "long"})),
        2: in_base_64("value.proto", envelope, image),
    }


def protobuf_messages(changes: DataFrame) -> DataFrame:
    """Changes of event_changes, without the extra column, as framed Protobuf."""
    some = F.coalesce("value.after", "value.before")
    image = [some.getField(f["name"]) for f in _VALUE_FIELDS]
    first = F.lit(b"\x00")
    value = _protobuf_value(*image, F.col("value.op"))
    return _messages(
        changes,
        frame(F.lit(1), F.concat(first, _protobuf_key(F.col("key.id")))),
        frame(F.lit(2), F.concat(first, value)),
    )


def json_messages(changes: DataFrame) -> DataFrame:
    """Changes of event_changes as JSON messages that carry their schema."""

    def message(schema: Column, payload: Column) -> Column:
        parts = [F.lit('{"schema":'), schema, F.lit(',"payload":'), F.to_json(payload), F.lit("}")]
        return F.concat(*parts).cast("binary")

    wide = F.col("valueSchemaId") == 3
    value_schema = F.when(wide, CONNECT_VALUES[3]).otherwise(CONNECT_VALUES[2])
    return _messages(
        changes,
        message(F.lit(CONNECT_KEY), F.col("key")),
        message(value_schema, F.col("value")),
    )


def order_changes(lineitem: DataFrame) -> DataFrame:
    """Changes of orders, one per line: new status, price and date."""
    op = (
        F.when(F.col("l_returnflag") == "R", "d")
        .when(F.col("l_returnflag") == "A", "u")
        .otherwise("c")
    )
    return lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_suppkey").alias("o_custkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
        op.alias("op"),
        *[c for c in lineitem.columns if c != "l_orderkey"],
    )


LINE_ORDER = (
    "l_shipdate",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
