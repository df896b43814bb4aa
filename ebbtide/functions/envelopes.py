"""Decoding of message keys and values into structs."""

from __future__ import annotations

import base64
from collections.abc import Callable, Mapping
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.protobuf.functions import from_protobuf

from ebbtide.functions import avro_columns, protobuf_columns, schemas

# The decoders travel with their functions, so executors need no installed copy.
for _module in (avro_columns, protobuf_columns, schemas):
    cloudpickle.register_pickle_by_value(_module)

KAFKA_COLUMNS = ["topic", "partition", "offset", "timestamp", "timestampType"]


def _loaded(spark: SparkSession, decoded: Callable[[], Column]) -> bool:
    try:
        spark.range(0).select(decoded()).schema
        return True
    except AnalysisException:
        return False


def avro_connector_loaded(spark: SparkSession) -> bool:
    return _loaded(spark, lambda: from_avro(F.lit(b""), '"int"'))


def protobuf_connector_loaded(spark: SparkSession, descriptor_set: bytes) -> bool:
    name = protobuf_columns.first_message(descriptor_set).full_name
    return _loaded(
        spark, lambda: from_protobuf(F.lit(b""), name, binaryDescriptorSet=descriptor_set)
    )


def _decode_by_id(
    schema_id: Column,
    payload: Column,
    types: Mapping[int, T.DataType],
    connector: Callable[[int], Column] | None,
    decoder: Callable[[int], Callable[[pa.Array], pa.Array]],
) -> Column:
    """One column of the merged type: by the connector, or else in Arrow batches."""
    merged = schemas.merge_types(list(types.values()))
    if connector is not None:
        decoded = F.when(payload.isNull(), F.lit(None).cast(merged))
        for i, t in types.items():
            decoded = decoded.when(schema_id == i, schemas.align(connector(i), t, merged))
        return decoded.otherwise(
            F.raise_error(F.concat(F.lit("schema id is not registered: "), schema_id))
        )
    decoders, arrow_type = {i: decoder(i) for i in types}, to_arrow_type(merged)

    @F.arrow_udf(merged)
    def decode(ids: pa.Array, payloads: pa.Array) -> pa.Array:
        return avro_columns.decode_by_id(ids, payloads, decoders, arrow_type)

    return decode(schema_id, payload)


def decode_avro(
    spark: SparkSession, schema_id: Column, payload: Column, by_id: Mapping[int, str]
) -> Column:
    """Decode a payload with the schema its id names.

    All rows come out as one struct that holds the fields of every schema in
    ``by_id``, so a batch of many schema ids takes one pass. Malformed payloads
    and ids outside ``by_id`` fail.
    """
    return _decode_by_id(
        schema_id,
        payload,
        {i: schemas.avro_type(text) for i, text in by_id.items()},
        (lambda i: from_avro(payload, by_id[i], {"mode": "FAILFAST"}))
        if avro_connector_loaded(spark)
        else None,
        lambda i: partial(avro_columns.decode, schema=by_id[i]),
    )


def decode_protobuf(
    spark: SparkSession, schema_id: Column, payload: Column, by_id: Mapping[int, str]
) -> Column:
    """As decode_avro; schemas are descriptor sets in base 64.

    The message is the first type of the last file of a set.
    """
    sets = {i: base64.b64decode(text) for i, text in by_id.items()}
    types = {i: protobuf_columns.protobuf_type(data) for i, data in sets.items()}

    def by_connector(i: int) -> Column:
        # Between header and message stands the position of the message type.
        first = F.substring(payload, 1, 1) == F.lit(b"\x00")
        body = F.when(first, F.substring(payload, 2, 2**31 - 1)).otherwise(
            F.raise_error(F.lit("only the first message type of a file is supported"))
        )
        name = protobuf_columns.first_message(sets[i]).full_name
        options = {"mode": "FAILFAST"}
        return from_protobuf(body, name, binaryDescriptorSet=sets[i], options=options)

    loaded = all(protobuf_connector_loaded(spark, data) for data in sets.values())
    return _decode_by_id(
        schema_id,
        payload,
        types,
        by_connector if loaded else None,
        lambda i: partial(
            protobuf_columns.decode, descriptor_set=sets[i], target=to_arrow_type(types[i])
        ),
    )


FRAME_DECODERS = {"avro": decode_avro, "protobuf": decode_protobuf}


def decode_frames(
    spark: SparkSession,
    messages: DataFrame,
    key_schemas: Mapping[int, str],
    value_schemas: Mapping[int, str],
    content_type: str = "avro",
) -> DataFrame:
    """Split frames (see frames.split_frames) to staged rows."""
    decode = FRAME_DECODERS[content_type]
    key = decode(spark, F.col("keySchemaId"), F.col("key"), key_schemas)
    value = decode(spark, F.col("valueSchemaId"), F.col("value"), value_schemas)
    return messages.select(
        key.alias("key"), value.alias("value"), *KAFKA_COLUMNS, "keySchemaId", "valueSchemaId"
    )


#: How a message begins whose schema can be cut out, and what follows the schema.
_SCHEMA, _PAYLOAD = '{"schema":', ',"payload":'


def json_schema_text(message: Column) -> Column:
    """Schema text of a self-describing JSON message."""
    return decode_json(message)["schema"]


def json_schema_cut(message: Column) -> Column:
    """Schema text of a self-describing JSON message, cut out without parsing where it can be.

    That is where the message begins with its schema and has its payload next, without
    blanks. A schema that itself has a field of that name is cut short: such a
    text has an open bracket, so it is no JSON.
    """
    text = message.cast("string")
    cut = F.substring(F.substring_index(text, _PAYLOAD, 1), len(_SCHEMA) + 1, 2**31 - 1)
    plain = text.startswith(_SCHEMA) & text.contains(_PAYLOAD)
    return F.when(plain, F.nullif(cut, F.lit("null"))).otherwise(json_schema_text(message))


def decode_json(message: Column, payload_type: T.DataType | None = None) -> Column:
    """Self-describing JSON message to struct(payload) or, without a payload type, struct(schema).

    The schema stays text. What is not asked for is skipped, not copied.
    """
    if payload_type is None:
        envelope = T.StructType([T.StructField("schema", T.StringType())])
    else:
        envelope = T.StructType([T.StructField("payload", payload_type)])
    return F.from_json(message.cast("string"), envelope, {"mode": "FAILFAST"})


def decode_json_messages(
    messages: DataFrame, key_schemas: list[str], value_schemas: list[str]
) -> DataFrame:
    """JSON messages to staged rows; the schema texts stay as columns.

    A field that only some of the schemas have is NULL in the other rows; one whose
    type differs has the type that holds all its values.
    """
    key_type = schemas.merge_types([schemas.connect_type(s) for s in key_schemas], widen=True)
    value_type = schemas.merge_types([schemas.connect_type(s) for s in value_schemas], widen=True)
    # Schema texts that are there already are not read from the messages again.
    schema_of = {
        name: F.col(name) if name in messages.columns else json_schema_text(F.col(of))
        for name, of in (("keySchema", "key"), ("valueSchema", "value"))
    }
    return messages.select(
        decode_json(F.col("key"), key_type)["payload"].alias("key"),
        decode_json(F.col("value"), value_type)["payload"].alias("value"),
        *KAFKA_COLUMNS,
        *(text.alias(name) for name, text in schema_of.items()),
    )
