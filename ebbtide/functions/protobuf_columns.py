"""Protobuf payloads to Arrow columns, with the Protobuf Python package.

Used where the Protobuf connector is not on the classpath. Fields that are not
set are NULL, and enums come out by name, as with the connector.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T


def first_message(descriptor_set: bytes):
    """Descriptor of the first message type of the last file of a set."""
    from google.protobuf import descriptor_pb2, descriptor_pool

    files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set).file
    pool = descriptor_pool.DescriptorPool()
    for file in files:
        pool.Add(file)
    name = files[-1].message_type[0].name
    return pool.FindMessageTypeByName(".".join(filter(None, [files[-1].package, name])))


def _is_map(field) -> bool:
    return field.message_type is not None and field.message_type.GetOptions().map_entry


def protobuf_type(descriptor_set: bytes) -> T.StructType:
    """Spark type of the first message type of a descriptor set."""
    from google.protobuf.descriptor import FieldDescriptor as Fd

    simple = {
        Fd.CPPTYPE_INT32: T.IntegerType(),
        Fd.CPPTYPE_INT64: T.LongType(),
        Fd.CPPTYPE_UINT32: T.IntegerType(),
        Fd.CPPTYPE_UINT64: T.LongType(),
        Fd.CPPTYPE_FLOAT: T.FloatType(),
        Fd.CPPTYPE_DOUBLE: T.DoubleType(),
        Fd.CPPTYPE_BOOL: T.BooleanType(),
        Fd.CPPTYPE_ENUM: T.StringType(),
    }

    def of_value(field) -> T.DataType:
        if field.message_type is not None:
            return of_message(field.message_type)
        if field.cpp_type == Fd.CPPTYPE_STRING:
            return T.BinaryType() if field.type == Fd.TYPE_BYTES else T.StringType()
        return simple[field.cpp_type]

    def of_field(field) -> T.DataType:
        if _is_map(field):
            entry = field.message_type.fields_by_name
            return T.MapType(of_value(entry["key"]), of_value(entry["value"]))
        return T.ArrayType(of_value(field)) if field.is_repeated else of_value(field)

    def of_message(message) -> T.StructType:
        return T.StructType([T.StructField(f.name, of_field(f)) for f in message.fields])

    return of_message(first_message(descriptor_set))


def decode(payloads: pa.Array, descriptor_set: bytes, target: pa.DataType) -> pa.Array:
    """Decode payloads of one descriptor set; malformed payloads fail.

    A registry frame names the message type by its position between header and
    message; one zero byte is the first type, the only one accepted.
    """
    from google.protobuf import message_factory

    make = message_factory.GetMessageClass(first_message(descriptor_set))

    def value(field, v):
        if field.message_type is not None:
            return row(v)
        if field.enum_type is not None:
            named = field.enum_type.values_by_number.get(v)
            return named.name if named else str(v)
        return v

    def row(message) -> dict:
        out = {}
        for field, v in message.ListFields():
            if _is_map(field):
                inner = field.message_type.fields_by_name["value"]
                out[field.name] = [(k, value(inner, v[k])) for k in v]
            elif field.is_repeated:
                out[field.name] = [value(field, item) for item in v]
            else:
                out[field.name] = value(field, v)
        return out

    def parse(payload: bytes) -> dict:
        if payload[:1] != b"\x00":
            raise ValueError("only the first message type of a file is supported")
        return row(make.FromString(payload[1:]))

    return pa.array([parse(p) for p in payloads.to_pylist()], target)
