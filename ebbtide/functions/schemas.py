"""Registered schemas as Spark types, and additive merging of those types."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AVRO_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

AVRO_LOGICAL = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}

CONNECT_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}


def resolve_avro(schema: str):
    """Avro JSON text to (schema, named types by full name)."""
    named: dict[str, dict] = {}

    def collect(node, namespace):
        if isinstance(node, list):
            for branch in node:
                collect(branch, namespace)
        elif isinstance(node, dict):
            if node["type"] in ("record", "enum", "fixed"):
                namespace = node.get("namespace", namespace)
                named[node["name"]] = node
                if namespace and "." not in node["name"]:
                    named[f"{namespace}.{node['name']}"] = node
                for field in node.get("fields", []):
                    collect(field["type"], namespace)
            else:
                for part in ("type", "items", "values"):
                    if isinstance(node.get(part), (dict, list)):
                        collect(node[part], namespace)

    root = json.loads(schema) if schema.lstrip()[:1] in '{["' else schema
    collect(root, None)
    return root, named


def avro_node(node, named: dict[str, dict]):
    """(kind, node) of one schema node, with names and wrappers resolved."""
    if isinstance(node, list):
        return "union", node
    if isinstance(node, str):
        if node in AVRO_PRIMITIVES:
            return node, {"type": node}
        if node not in named:
            raise ValueError(f"unknown Avro type {node!r}")
        node = named[node]
    if isinstance(node["type"], (dict, list)):
        return avro_node(node["type"], named)
    if node["type"] not in AVRO_PRIMITIVES and node["type"] in named:
        return avro_node(node["type"], named)
    return node["type"], node


def avro_type(schema: str) -> T.DataType:
    """Spark type of an Avro schema."""
    root, named = resolve_avro(schema)

    def convert(node) -> T.DataType:
        kind, node = avro_node(node, named)
        if kind == "union":
            branches = [b for b in node if b != "null"]
            if len(branches) != 1:
                raise ValueError(f"only unions of null and one type are supported: {node}")
            return convert(branches[0])
        if kind == "record":
            return T.StructType(
                [T.StructField(f["name"], convert(f["type"])) for f in node["fields"]]
            )
        if kind == "array":
            return T.ArrayType(convert(node["items"]))
        if kind == "map":
            return T.MapType(T.StringType(), convert(node["values"]))
        if kind == "enum":
            return T.StringType()
        logical = node.get("logicalType")
        if logical == "decimal":
            return T.DecimalType(node["precision"], node.get("scale", 0))
        if kind == "fixed":
            return T.BinaryType()
        if kind not in AVRO_PRIMITIVES:
            raise ValueError(f"unknown Avro type {kind!r}")
        return AVRO_LOGICAL.get((kind, logical), AVRO_PRIMITIVES[kind])

    return convert(root)


def connect_type(schema: str) -> T.DataType:
    """Spark type of the schema text a JSON converter puts next to a payload."""

    def convert(node) -> T.DataType:
        kind = node["type"]
        if kind == "struct":
            return T.StructType([T.StructField(f["field"], convert(f)) for f in node["fields"]])
        if kind == "array":
            return T.ArrayType(convert(node["items"]))
        if kind == "map":
            return T.MapType(convert(node["keys"]), convert(node["values"]))
        if kind not in CONNECT_PRIMITIVES:
            raise ValueError(f"unknown schema type {kind!r}")
        return CONNECT_PRIMITIVES[kind]

    return convert(json.loads(schema))


# What each type can be stored as without loss, beside itself; Spark reads Parquet
# files of the narrower type as the wider one.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether one type holds all values of another."""
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        whole = wide.precision - wide.scale >= narrow.precision - narrow.scale
        return whole and wide.scale >= narrow.scale
    return wide == narrow or wide.simpleString() in _WIDER.get(narrow.simpleString(), ())


def merge_types(types: list[T.DataType], widen: bool = False) -> T.DataType:
    """One type holding the fields of all; the same field must agree in type.

    With ``widen``, it is enough that one of the types holds all values of the other.
    """

    def merge(left: T.DataType, right: T.DataType) -> T.DataType:
        if isinstance(left, T.StructType) and isinstance(right, T.StructType):
            merged = {f.name: f.dataType for f in left}
            for f in right:
                merged[f.name] = merge(merged[f.name], f.dataType) if f.name in merged else f.dataType
            return T.StructType([T.StructField(name, t) for name, t in merged.items()])
        if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
            return T.ArrayType(merge(left.elementType, right.elementType))
        if isinstance(left, T.MapType) and isinstance(right, T.MapType):
            return T.MapType(
                merge(left.keyType, right.keyType), merge(left.valueType, right.valueType)
            )
        for wide, narrow in ((left, right), (right, left)):
            if wide == narrow or widen and holds(wide, narrow):
                return wide
        raise ValueError(f"schemas disagree: {left.simpleString()} and {right.simpleString()}")

    return reduce(merge, types)


def align(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Widen a column to a merged type; fields it lacks become NULL."""
    if source == target:
        return value
    if isinstance(target, T.StructType):
        have = {f.name: f.dataType for f in source}
        fields = [
            (
                align(value.getField(f.name), have[f.name], f.dataType)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(value, lambda v: align(v, source.elementType, target.elementType))
    if isinstance(target, T.MapType):
        return F.transform_values(value, lambda _, v: align(v, source.valueType, target.valueType))
    return value.cast(target)
