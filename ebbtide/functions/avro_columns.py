"""Column-at-a-time Avro decoding inside an Arrow task.

Used where the Avro connector is not on the classpath. One Arrow batch is
decoded field by field: every step advances a cursor per row with numpy, so
the Python cost is per field and batch, not per row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa

from ebbtide.functions.schemas import avro_node, resolve_avro

_NTZ = {"local-timestamp-millis": 1000, "local-timestamp-micros": 1}
_UTC = {"timestamp-millis": 1000, "timestamp-micros": 1}


class Cursors:
    """One read position per payload of a binary array."""

    def __init__(self, payloads: pa.Array):
        payloads = payloads.cast(pa.large_binary())
        offsets = np.frombuffer(payloads.buffers()[1], dtype=np.int64)
        offsets = offsets[payloads.offset : payloads.offset + len(payloads) + 1]
        data = payloads.buffers()[2]
        self.data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
        self.at, self.end = offsets[:-1].copy(), offsets[1:]

    def take(self, rows: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        """Start positions of the next ``sizes`` bytes; moves past them."""
        start = self.at[rows]
        if np.any(sizes < 0) or np.any(start + sizes > self.end[rows]):
            raise ValueError("malformed Avro payload: it ends too early")
        self.at[rows] = start + sizes
        return start

    def longs(self, rows: np.ndarray) -> np.ndarray:
        value = np.zeros(len(rows), np.uint64)
        active = np.arange(len(rows))
        for shift in range(0, 70, 7):
            byte = self.data[self.take(rows[active], 1)].astype(np.uint64)
            value[active] |= (byte & np.uint64(0x7F)) << np.uint64(shift)
            active = active[byte >= 0x80]
            if not len(active):
                return (value >> np.uint64(1)).astype(np.int64) ^ -(
                    value & np.uint64(1)
                ).astype(np.int64)
        raise ValueError("malformed Avro payload: number too long")

    def fixed(self, rows: np.ndarray, size: int) -> np.ndarray:
        start = self.take(rows, size)
        return self.data[start[:, None] + np.arange(size)]

    def blobs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, bytes) of length-prefixed values."""
        sizes = self.longs(rows)
        start = self.take(rows, sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(start - offsets[:-1], sizes) + np.arange(offsets[-1])
        return offsets, self.data[where]


def decode(payloads: pa.Array, schema: str) -> pa.Array:
    """Decode payloads that were all written with one schema."""
    root, named = resolve_avro(schema)
    cursors = Cursors(payloads)

    def logical(ints: np.ndarray, node: dict) -> pa.Array:
        kind = node.get("logicalType")
        if kind == "date" and ints.dtype == np.int32:
            return pa.array(ints).cast(pa.date32())
        if kind in _NTZ and ints.dtype == np.int64:
            return pa.array(ints * _NTZ[kind]).cast(pa.timestamp("us"))
        if kind in _UTC and ints.dtype == np.int64:
            return pa.array(ints * _UTC[kind]).cast(pa.timestamp("us", tz="UTC"))
        return pa.array(ints)

    def decimals(values: pa.Array, node: dict) -> pa.Array:
        precision, scale = node["precision"], node.get("scale", 0)
        with localcontext() as context:
            context.prec = 38
            numbers = [
                Decimal(int.from_bytes(v, "big", signed=True)).scaleb(-scale)
                for v in values.to_pylist()
            ]
        return pa.array(numbers, pa.decimal128(precision, scale))

    def binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        if offsets[-1] >= 2**31:
            raise ValueError("more than 2 GiB in one batch: lower maxRecordsPerBatch")
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)

    def text(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        return binary(offsets, data).cast(pa.string())  # checks UTF-8

    def items(rows: np.ndarray, read) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
        """Blocks of an array or map: (list offsets, decoded parts, order)."""
        parts, owners, counts = [], [], np.zeros(len(rows), np.int64)
        open_rows = np.arange(len(rows))
        while len(open_rows):
            left = cursors.longs(rows[open_rows])
            sized = left < 0
            if sized.any():
                cursors.longs(rows[open_rows[sized]])
                left = np.abs(left)
            open_rows, left = open_rows[left > 0], left[left > 0]
            counts[open_rows] += left
            current = open_rows
            while len(current):
                parts.append(read(rows[current]))
                owners.append(current)
                left = left - 1
                current, left = current[left > 0], left[left > 0]
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        order = np.argsort(np.concatenate(owners), kind="stable") if owners else np.empty(0, int)
        return offsets, parts, order

    def in_order(parts: list[pa.Array], order: np.ndarray, empty) -> pa.Array:
        return pa.concat_arrays(parts).take(pa.array(order)) if parts else empty()

    def read(node, rows: np.ndarray) -> pa.Array:
        kind, node = avro_node(node, named)
        if kind == "null":
            return pa.nulls(len(rows))
        if kind == "boolean":
            return pa.array(cursors.fixed(rows, 1)[:, 0] != 0)
        if kind in ("int", "long"):
            values = cursors.longs(rows)
            if kind == "int":
                if np.any(values != values.astype(np.int32)):
                    raise ValueError("malformed Avro payload: int out of range")
                values = values.astype(np.int32)
            return logical(values, node)
        if kind in ("float", "double"):
            size = 4 if kind == "float" else 8
            return pa.array(cursors.fixed(rows, size).copy().view(f"<f{size}")[:, 0])
        if kind == "string":
            return text(*cursors.blobs(rows))
        if kind == "bytes":
            values = binary(*cursors.blobs(rows))
            return decimals(values, node) if node.get("logicalType") == "decimal" else values
        if kind == "fixed":
            size = node["size"]
            data = cursors.fixed(rows, size)
            values = binary(np.arange(len(rows) + 1) * size, np.ascontiguousarray(data).ravel())
            return decimals(values, node) if node.get("logicalType") == "decimal" else values
        if kind == "enum":
            index = cursors.longs(rows)
            if np.any((index < 0) | (index >= len(node["symbols"]))):
                raise ValueError("malformed Avro payload: unknown enum symbol")
            return pa.array(node["symbols"], pa.string()).take(pa.array(index))
        if kind == "union":
            return union(node, rows)
        if kind == "record":
            columns = [read(f["type"], rows) for f in node["fields"]]
            fields = [pa.field(f["name"], c.type) for f, c in zip(node["fields"], columns)]
            return (
                pa.StructArray.from_arrays(columns, fields=fields)
                if fields
                else pa.array([{}] * len(rows), pa.struct([]))
            )
        if kind == "array":
            offsets, parts, order = items(rows, lambda r: read(node["items"], r))
            values = in_order(parts, order, lambda: read(node["items"], np.empty(0, np.int64)))
            return pa.ListArray.from_arrays(pa.array(offsets), values)
        if kind == "map":

            def entry(r: np.ndarray) -> pa.Array:
                pair = [text(*cursors.blobs(r)), read(node["values"], r)]
                return pa.StructArray.from_arrays(pair, names=["key", "value"])

            offsets, parts, order = items(rows, entry)
            pairs = in_order(parts, order, lambda: entry(np.empty(0, np.int64)))
            return pa.MapArray.from_arrays(pa.array(offsets), pairs.field(0), pairs.field(1))
        raise ValueError(f"unknown Avro type {kind!r}")

    def union(branches: list, rows: np.ndarray) -> pa.Array:
        index = cursors.longs(rows)
        if np.any((index < 0) | (index >= len(branches))):
            raise ValueError("malformed Avro payload: unknown union branch")
        chosen = [b for b in branches if b != "null"]
        if len(chosen) != 1:
            raise ValueError(f"only unions of null and one type are supported: {branches}")
        present = index == branches.index(chosen[0])
        values = read(chosen[0], rows[present])
        where = np.cumsum(present) - 1
        return values.take(pa.array(where, mask=~present))

    return read(root, np.arange(len(payloads)))


def widen(values: pa.Array, target: pa.DataType) -> pa.Array:
    """Bring decoded values to a merged type; fields they lack become NULL."""
    if values.type == target:
        return values
    if pa.types.is_struct(target):
        columns = []
        for f in target:
            at = values.type.get_field_index(f.name)
            columns.append(
                widen(values.field(at), f.type) if at >= 0 else pa.nulls(len(values), f.type)
            )
        mask = values.is_null() if values.null_count else None
        return pa.StructArray.from_arrays(columns, fields=list(target), mask=mask)
    if pa.types.is_list(target) and pa.types.is_list(values.type):
        items = widen(values.values, target.value_type)
        mask = values.is_null() if values.null_count else None
        return pa.ListArray.from_arrays(values.offsets, items, type=target, mask=mask)
    if pa.types.is_map(target) and pa.types.is_map(values.type):
        items = widen(values.items, target.item_type)
        mask = values.is_null() if values.null_count else None
        return pa.MapArray.from_arrays(
            values.offsets, values.keys, items, type=target, mask=mask
        )
    return values.cast(target)


def decode_by_id(
    ids: pa.Array,
    payloads: pa.Array,
    decoders: Mapping[int, Callable[[pa.Array], pa.Array]],
    target: pa.DataType,
) -> pa.Array:
    """Decode each payload with the decoder of its schema id, all to one type."""
    present = payloads.is_valid().to_numpy(zero_copy_only=False)
    schema_ids = ids.fill_null(-1).to_numpy(zero_copy_only=False)
    parts, rows = [], []
    for schema_id in np.unique(schema_ids[present]):
        if int(schema_id) not in decoders:
            raise ValueError(f"schema id {schema_id} is not registered")
        chosen = np.flatnonzero(present & (schema_ids == schema_id))
        decoded = decoders[int(schema_id)](payloads.take(pa.array(chosen)))
        parts.append(widen(decoded, target))
        rows.append(chosen)
    if not parts:
        return pa.nulls(len(payloads), target)
    where = np.zeros(len(payloads), np.int64)
    where[np.concatenate(rows)] = np.arange(present.sum())
    return pa.concat_arrays(parts).take(pa.array(where, mask=~present))
