import base64
import json
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.envelopes import decode_avro, decode_frames, decode_json_messages, json_schema_cut
from ebbtide.functions.frames import frame, split_frames
from ebbtide.functions.protobuf_columns import first_message
from ebbtide.functions.schemas import align, avro_type, connect_type, merge_types
from ebbtide.streaming.curate import read_curated
from ebbtide.plans.pipeline import run_table
from ebbtide.sources.capture import captured_messages
from ebbtide.streaming.stage import decode_batch
from tests.helpers import (
    KEY_SCHEMA,
    REF,
    SAMPLE_KEY,
    SAMPLE_VALUE,
    VALUE_SCHEMA,
    encode_with_library,
    messages,
    new_lake,
    rows,
)


def test_sample_frame(spark):
    split = split_frames(messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1)]))
    row = decode_frames(spark, split, {1: KEY_SCHEMA}, {2: VALUE_SCHEMA}).first()
    assert row.key.id == 1001
    assert row.value.before is None
    assert tuple(row.value.after) == (1001, "ab", 2.5)
    assert row.value.op == "c"
    assert (row.keySchemaId, row.valueSchemaId) == (1, 2)


def test_null_and_long_key(spark):
    long_key = b"\x00\x00\x00\x01\x07" + b"k" * 100
    split = split_frames(messages(spark, [(long_key, None, 1), (None, None, 2)]))
    first, second = split.orderBy("offset").collect()
    assert (first.keySchemaId, bytes(first.key)) == (263, b"k" * 100)
    assert (first.valueSchemaId, first.value) == (None, None)
    assert (second.keySchemaId, second.key) == (None, None)


@pytest.mark.parametrize("key", [b"\x01\x00\x00\x00\x01\x02", b"\x00\x00\x01", b""])
def test_bad_frame(spark, key):
    with pytest.raises(Exception, match="not a registry frame"):
        split_frames(messages(spark, [(key, SAMPLE_VALUE, 1)])).collect()


@pytest.mark.parametrize("cut", [SAMPLE_VALUE[:-1], SAMPLE_VALUE[:12], SAMPLE_VALUE[:5]])
def test_cut_payload(spark, cut):
    split = split_frames(messages(spark, [(SAMPLE_KEY, cut, 1)]))
    with pytest.raises(Exception, match="ends too early"):
        decode_frames(spark, split, {1: KEY_SCHEMA}, {2: VALUE_SCHEMA}).collect()


def test_unregistered_id(spark):
    split = split_frames(messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1)]))
    with pytest.raises(Exception, match="not registered"):
        decode_frames(spark, split, {1: KEY_SCHEMA}, {3: VALUE_SCHEMA}).collect()


WIDE = {
    "type": "record",
    "name": "Wide",
    "namespace": "a.b",
    "fields": [
        {"name": "flag", "type": "boolean"},
        {"name": "small", "type": "int"},
        {"name": "big", "type": "long"},
        {"name": "f", "type": "float"},
        {"name": "d", "type": ["double", "null"]},
        {"name": "raw", "type": "bytes"},
        {"name": "text", "type": ["null", "string"]},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["A", "B", "C"]}},
        {"name": "again", "type": ["null", "a.b.Kind"]},
        {"name": "tag", "type": {"type": "fixed", "name": "Tag", "size": 3}},
        {"name": "list", "type": {"type": "array", "items": ["null", "long"]}},
        {"name": "deep", "type": {"type": "array", "items": {"type": "array", "items": "string"}}},
        {"name": "map", "type": {"type": "map", "values": "int"}},
        {
            "name": "inner",
            "type": [
                "null",
                {"type": "record", "name": "In", "fields": [{"name": "x", "type": "int"}]},
            ],
        },
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "local", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {
            "name": "money",
            "type": {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2},
        },
    ],
}


def wide_row(i: int) -> dict:
    money = (-12345 + i).to_bytes(3, "big", signed=True).decode("latin-1")
    return {
        "flag": i % 2 == 0,
        "small": -(2**31) + i,
        "big": 2**63 - 1 - i,
        "f": 0.5 * i,
        "d": None if i % 3 == 0 else {"double": i / 7},
        "raw": "\x00\x80\xff" * i,
        "text": None if i % 4 == 0 else {"string": "é漢" * i},
        "kind": "ABC"[i % 3],
        "again": None if i % 2 else {"a.b.Kind": "C"},
        "tag": "abc",
        "list": [None if j % 2 else {"long": -j} for j in range(i % 5)],
        "deep": [[f"{j}-{k}" for k in range(j)] for j in range(i % 4)],
        "map": {f"k{j}": j * i for j in range(i % 3)},
        "inner": None if i % 2 else {"a.b.In": {"x": i}},
        "day": i,
        "at": 1_700_000_000_123 + i,
        "local": 1_700_000_000_123_456 + i,
        "money": money,
    }


def test_all_avro_types(spark):
    """Payloads made by the Avro library, decoded here."""
    n = 25
    schema = json.dumps(WIDE)
    payloads = encode_with_library(spark, schema, [json.dumps(wide_row(i)) for i in range(n)])
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p binary")
    got = df.select("i", decode_avro(spark, F.lit(5), F.col("p"), {5: schema}).alias("r"))
    assert got.schema["r"].dataType.simpleString() == avro_type(schema).simpleString()
    utc = F.unix_millis("r.at").alias("millis")
    for row in got.select("i", "r", utc).orderBy("i").collect():
        i, r, made = row.i, row.r, wide_row(row.i)
        for plain in ("flag", "small", "big", "f", "kind", "map", "deep"):
            assert r[plain] == made[plain], plain
        for union in ("d", "text", "again"):
            assert r[union] == (made[union] and next(iter(made[union].values()))), union
        assert bytes(r.raw) == made["raw"].encode("latin-1")
        assert bytes(r.tag) == b"abc"
        assert r["list"] == [v and v["long"] for v in made["list"]]
        assert (r.inner and r.inner.x) == (None if i % 2 else i)
        assert r.day == date.fromordinal(date(1970, 1, 1).toordinal() + i)
        assert row.millis == made["at"]
        micros = (r.local - datetime(1970, 1, 1)).total_seconds() * 1_000_000
        assert round(micros) == made["local"]
        assert r.money == Decimal(-12345 + i) / 100


def test_blocks_with_sizes(spark):
    """Writers may split lists into blocks and put a byte size in front."""
    schema = '{"type":"array","items":"int"}'
    payload = bytes([3, 4, 2, 4, 2, 6, 0])  # two items in two bytes, one item, end
    df = spark.createDataFrame([(payload,)], "p binary")
    assert df.select(decode_avro(spark, F.lit(1), F.col("p"), {1: schema})).first()[0] == [1, 2, 3]


def test_union_of_two_types_fails():
    with pytest.raises(ValueError, match="unions"):
        avro_type('["null","int","string"]')


def test_ids_of_one_batch_share_a_type(spark):
    narrow = '{"type":"record","name":"V","fields":[{"name":"a","type":"int"}]}'
    wide = (
        '{"type":"record","name":"V","fields":[{"name":"b","type":"string"},'
        '{"name":"a","type":"int"}]}'
    )
    df = spark.createDataFrame(
        [(1, b"\x02"), (2, b"\x02x\x04"), (1, b"\x06"), (1, None)], "id int, p binary"
    ).coalesce(1)
    got = df.select(decode_avro(spark, F.col("id"), F.col("p"), {1: narrow, 2: wide}).alias("r"))
    assert [r.r and tuple(r.r) for r in got.collect()] == [(1, None), (2, "x"), (3, None), None]


def test_merge_types():
    a = avro_type('{"type":"record","name":"A","fields":[{"name":"x","type":"int"}]}')
    b = avro_type('{"type":"record","name":"A","fields":[{"name":"x","type":"long"}]}')
    assert merge_types([a, a]) == a
    with pytest.raises(ValueError, match="disagree"):
        merge_types([a, b])


def test_align(spark):
    df = spark.createDataFrame(
        [((1, [(2,)], {"k": (3,)}),), (None,)],
        "r struct<a:int,l:array<struct<x:int>>,m:map<string,struct<x:int>>>",
    )
    wide = spark.createDataFrame(
        [], "r struct<a:int,l:array<struct<x:int,y:string>>,m:map<string,struct<y:int,x:int>>,z:int>"
    ).schema["r"].dataType
    got = df.select(align(F.col("r"), df.schema["r"].dataType, wide).alias("r")).collect()
    assert got[0].r.asDict(True) == {
        "a": 1, "l": [{"x": 2, "y": None}], "m": {"k": {"y": None, "x": 3}}, "z": None,
    }
    assert got[1].r is None


def test_json_messages(spark):
    def message(schema, payload):
        return json.dumps({"schema": schema, "payload": payload}).encode()

    def struct(**fields):
        return {"type": "struct", "fields": [{"field": k, "type": t} for k, t in fields.items()]}

    key = struct(id="int32")
    old, new = struct(op="string"), struct(op="string", extra="int64")
    df = messages(
        spark,
        [
            (message(key, {"id": 1}), message(old, {"op": "c"}), 1),
            (message(key, {"id": 2}), message(new, {"op": "u", "extra": 5}), 2),
        ],
    )
    texts = [json.dumps(s) for s in (old, new)]
    got = decode_json_messages(df, [json.dumps(key)], texts).orderBy("offset").collect()
    assert [(r.key.id, r.value.op, r.value.extra) for r in got] == [(1, "c", None), (2, "u", 5)]
    assert connect_type(got[1].valueSchema) == connect_type(texts[1])
    bad = messages(spark, [(b'{"payload": ', message(old, {"op": "c"}), 1)])
    with pytest.raises(Exception, match="(?i)malformed"):
        decode_json_messages(bad, [json.dumps(key)], texts).collect()


def test_frame_roundtrip(spark):
    df = spark.range(3).select(
        frame((F.col("id") * 1000000).cast("int"), F.lit(b"xy")).alias("key"),
        F.lit(None).cast("binary").alias("value"),
    )
    got = split_frames(df).collect()
    assert [r.keySchemaId for r in got] == [0, 1000000, 2000000]
    assert {bytes(r.key) for r in got} == {b"xy"}


def product_descriptors():
    """Descriptor sets of a key and of an envelope around a product."""
    descriptor_pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
    kinds = descriptor_pb2.FieldDescriptorProto

    def message(name, *fields):
        out = descriptor_pb2.DescriptorProto(name=name)
        for number, (field, kind, type_name, label) in enumerate(fields, 1):
            out.field.add(name=field, number=number, type=kind, label=label, type_name=type_name or None)
        return out

    def as_set(name, *messages):
        file = descriptor_pb2.FileDescriptorProto(name=name, package="shop", syntax="proto3")
        file.message_type.extend(messages)
        return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()

    one, many = kinds.LABEL_OPTIONAL, kinds.LABEL_REPEATED
    product = message(
        "Product",
        ("id", kinds.TYPE_INT32, "", one),
        ("name", kinds.TYPE_STRING, "", one),
        ("weight", kinds.TYPE_DOUBLE, "", one),
        ("tags", kinds.TYPE_STRING, "", many),
    )
    envelope = message(
        "Envelope",
        ("before", kinds.TYPE_MESSAGE, ".shop.Product", one),
        ("after", kinds.TYPE_MESSAGE, ".shop.Product", one),
        ("op", kinds.TYPE_STRING, "", one),
    )
    key = message("Key", ("id", kinds.TYPE_INT32, "", one))
    return as_set("key.proto", key), as_set("value.proto", envelope, product)


def test_protobuf_run(spark):
    key_set, value_set = product_descriptors()
    message_factory = pytest.importorskip("google.protobuf.message_factory")
    new_key, new_value = (
        message_factory.GetMessageClass(first_message(data)) for data in (key_set, value_set)
    )

    def framed(schema_id, message, position=b"\x00"):
        return b"\x00" + schema_id.to_bytes(4, "big") + position + message.SerializeToString()

    product = {"id": 7, "name": "é", "weight": 2.5, "tags": ["x", "y"]}
    created = new_value(after=product, op="c")
    gone = new_value(before={"id": 8, "name": "b"}, op="d")
    sent = [(framed(1, new_key(id=7)), framed(2, created), 1)]
    sent += [(framed(1, new_key(id=8)), framed(2, gone), 2)]
    texts = {1: base64.b64encode(key_set).decode(), 2: base64.b64encode(value_set).decode()}
    split = split_frames(messages(spark, sent))
    got = decode_frames(spark, split, {1: texts[1]}, {2: texts[2]}, "protobuf").orderBy("offset")
    first, second = got.collect()
    assert (first.key.id, second.key.id) == (7, 8)
    assert first.value.asDict(True) == {"before": None, "after": product, "op": "c"}
    assert tuple(second.value.before) == (8, "b", None, None)

    settings = new_lake(spark)
    settings = replace(settings, schema_registry={"local": texts})
    messages(spark, sent).write.parquet(settings.url("capture"))
    stream = captured_messages(spark, settings.url("capture"))
    run_table(spark, REF, "local", "protobuf", lambda ref: stream, settings)
    table = read_curated(spark, REF.path("curated", settings))
    assert rows(table, "id", "name", "op") == [(7, "é", "c")]

    other = messages(spark, [(sent[0][0], framed(2, created, b"\x02\x01"), 1)])
    with pytest.raises(Exception, match="first message type"):
        decode_frames(
            spark, split_frames(other), {1: texts[1]}, {2: texts[2]}, "protobuf"
        ).collect()


def test_json_schemas_are_cut_out(spark):
    """The same text as by parsing where the message is plain; parsed where it is not."""
    schema = '{"type":"struct","fields":[{"type":"int32","optional":false,"field":"payload"}]}'
    named = '{"type":"struct","parameters":{"a":"1","payload":"2"},"fields":[]}'
    given = {
        f'{{"schema":{schema},"payload":{{"payload":1}}}}': schema,
        f'{{"payload":{{"payload":1}},"schema":{schema}}}': schema,
        f'{{"schema": {schema}, "payload": {{"payload":1}}}}': schema,
        '{"schema":null,"payload":{"payload":1}}': None,
        # Cut short, so no JSON: staging parses such batches.
        f'{{"schema":{named},"payload":{{}}}}': named[: named.index(',"payload":')],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = df.select(json_schema_cut(F.col("t").cast("binary")).alias("s")).orderBy("i")
    assert [r.s for r in got.collect()] == list(given.values())


def test_batches_of_schemas_that_name_a_payload(spark):
    """A schema that cannot be cut out whole is read by parsing, with the same rows."""
    field = lambda name: {"type": "int32", "optional": True, "field": name}
    inner = {"type": "struct", "optional": True, "field": "after", "parameters": {"a": "1", "payload": "2"},
             "fields": [field("id")]}
    op = {"type": "string", "optional": True, "field": "op"}
    value = {"type": "struct", "fields": [inner, op]}
    key = {"type": "struct", "fields": [field("id")]}
    text = lambda schema, payload: json.dumps(
        {"schema": schema, "payload": payload}, separators=(",", ":")
    ).encode()
    batch = messages(spark, [
        (text(key, {"id": i}), text(value, {"after": {"id": i}, "op": "c"}), i) for i in range(3)
    ] + [(text(key, {"id": 9}), None, 3)])
    staged, count, tombstones = decode_batch(batch, "json", None)
    assert (count, tombstones) == (3, 1)
    got = staged.orderBy("offset").collect()
    assert [(r.key.id, r.value.after.id, r.value.op) for r in got] == [(i, i, "c") for i in range(3)]
    assert {json.dumps(json.loads(r.valueSchema)) for r in got} == {json.dumps(value)}
