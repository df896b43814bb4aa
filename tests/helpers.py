"""Hand-made messages and tables for operator tests."""

from dataclasses import replace
from datetime import datetime, timezone


from ebbtide.address import TableRef
from ebbtide.config import DEFAULT
from ebbtide.plans.change_logs import AVRO_SCHEMAS
from ebbtide.sources.capture import KAFKA_SCHEMA
from ebbtide.sources.storage import scratch_path

REF = TableRef("dbserver1", "inventory", "products")

KEY_SCHEMA = '{"type":"record","name":"Key","fields":[{"name":"id","type":"int"}]}'
VALUE_SCHEMA = (
    '{"type":"record","name":"Envelope","fields":[{"name":"before","type":["null",'
    '{"type":"record","name":"Value","fields":[{"name":"id","type":"int"},'
    '{"name":"name","type":"string"},{"name":"weight","type":"double"}]}]},'
    '{"name":"after","type":["null","Value"]},{"name":"op","type":"string"}]}'
)
SAMPLE_KEY = bytes.fromhex("00" "00000001" "D20F")
SAMPLE_VALUE = bytes.fromhex("00" "00000002" "00" "02" "D20F" "046162" "0000000000000440" "0263")


def new_lake(spark, **changes):
    protocol, _, base = scratch_path(spark, "lake").partition(":")
    return replace(
        DEFAULT,
        prefix_protocol=protocol,
        base=f"/{base.lstrip('/')}/",
        schema_registry={"local": AVRO_SCHEMAS, "sample": {1: KEY_SCHEMA, 2: VALUE_SCHEMA}},
        **changes,
    )


def new_path(spark):
    return scratch_path(spark, "table")


def messages(spark, rows):
    """Captured messages from (key, value, offset) bytes."""
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(k, v, REF.topic, 0, offset, at, 0) for k, v, offset in rows], KAFKA_SCHEMA
    )


STAGED = (
    "key struct<id:int>, "
    "value struct<before:struct<id:int,name:string>,after:struct<id:int,name:string>,op:string>, "
    "partition int, offset bigint, timestamp timestamp_ntz, keySchemaId int, valueSchemaId int"
)


def staged(spark, rows):
    """Staged rows from (id, op, name, seconds, offset)."""
    data = []
    for key, op, name, seconds, offset in rows:
        image = (key, name)
        before = image if op in ("u", "d") else None
        after = image if op != "d" else None
        at = datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)
        data.append(((key,), (before, after, op), 0, offset, at, 1, 2))
    return spark.createDataFrame(data, STAGED)


def rows(df, *columns):
    order = columns or df.columns
    return sorted((tuple(r) for r in df.select(*order).collect()), key=repr)


def encode_with_library(spark, schema, texts):
    """Avro bytes of JSON texts, made by the Avro library on Spark's classpath."""
    jvm = spark._jvm
    parsed = jvm.org.apache.avro.Schema.Parser().parse(schema)
    out = []
    for text in texts:
        decoder = jvm.org.apache.avro.io.DecoderFactory.get().jsonDecoder(parsed, text)
        datum = jvm.org.apache.avro.generic.GenericDatumReader(parsed).read(None, decoder)
        stream = jvm.java.io.ByteArrayOutputStream()
        encoder = jvm.org.apache.avro.io.EncoderFactory.get().binaryEncoder(stream, None)
        jvm.org.apache.avro.generic.GenericDatumWriter(parsed).write(datum, encoder)
        encoder.flush()
        out.append(bytes(stream.toByteArray()))
    return out
