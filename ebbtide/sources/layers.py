"""Reading and writing tables by layer, project, database and table name."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ebbtide.address import TableRef, mount_checkpoint_path, mount_path
from ebbtide.config import DEFAULT, Settings
from ebbtide.sources.capture import ANY_AGE

# JSON and CSV drop microseconds by default, and CSV breaks on quotes inside text.
# With these options a table comes back as it was written; text with line breaks
# needs multiLine="true" as well, which keeps a CSV file from being split.
LOSSLESS = {
    "json": {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    "csv": {
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "header": "true",
        "escape": '"',
    },
}


def _address(layer: str | None, ref: TableRef | None, settings: Settings) -> str | None:
    return None if layer is None or ref is None else ref.path(layer, settings)


def _options(fmt: str, options: dict) -> dict:
    return {**LOSSLESS.get(fmt, {}), **options}


def read_layer(
    spark: SparkSession,
    layer: str,
    ref: TableRef,
    fmt: str = "parquet",
    schema=None,
    settings: Settings = DEFAULT,
    **options,
) -> DataFrame:
    """Batch read in any format: parquet, json, orc, text, csv, or a connector."""
    reader = spark.read.format(fmt).options(**_options(fmt, options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(_address(layer, ref, settings))


def write_layer(
    df: DataFrame,
    layer: str,
    ref: TableRef,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    settings: Settings = DEFAULT,
    **options,
) -> str:
    """Batch write in any format; returns the path."""
    path = _address(layer, ref, settings)
    writer: DataFrameWriter = df.write.format(fmt).options(**_options(fmt, options))
    writer.mode(mode).save(path)
    return path


def read_layer_evolving(
    spark: SparkSession, layer: str, ref: TableRef, settings: Settings = DEFAULT
) -> DataFrame:
    """Parquet files of several schemas as one table, missing columns NULL."""
    return read_layer(spark, layer, ref, "parquet", settings=settings, mergeSchema="true")


def stream_layer(
    spark: SparkSession,
    layer: str | None = None,
    ref: TableRef | None = None,
    fmt: str = "parquet",
    schema=None,
    settings: Settings = DEFAULT,
    **options,
) -> DataFrame:
    """Stream a table, or a source that has no path when no address is given.

    File formats other than text need a schema. Files are taken whatever their age.
    """
    path = _address(layer, ref, settings)
    ages = ANY_AGE if path is not None else {}
    reader = spark.readStream.format(fmt).options(**{**ages, **_options(fmt, options)})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if path is None else reader.load(path)


def start_stream(
    writer: DataStreamWriter,
    layer: str | None = None,
    ref: TableRef | None = None,
    settings: Settings = DEFAULT,
    **options,
) -> StreamingQuery:
    """Start a stream into a table.

    The checkpoint lies in the control area under the same address unless the
    options name one. Without an address this is a plain ``start``.
    """
    if layer is None or ref is None:
        return writer.start(**options)
    address = (layer, ref.project_name, ref.database, ref.table_name)
    options.setdefault("checkpointLocation", mount_checkpoint_path(*address, settings=settings))
    return writer.start(path=mount_path(*address, settings=settings), **options)
