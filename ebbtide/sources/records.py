"""Record files and generated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings
from ebbtide.sources.layers import write_layer


def read_records(spark: SparkSession, folder: str, schema=None, field: str = "results") -> DataFrame:
    """Records of JSON files, one per line or as a list under one field.

    Without a schema the types are inferred, which reads the files once more.
    """
    reader = spark.read.option("mode", "FAILFAST")
    rows = (reader if schema is None else reader.schema(schema)).json(folder)
    if rows.columns == [field] and isinstance(rows.schema[field].dataType, T.ArrayType):
        return rows.select(F.explode(field).alias("record")).select("record.*")
    return rows


def ingest_records(
    spark: SparkSession,
    folder: str,
    layer: str,
    ref: TableRef,
    schema=None,
    fmt: str = "parquet",
    settings: Settings = DEFAULT,
) -> str:
    """Replace a table by the records of a folder; returns its path."""
    rows = read_records(spark, folder, schema)
    return write_layer(rows, layer, ref, fmt, mode="overwrite", settings=settings)


def generate_products(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """One product per id: two hashes and a whole-number weight below 1,000,000.

    Values depend on the id only, so that a repeated task gives the same rows.
    """

    def digest(salt: str) -> Column:
        return F.md5(F.concat(F.lit(salt), F.col(id_column).cast("string")).cast("binary"))

    number = F.conv(F.substring(digest("weight:"), 1, 12), 16, 10).cast("bigint")
    return ids.select(
        digest("name:").alias("name"),
        digest("description:").alias("description"),
        (number % 1_000_000).alias("weight"),
    )


def synthetic_products(spark: SparkSession, n: int = 1_000_000) -> DataFrame:
    return generate_products(spark.range(n))
