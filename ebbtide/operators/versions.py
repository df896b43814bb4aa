"""What changed in a versioned table from one version to another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.changes import all_set, any_null, same_types
from ebbtide.operators.tables import BUCKET, Version, load_version, read_buckets, scan


def changed_buckets(first: Version, last: Version) -> list[str]:
    """Buckets whose folders differ; a folder's rows never change, so all others are equal."""
    either = {**first.folders, **last.folders}
    return sorted(b for b in either if first.folders.get(b) != last.folders.get(b))


def _side(spark: SparkSession, path: str, base: Version, other: Version, buckets: list[str]) -> DataFrame:
    """A version's rows of some buckets, without those of folders that both versions have.

    In tables with runs a row may be outdone by one in another folder, so there
    whole buckets are read.
    """
    if base.order or other.order:
        return read_buckets(spark, path, base, buckets)
    only = [
        f"{path}/data/{folder}/{BUCKET}={b}"
        for b in buckets
        for folder in base.folders.get(b, {})
        if folder not in other.folders.get(b, {})
    ]
    return scan(spark, base.struct_type, only).drop(BUCKET)


def _compared(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    return F.sort_array(F.map_entries(column)) if isinstance(kind, T.MapType) else column


def version_changes(
    spark: SparkSession, path: str, old: int, new: int, live: Column | None = None
) -> DataFrame:
    """(change, before, after): the rows that an 'insert', 'update' or 'delete' made differ.

    ``before`` and ``after`` are rows as structs of the columns of both versions,
    NULL where there is none. Rows are matched by the keys of the table, which must
    be unique; rows with a NULL key, and those of a table without keys, are only
    deleted and inserted, as often as they come. Only folders that the versions
    do not share are read. ``live`` tells the rows that count in either version,
    such as those without a mark of deletion.
    """
    first, last = load_version(spark, path, old), load_version(spark, path, new)
    buckets = changed_buckets(first, last)
    before, after = (
        _side(spark, path, a, b, buckets) for a, b in ((first, last), (last, first))
    )
    before, after = same_types(before, after, widen=True)
    after = after.unionByName(before.limit(0), allowMissingColumns=True).select(before.columns)
    if live is not None:
        before, after = before.where(live), after.where(live)
    whole = F.struct(*(F.col(f"`{c}`") for c in before.columns))
    same = F.struct(*(_compared(f.name, f.dataType) for f in before.schema))

    def counted(rows: DataFrame, side: int) -> DataFrame:
        return rows.select(same.alias("same"), whole.alias("row"), F.lit(side).alias("side"))

    keys = list(last.keys)
    loose = (before.where(any_null(keys)), after.where(any_null(keys))) if keys else (before, after)
    surplus = (
        counted(loose[0], -1)
        .unionByName(counted(loose[1], 1))
        .groupBy("same")
        .agg(F.sum("side").alias("n"), F.any_value("row").alias("row"))
        .where("n != 0")
        .withColumn("times", F.explode(F.sequence(F.lit(1), F.abs("n"))))
    )
    nothing = F.lit(None).cast(before.select(whole.alias("row")).schema["row"].dataType)
    result = surplus.select(
        F.when(F.col("n") > 0, "insert").otherwise("delete").alias("change"),
        F.when(F.col("n") < 0, F.col("row")).otherwise(nothing).alias("before"),
        F.when(F.col("n") > 0, F.col("row")).otherwise(nothing).alias("after"),
    )
    if not keys:
        return result

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        quoted = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
        return rows.where(all_set(keys)).select(*quoted, whole.alias(name), same.alias(f"_{name}"))

    joined = keyed(before, "before").join(
        keyed(after, "after"), [f"_key{i}" for i in range(len(keys))], "full_outer"
    )
    change = F.when(F.col("_before").isNull(), "insert").when(F.col("_after").isNull(), "delete")
    # NULLs of both sides are equal.
    differs = ~F.col("_before").eqNullSafe(F.col("_after"))
    found = joined.where(differs).select(change.otherwise("update").alias("change"), "before", "after")
    return found.unionByName(result)
