"""Change rows: latest per key, before/after images, merge into a target.

Pure DataFrame functions; nothing here runs a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.schemas import align, merge_types

DELETE = "d"
ARRIVAL_ORDER = ("timestamp", "offset", "partition")


def schema_pair_columns(staged: DataFrame) -> list[str]:
    """Names of the two columns that tell which schemas a row was written with."""
    suffix = "Id" if "keySchemaId" in staged.columns else ""
    return [f"keySchema{suffix}", f"valueSchema{suffix}"]


def schema_pairs(messages: DataFrame) -> DataFrame:
    """Distinct pairs of key and value schema, oldest first."""
    pair = schema_pair_columns(messages)
    return messages.select(*pair).distinct().orderBy(*pair)


def route_schema_pair(staged: DataFrame, key_schema, value_schema) -> DataFrame:
    """Rows written with one pair of schemas; a NULL id matches no pair."""
    key_column, value_column = schema_pair_columns(staged)
    return staged.filter(
        (F.col(key_column) == key_schema) & (F.col(value_column) == value_schema)
    )


def latest_per_key(
    changes: DataFrame,
    keys: str | Sequence[str] = "key",
    newest_first: Sequence[str | Column] = ARRIVAL_ORDER,
) -> DataFrame:
    """The newest row of each key.

    Spark keeps one row per key and task before the shuffle
    (WindowGroupLimit), so a key with very many rows does not pile up on one
    task. Order columns given by name count downwards.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return changes.withColumn("_row_num", newest).filter("_row_num = 1").drop("_row_num")


def change_rows(
    staged: DataFrame, value: str = "value", key: str = "key", keep: Sequence[Column] = ()
) -> DataFrame:
    """One flat row per change: ``after`` or, for deletes, ``before``, and op.

    Key columns come from the message key, which every change has; a source may
    log deletes without an image, and their other columns are NULL then. Any
    other op without ``after`` fails: there would be nothing to write. Images are
    matched by field name; rows without op are no change. ``keep`` are further
    columns of the staged rows.
    """
    envelope = staged.schema[value].dataType
    images = {name: envelope[name].dataType for name in ("after", "before")}
    fields = {f.name: f.dataType for image in images.values() for f in image}
    for name, image in images.items():
        for f in image:
            if fields[f.name] != f.dataType:
                raise ValueError(f"field {f.name!r} has two types in before and after")
    keys = key_fields(staged, key) if key in staged.columns else []

    op, after = F.col(f"{value}.op"), F.col(value).getField("after")
    lost = F.concat(F.lit("a change without image that is no delete: op "), op)
    checked = F.when((op != DELETE) & after.isNull(), F.raise_error(lost)).otherwise(op)

    def pick(image: str, field: str) -> Column:
        if field in images[image].names:
            return F.col(value).getField(image).getField(field)
        return F.lit(None).cast(fields[field])

    columns = [F.col(key).getField(k).alias(k) for k in keys if k not in fields]
    for f in fields:
        image = F.when(op == DELETE, pick("before", f)).otherwise(pick("after", f))
        columns.append((F.col(key).getField(f) if f in keys else image).alias(f))
    return staged.filter(op.isNotNull()).select(*columns, checked.alias("op"), *keep)


def live_rows(changes: DataFrame, op: str = "op") -> DataFrame:
    """Rows that exist after their change; rows without op match neither side."""
    return changes.filter(F.col(op) != DELETE)


def current_state(staged: DataFrame, keys: str | Sequence[str] = "key") -> DataFrame:
    """First load of a mirror: newest change of each key, if not a delete."""
    return live_rows(change_rows(latest_per_key(staged, keys)))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def all_set(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    order: str | None = None,
) -> DataFrame:
    """The target after upserts and deletes.

    ``changes`` holds at most one row per key (see latest_per_key). Matched
    rows are updated, or dropped for op 'd'; unmatched rows are inserted unless
    op is 'd'; rows without op do nothing. NULL keys match nothing. Columns
    only the changes have are added, columns only the target has keep their
    value.

    ``order`` names a column of both sides that tells when a row was changed.
    With it, a change is applied only if it is newer than the row it meets, and
    a delete leaves its row with op 'd' behind, so that changes may come in any
    order.

    Target and changes meet in one full outer join; rows with a NULL key need no
    join and skip it.
    """
    keys = list(keys)
    changes = changes.filter(F.col(op).isNotNull())
    target, changes = same_types(target, changes)

    change = changes.filter(all_set(keys)).select(
        *[_q(k) for k in keys], F.struct(*map(_q, changes.columns)).alias("_change")
    )
    row = target.filter(all_set(keys)).select(
        *[_q(k) for k in keys], F.struct(*map(_q, target.columns)).alias("_row")
    )
    joined = row.join(change, keys, "full_outer")
    applies = F.col("_change").isNotNull()
    if order:
        old, new = F.col("_row").getField(order), F.col("_change").getField(order)
        applies = applies & (old.isNull() | (new > old))
    else:
        joined = joined.filter(
            F.col("_change").isNull() | (F.col("_change").getField(op) != DELETE)
        )

    def value(name: str) -> Column:
        if name in keys:
            return F.col(_q(name))
        if name not in changes.columns:
            return F.col("_row").getField(name).alias(name)
        changed = F.when(applies, F.col("_change").getField(name))
        return changed.otherwise(F.col("_row").getField(name)).alias(name)

    without_key = changes.filter(any_null(keys))
    if not order:
        without_key = live_rows(without_key, op)
    return (
        joined.select(*map(value, target.columns))
        .unionByName(target.filter(any_null(keys)))
        .unionByName(without_key, allowMissingColumns=True)
    )


def same_types(
    target: DataFrame, changes: DataFrame, widen: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Give the target the columns it lacks, and shared columns one type.

    Changes are cast to the type of the target where it holds all their values;
    with ``widen``, the target's columns also take the type of the changes where
    that one holds all of theirs. Other types fail; nested fields are added.
    """
    have = {f.name: f.dataType for f in target.schema}
    come = {f.name: f.dataType for f in changes.schema}
    final = {**come, **have}
    for name in have.keys() & come.keys():
        try:
            final[name] = merge_types([have[name], come[name]], widen=True)
        except ValueError:
            final[name] = None
        nested = isinstance(have[name], (T.StructType, T.ArrayType, T.MapType))
        # Without widening, the changes are cast, or nested fields come to the target.
        kept = final[name] == have[name] or nested
        if final[name] is None or not (widen or kept):
            raise ValueError(
                f"column {name!r} has type {have[name].simpleString()} and cannot hold "
                f"{come[name].simpleString()}"
            )
    widened = [
        *[align(F.col(_q(c)), t, final[c]).alias(c) for c, t in have.items()],
        *[F.lit(None).cast(t).alias(c) for c, t in come.items() if c not in have],
    ]
    return target.select(*widened), changes.select(
        *[align(F.col(_q(c)), t, final[c]).alias(c) for c, t in come.items()]
    )


def _q(name: str) -> str:
    return f"`{name}`"


def key_fields(staged: DataFrame, key: str = "key") -> list[str]:
    """Primary-key columns: the fields of the key struct."""
    key_type = staged.schema[key].dataType
    if not isinstance(key_type, T.StructType) or not len(key_type):
        raise ValueError(f"{key!r} is not a struct of key fields")
    return key_type.names
