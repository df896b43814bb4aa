"""Versioned Parquet tables: what one run writes appears as a whole or not at all.

Rows are dealt into buckets by a hash of the table's keys; a table that grows gets
more of them, see ``grow_table``. A version is one small file ``_versions/<n>.json`` that names, for each bucket, the
folders that hold its rows. Data is written first, under a fresh folder, and
never changed; publishing the version file makes it part of the table. A merge
reads and rewrites the buckets of the changed keys only, and what a version
names is bounded by the buckets and by the appends since the last compaction,
not by the number of files. One writer per table, any number of readers.

A table with an ``order`` column takes changes as runs: later folders of a bucket
hold newer or older rows of the same keys, and readers see the newest row of each
(see ``merge_runs``).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.changes import (
    all_set,
    any_null,
    latest_per_key,
    merge_changes,
    same_types,
)
from ebbtide.sources.storage import (
    create_text,
    list_files,
    list_names,
    path_exists,
    read_text,
)

BUCKET = "_b"


@dataclass(frozen=True)
class Version:
    version: int
    timestamp: str
    operation: str
    operationMetrics: Mapping[str, str]
    schema: Mapping
    keys: Sequence[str]  # none: rows are dealt by all their columns
    buckets: int
    folders: Mapping[str, Mapping[str, Sequence[int]]]  # bucket -> folder -> [files, bytes]
    numFiles: int
    sizeInBytes: int
    applied: Mapping[str, int] = field(default_factory=dict)  # stream -> last batch
    order: str | None = None  # column that ranks the rows of a key, for tables with runs
    first: int | None = None  # buckets when the table was made, if it has grown

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def has_applied(self, source: str | None, batch_id: int | None) -> bool:
        return source is not None and self.applied.get(source, -1) >= batch_id


def version_file(path: str, version: int) -> str:
    return f"{path}/_versions/{version:020d}.json"


def list_versions(spark: SparkSession, path: str) -> list[int]:
    names = list_names(spark, f"{path}/_versions", r"\d{20}\.json")
    return [int(name[:20]) for name in names]


def load_version(spark: SparkSession, path: str, version: int) -> Version:
    return Version(**json.loads(read_text(spark, version_file(path, version))))


def newest_version(spark: SparkSession, path: str) -> Version | None:
    versions = list_versions(spark, path)
    return load_version(spark, path, versions[-1]) if versions else None


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(list_versions(spark, path))


def require_version(spark: SparkSession, path: str) -> Version:
    newest = newest_version(spark, path)
    if newest is None:
        raise ValueError(f"{path} is not a versioned table")
    return newest


def folder_paths(path: str, base: Version, buckets: Iterable[str] | None = None) -> list[str]:
    chosen = base.folders if buckets is None else buckets
    return [
        f"{path}/data/{folder}/{BUCKET}={bucket}"
        for bucket in chosen
        for folder in base.folders.get(bucket, {})
    ]


def scan(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    """Rows of bucket folders, with the bucket; fields a file was written without are NULL."""
    if not paths:
        return spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(None).cast("int"))
    bucket = F.regexp_extract(F.col("_metadata.file_path"), rf"/{BUCKET}=(\d+)/", 1).cast("int")
    return spark.read.schema(schema).parquet(*paths).withColumn(BUCKET, bucket)


def newest_rows(older: DataFrame, newer: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row of each key by ``order``, from rows that have one row a key and runs of changes.

    Keys without change skip the window: they are told by an anti-join with the
    changed keys, which Spark sends to all tasks where these are few. Rows with a
    NULL key are all kept.
    """
    quoted = [f"`{k}`" for k in keys]
    changed = newer.where(all_set(keys)).select(*quoted).distinct()
    met = older.join(changed, list(keys), "left_semi").unionByName(newer.where(all_set(keys)))
    newest = latest_per_key(met, quoted, [F.col(f"`{order}`").desc_nulls_last()])
    return (
        older.join(changed, list(keys), "left_anti")
        .unionByName(newest)
        .unionByName(newer.where(any_null(keys)))
    )


def _resolved(
    spark: SparkSession, path: str, base: Version, picks: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Rows of some folders of each bucket, oldest folder first, with the bucket."""
    first = [f"{path}/data/{some[0]}/{BUCKET}={b}" for b, some in picks.items()]
    later = [f"{path}/data/{folder}/{BUCKET}={b}" for b, some in picks.items() for folder in some[1:]]
    older, newer = scan(spark, base.struct_type, first), scan(spark, base.struct_type, later)
    return newest_rows(older, newer, base.keys, base.order)


def read_folders(
    spark: SparkSession, path: str, base: Version, picks: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Rows of some folders of each bucket, with the bucket; only buckets with runs need more than a scan."""
    runs = {b: list(some) for b, some in picks.items() if base.order and len(some) > 1}
    plain = [f"{path}/data/{f}/{BUCKET}={b}" for b, some in picks.items() if b not in runs for f in some]
    if not runs:
        return scan(spark, base.struct_type, plain)
    resolved = _resolved(spark, path, base, runs)
    return scan(spark, base.struct_type, plain).unionByName(resolved) if plain else resolved


def read_buckets(
    spark: SparkSession,
    path: str,
    base: Version,
    buckets: Iterable[str] | None = None,
    with_bucket: bool = False,
) -> DataFrame:
    """Rows of all or some buckets of a version, in the schema of the version.

    Fields a file was written without are NULL.
    """
    chosen = base.folders if buckets is None else buckets
    rows = read_folders(spark, path, base, {b: list(base.folders.get(b, {})) for b in chosen})
    return rows if with_bucket else rows.drop(BUCKET)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or an older one by number."""
    base = require_version(spark, path) if version is None else load_version(spark, path, version)
    return read_buckets(spark, path, base)


def _level(buckets: int, first: int) -> int:
    """The last number of buckets, at most this, that is a doubling of the first."""
    while first * 2 <= buckets:
        first *= 2
    return first


def split_from(bucket: int, first: int, buckets: int) -> int:
    """Which of the buckets that there were holds the rows of a later one."""
    while bucket >= buckets:
        bucket -= _level(bucket, first)
    return bucket


def bucket_of(
    columns: Sequence[str], keys: Sequence[str], buckets: int, first: int | None = None
) -> Column:
    """Bucket of a row: by its keys, or by all columns where a key is NULL.

    In a table that has grown from ``first`` buckets, those below the number of
    splits since the last doubling are dealt by twice the modulus of the others
    (linear hashing).
    """
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in columns))
    hashed = F.xxhash64(*(F.col(f"`{k}`") for k in keys)) if keys else whole
    chosen = F.when(all_set(keys), hashed).otherwise(whole) if keys else hashed
    level = _level(buckets, first or buckets)
    low = F.pmod(chosen, F.lit(level))
    if level < buckets:
        low = F.when(low < buckets - level, F.pmod(chosen, F.lit(2 * level))).otherwise(low)
    return low.cast("int")


def write_buckets(
    df: DataFrame,
    path: str,
    version: int,
    keys: Sequence[str],
    buckets: int,
    first: int | None = None,
) -> dict[str, dict[str, list[int]]]:
    """Write rows to a fresh folder: bucket -> folder -> [files, bytes].

    The rebalancing hint puts a bucket's rows together and splits what is too
    large for one file.
    """
    folder = f"{version:08d}-{uuid.uuid4().hex[:12]}"
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    dealt = df.withColumn(BUCKET, bucket_of(hashable, keys, buckets, first))
    if buckets > 1:
        dealt = dealt.hint("rebalance", F.col(BUCKET))
    return _written(dealt, path, folder)


def _written(dealt: DataFrame, path: str, folder: str) -> dict[str, dict[str, list[int]]]:
    dealt.write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    bucket = F.regexp_extract("path", rf"/{BUCKET}=(\d+)/", 1).alias("bucket")
    sizes = (
        list_files(dealt.sparkSession, f"{path}/data/{folder}")
        .select(bucket, "length")
        .groupBy("bucket")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
    return {r.bucket: {folder: [r.files, r.bytes]} for r in sizes.collect()}  # one for each bucket


def publish(
    spark: SparkSession,
    path: str,
    version: int,
    operation: str,
    schema: T.StructType,
    folders: Mapping[str, Mapping[str, Sequence[int]]],
    metrics: Mapping[str, object] | None = None,
    applied: Mapping[str, int] | None = None,
    keys: Sequence[str] = (),
    buckets: int = 1,
    order: str | None = None,
    first: int | None = None,
) -> Version:
    """Make a version visible; fails if that number is already taken."""
    sizes = [size for some in folders.values() for size in some.values()]
    new = Version(
        version=version,
        timestamp=datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        operation=operation,
        operationMetrics={k: str(v) for k, v in (metrics or {}).items()},
        schema=schema.jsonValue(),
        keys=list(keys),
        buckets=buckets,
        folders={b: dict(some) for b, some in folders.items()},
        numFiles=sum(files for files, _ in sizes),
        sizeInBytes=sum(length for _, length in sizes),
        applied=dict(applied or {}),
        order=order,
        first=first,
    )
    create_text(spark, version_file(path, version), json.dumps(asdict(new)))
    return new


def _applied(base: Version | None, source: str | None, batch_id: int | None) -> dict[str, int]:
    applied = dict(base.applied) if base else {}
    if source is not None:
        applied[source] = batch_id
    return applied


def _joined(folders: Mapping, added: Mapping) -> dict[str, dict[str, Sequence[int]]]:
    """Folders of each bucket, those added last."""
    return {b: {**folders.get(b, {}), **added.get(b, {})} for b in {**folders, **added}}


def overwrite_table(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    operation: str = "WRITE",
    metrics: Mapping[str, object] | Callable[[], Mapping[str, object]] | None = None,
    source: str | None = None,
    batch_id: int | None = None,
    keys: Sequence[str] = (),
    buckets: int = 1,
    order: str | None = None,
) -> Version:
    """Replace the whole content; the first version of a new table is 0.

    A batch that was applied before is skipped. Keys, buckets and the order that
    tables with runs have are given when a table is made and stay. Metrics may be
    a function, called once rows are written.
    """
    base = newest_version(spark, path)
    if base is not None and base.has_applied(source, batch_id):
        return base
    if base is None and path_exists(spark, path) and not path_exists(spark, f"{path}/data"):
        raise ValueError(f"{path} exists but is not a versioned table")
    version = base.version + 1 if base else 0
    first = None
    if base:
        keys, buckets, order, first = base.keys, base.buckets, base.order, base.first
    folders = write_buckets(df, path, version, keys, buckets, first)
    applied = _applied(base, source, batch_id)
    if callable(metrics):
        metrics = metrics() if folders else None
    return publish(
        spark, path, version, operation, df.schema, folders, metrics, applied, keys, buckets, order,
        first,
    )


def append_table(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    source: str | None = None,
    batch_id: int | None = None,
) -> Version:
    """Add rows; new columns are added to the table, missing ones are NULL.

    A batch that was applied before is skipped.
    """
    base = newest_version(spark, path)
    if base is None:
        return overwrite_table(spark, path, df, "WRITE", None, source, batch_id)
    if base.has_applied(source, batch_id):
        return base
    schema = same_types(spark.createDataFrame([], base.struct_type), df, widen=True)[0].schema
    require_key_types(base, schema)
    if base.order:
        raise ValueError("the table takes changes by key: merge them")
    folders = _joined(base.folders, write_buckets(df, path, base.version + 1, base.keys, base.buckets, base.first))
    applied = _applied(base, source, batch_id)
    return publish(
        spark, path, base.version + 1, "APPEND", schema, folders, None, applied,
        base.keys, base.buckets, first=base.first,
    )


def require_key_types(base: Version, schema: T.StructType) -> None:
    """Rows are dealt by the hash of their keys, which depends on the keys' types."""
    for key in base.keys:
        if schema[key].dataType != base.struct_type[key].dataType:
            raise ValueError(f"key column {key!r} cannot hold {schema[key].dataType.simpleString()}")


def change_stats(
    changes: DataFrame, keys: Sequence[str], buckets: int, unique: bool, first: int | None = None
):
    """(most rows per key, upserts, deletes, buckets touched) of a set of changes."""
    hashable = [f.name for f in changes.schema if not isinstance(f.dataType, T.MapType)]
    by_bucket = (
        changes.groupBy(bucket_of(hashable, keys, buckets, first).cast("string").alias("bucket"))
        .agg(F.count_if(F.col("op") != "d").alias("upserts"), F.count_if(F.col("op") == "d").alias("deletes"))
        .collect()  # one row for each bucket
    )
    most = 1
    if not unique:
        per_key = changes.filter(all_set(keys)).groupBy(*keys).count()
        most = per_key.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    upserts, deletes = (sum(r[c] for r in by_bucket) for c in ("upserts", "deletes"))
    return most, upserts, deletes, sorted(r.bucket for r in by_bucket)


def merge_table(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    source: str | None = None,
    batch_id: int | None = None,
    order: str | None = None,
    unique: bool = False,
    tidy=None,
    pick: Callable[[Version, DataFrame, Sequence[str]], Mapping[str, Sequence[str]]] | None = None,
) -> Version:
    """Merge changes into a table, rewriting only the buckets they touch.

    ``changes`` is read twice: pass a stored table. More than one change per key
    is an error, looked for unless the caller says they are ``unique``. ``tidy``
    is applied to the rows of the rewritten buckets. For ``order`` see
    merge_changes. ``pick`` tells which folders of the touched buckets may hold a
    changed key, where others are to stay (see ``keymaps``).
    """
    base = require_version(spark, path)
    if base.has_applied(source, batch_id):
        return base
    if list(keys) != list(base.keys):
        raise ValueError(f"the table is dealt by {list(base.keys)}, not by {list(keys)}")
    changes = changes.filter(F.col("op").isNotNull())
    # One type for all columns now: a change is dealt by the hash of its key in the table's type.
    empty, changes = same_types(spark.createDataFrame([], base.struct_type), changes, widen=True)
    require_key_types(base, empty.schema)
    most, upserts, deletes, touched = change_stats(changes, keys, base.buckets, unique, base.first)
    if most > 1:
        raise ValueError("several changes for one key: take the latest per key first")
    picks = pick(base, changes, touched) if pick else {b: list(base.folders.get(b, {})) for b in touched}
    target, changes = same_types(read_folders(spark, path, base, picks).drop(BUCKET), changes, widen=True)
    merged = merge_changes(target, changes, keys, order=order)
    if tidy:
        merged = tidy(merged)
    folders = {
        b: {f: size for f, size in some.items() if f not in picks.get(b, ())} for b, some in base.folders.items()
    }
    if touched:
        # Joined, not replaced: rows without key may have moved to buckets not touched.
        folders = _joined(folders, write_buckets(merged, path, base.version + 1, keys, base.buckets, base.first))
    folders = {b: some for b, some in folders.items() if some}
    metrics = {
        "numUpserts": upserts,
        "numDeletes": deletes,
        "numBucketsRewritten": len(touched),
    }
    if pick:
        files = {b: sum(n for n, _ in base.folders.get(b, {}).values()) for b in touched}
        read = sum(base.folders[b][f][0] for b, some in picks.items() for f in some)
        metrics |= {"numFilesRead": read, "numFilesSkipped": sum(files.values()) - read}
    applied = _applied(base, source, batch_id)
    return publish(
        spark, path, base.version + 1, "MERGE", merged.schema, folders, metrics, applied,
        base.keys, base.buckets, base.order, base.first,
    )


def counted(changes: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The same changes, and what tells (once they are written) how many of each kind they were."""
    seen = Observation()
    observed = changes.observe(
        seen,
        F.count_if(F.col("op") != "d").alias("numUpserts"),
        F.count_if(F.col("op") == "d").alias("numDeletes"),
    )
    return observed, lambda: dict(seen.get)


def runs_to_fold(sizes: Sequence[int]) -> int | None:
    """From which of a bucket's folders (bytes, oldest first) on all should become one, if any.

    A folder that is no larger than all after it together is folded with them, so
    sizes fall by half from folder to folder: a bucket has few runs, and a row is
    rewritten once each time that the rows behind it about double. Up to a quarter
    more counts as no larger, since small files differ by their footers.
    """
    return next((i for i in range(len(sizes) - 1) if sizes[i] <= 1.25 * sum(sizes[i + 1 :])), None)


def merge_runs(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    source: str | None = None,
    batch_id: int | None = None,
    tidy=None,
    most_files: int | None = None,
) -> Version:
    """Merge changes into a table that has an order: they are added as a run of each bucket.

    What is written grows with the changes, not with the table; runs are folded by
    size, see ``runs_to_fold``, and all at once where the table would have more
    files than ``most_files``. ``changes`` is read once; it holds at most one row
    per key, its deletes too, and all columns of the table (a batch that lacks some
    is merged by rewriting its buckets, where rows keep the values they have).
    ``tidy`` is applied to buckets that are folded whole.
    """
    base = require_version(spark, path)
    if not base.order:
        raise ValueError(f"{path} has no order of rows")
    if base.has_applied(source, batch_id):
        return base
    changes = changes.filter(F.col("op").isNotNull())
    if set(base.struct_type.names) - set(changes.columns):
        return merge_table(
            spark, path, changes, base.keys, source, batch_id, base.order, unique=True, tidy=tidy
        )
    target, changes = same_types(spark.createDataFrame([], base.struct_type), changes, widen=True)
    require_key_types(base, target.schema)
    observed, counts = counted(changes.select(*(f"`{c}`" for c in target.columns)))
    number, schema = base.version + 1, target.schema
    added = write_buckets(observed, path, number, base.keys, base.buckets, base.first)
    new = replace(base, schema=schema.jsonValue(), folders=_joined(base.folders, added))

    files = sum(files for some in new.folders.values() for files, _ in some.values())
    every = most_files is not None and files > most_files
    starts = {
        b: 0 if every and len(some) > 1 else runs_to_fold([size for _, size in some.values()])
        for b, some in new.folders.items()
        if every or b in added
    }
    starts = {b: i for b, i in starts.items() if i is not None}
    folders = dict(new.folders)
    # Marks that have expired may go only where no older row is left behind.
    for some, last in (({b: i for b, i in starts.items() if not i}, tidy), ({b: i for b, i in starts.items() if i}, None)):
        if not some:
            continue
        rows = _resolved(spark, path, new, {b: list(folders[b])[i:] for b, i in some.items()}).drop(BUCKET)
        written = write_buckets(last(rows) if last else rows, path, number, base.keys, base.buckets, base.first)
        left = {b: dict(list(folders[b].items())[: some[b]]) if b in some else all_of for b, all_of in folders.items()}
        folders = {b: all_of for b, all_of in _joined(left, written).items() if all_of}
    metrics = {**counts(), "numBucketsRewritten": len(starts)} if added else {"numUpserts": 0, "numDeletes": 0}
    applied = _applied(base, source, batch_id)
    return publish(
        spark, path, number, "MERGE", schema, folders, metrics, applied,
        base.keys, base.buckets, base.order, base.first,
    )


def replace_folders(
    spark: SparkSession,
    path: str,
    base: Version,
    picks: Mapping[str, Sequence[str]],
    wanted: Mapping[str, int],
    operation: str,
) -> Version:
    """Same rows of some folders of each bucket in other files, about as many as wanted for each bucket.

    Rows stay in their bucket, in the order of their keys. All other folders stay as
    they are; in tables with runs, the new one comes first if the first was picked.
    """
    # A list by bucket is one literal, however many buckets there are.
    counts = F.from_json(F.lit(json.dumps([wanted.get(str(b), 1) for b in range(base.buckets)])), "array<int>")
    rows = read_folders(spark, path, base, picks)
    hashable = [f.name for f in base.struct_type if not isinstance(f.dataType, T.MapType)]
    by = [f"`{c}`" for c in (base.keys or hashable)]
    slot = F.pmod(F.xxhash64(*(F.col(c) for c in by)), F.get(counts, F.col(BUCKET)))
    parts = sum(wanted.values())
    dealt = rows.repartition(parts, F.col(BUCKET), slot) if parts > 1 else rows.coalesce(1)
    sortable = [f"`{k}`" for k in base.keys]
    dealt = dealt.sortWithinPartitions(BUCKET, *sortable)
    written = _written(dealt, path, f"{base.version + 1:08d}-{uuid.uuid4().hex[:12]}")
    folders = dict(base.folders)
    for b, some in picks.items():
        left = {f: size for f, size in base.folders[b].items() if f not in some}
        new = written.get(b, {})
        folders[b] = {**new, **left} if next(iter(base.folders[b])) in some else {**left, **new}
    rewritten = sum(base.folders[b][f][1] for b, some in picks.items() for f in some)
    return publish(
        spark, path, base.version + 1, operation, base.struct_type, {b: f for b, f in folders.items() if f},
        {"numBucketsRewritten": len(picks), "numBytesRewritten": rewritten},
        base.applied, base.keys, base.buckets, base.order, base.first,
    )


def grow_table(spark: SparkSession, path: str, bucket_bytes: int) -> Version:
    """As many buckets as the table's bytes ask for, each of about this size; never fewer than it has.

    Buckets are split one after the other, from the first on, so that the number
    needs no doubling, and only those that split are read and rewritten. Older
    versions keep the buckets they were written with.
    """
    base = require_version(spark, path)
    wanted = math.ceil(base.sizeInBytes / bucket_bytes)
    if wanted <= base.buckets:
        return base
    first = base.first or base.buckets
    split = {str(split_from(b, first, base.buckets)) for b in range(base.buckets, wanted)}
    rows = read_buckets(spark, path, base, sorted(split))
    written = write_buckets(rows, path, base.version + 1, base.keys, wanted, first)
    # Joined: rows without key are dealt by all columns, which may be more than there were.
    folders = _joined({b: some for b, some in base.folders.items() if b not in split}, written)
    metrics = {"numBucketsRewritten": len(split), "numBuckets": wanted}
    return publish(
        spark, path, base.version + 1, "SPLIT", base.struct_type, folders, metrics, base.applied,
        base.keys, wanted, base.order, first,
    )
