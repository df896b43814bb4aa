"""Merges that leave folders without a changed key as they are, told by bitmaps of key hashes.

Beside a table's data, ``_keymaps/<folder>`` holds for each bucket of a folder which
hash positions its keys take, 32,768 positions a row. A folder's rows never change, so
its bitmaps are made once, from its key columns. A changed key may be in a folder only
if its position is taken there: a bitmap never hides a key, and reading a folder in
vain costs time only. Folders without bitmaps are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.changes import all_set
from ebbtide.operators.tables import (
    BUCKET,
    Version,
    bucket_of,
    merge_table,
    require_version,
    scan,
)
from ebbtide.sources.storage import delete_path, list_names, move_path, path_exists

KEYMAPS = "_keymaps"
#: Hash positions of a bucket; a folder's bitmaps take 8 MB for each bucket at most.
POSITIONS = 1 << 26
_NAMES = r"[^/,}]+"


def _places(keys: Sequence[str]) -> list[Column]:
    """Row and bit of a key in the bitmaps; hashed apart from the key's bucket."""
    position = F.pmod(F.xxhash64(F.lit(1), *(F.col(f"`{k}`") for k in keys)), F.lit(POSITIONS)) + 1
    return [
        F.bitmap_bucket_number(position).alias("slot"),
        F.bitmap_bit_position(position).alias("bit"),
    ]


def add_keymaps(spark: SparkSession, path: str) -> list[str]:
    """Make the bitmaps that folders of the newest version lack; returns these folders.

    They are written under another name and renamed: a lost run leaves none or all
    of a folder's.
    """
    base = require_version(spark, path)
    have = set(list_names(spark, f"{path}/{KEYMAPS}", _NAMES))
    paths = {
        f"{path}/data/{folder}/{BUCKET}={b}": folder
        for b, some in base.folders.items()
        for folder in some
        if folder not in have
    }
    if not paths or not base.keys:
        return []
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/{BUCKET}=\d+/", 1)
    maps = (
        scan(spark, base.struct_type, list(paths))
        .where(all_set([f"`{k}`" for k in base.keys]))
        .select(folder.alias("folder"), F.col(BUCKET).alias("bucket"), *_places(base.keys))
        .groupBy("folder", "bucket", "slot")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    maps.hint("rebalance", "folder").write.partitionBy("folder").parquet(draft)
    made = sorted(set(paths.values()))
    for name in made:
        # A folder that holds NULL keys only has no bitmaps, and is read.
        if path_exists(spark, f"{draft}/folder={name}"):
            move_path(spark, f"{draft}/folder={name}", f"{path}/{KEYMAPS}/{name}")
    delete_path(spark, draft, within=path)
    return made


def drop_keymaps(spark: SparkSession, path: str) -> int:
    """Delete the bitmaps of folders that are gone; returns how many."""
    gone = set(list_names(spark, f"{path}/{KEYMAPS}", _NAMES)) - set(list_names(spark, f"{path}/data", _NAMES))
    for folder in gone:
        delete_path(spark, f"{path}/{KEYMAPS}/{folder}", within=f"{path}/{KEYMAPS}")
    return len(gone)


def folders_with_keys(
    spark: SparkSession, path: str, base: Version, changes: DataFrame, touched: Sequence[str]
) -> dict[str, list[str]]:
    """The folders of each touched bucket that may hold the key of a change."""
    mapped = set(list_names(spark, f"{path}/{KEYMAPS}", _NAMES))
    wanted = sorted({f for b in touched for f in base.folders.get(b, {}) if f in mapped})
    found = set()
    if wanted:
        hashable = list(base.keys)  # keys that are set tell the bucket alone
        places = (
            changes.where(all_set([f"`{k}`" for k in base.keys]))
            .select(bucket_of(hashable, base.keys, base.buckets, base.first).alias("bucket"), *_places(base.keys))
            .distinct()
        )
        name = F.regexp_extract(F.col("_metadata.file_path"), rf"/{KEYMAPS}/([^/]+)/", 1)
        maps = (
            spark.read.schema("bucket int, slot bigint, bits binary")
            .parquet(*(f"{path}/{KEYMAPS}/{f}" for f in wanted))
            .select("*", name.alias("folder"))
            .where(F.col("bucket").isin([int(b) for b in touched]))
        )
        byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
        taken = F.getbit(byte.cast("bigint"), (F.col("bit") % 8).cast("int")) == 1
        hits = maps.join(places, ["bucket", "slot"]).where(taken).select("bucket", "folder").distinct()
        found = {(str(r.bucket), r.folder) for r in hits.collect()}  # of the folders the version names
    return {
        b: [f for f in base.folders.get(b, {}) if f not in mapped or (b, f) in found] for b in touched
    }


def merge_pruned(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    source: str | None = None,
    batch_id: int | None = None,
    unique: bool = False,
) -> Version:
    """``merge_table`` that reads and rewrites only folders that may hold a changed key.

    The version's metrics tell the files read and skipped in the touched buckets.
    What a merge writes is a folder of its own, whose bitmaps the next one makes.
    Tables with runs need no such merge. ``changes`` is read three times: pass a
    stored table.
    """
    if require_version(spark, path).order:
        raise ValueError("the table takes changes as runs: see merge_runs")
    add_keymaps(spark, path)

    def pick(base: Version, typed: DataFrame, touched: Sequence[str]) -> dict[str, list[str]]:
        return folders_with_keys(spark, path, base, typed, touched)

    return merge_table(spark, path, changes, keys, source, batch_id, unique=unique, pick=pick)
