"""Merges by runs of changes: rows, folding, and what is written."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators.changes import current_state
from ebbtide.operators.tables import (
    append_table,
    load_version,
    merge_runs,
    merge_table,
    newest_version,
    overwrite_table,
    read_table,
    runs_to_fold,
)
from ebbtide.operators.upkeep import compact_files
from ebbtide.streaming.curate import apply_changes, read_curated
from tests.helpers import new_lake, new_path, rows, staged

CHANGE = "id int, name string, at int, op string"


def keyed(spark, data):
    return spark.createDataFrame(data, CHANGE)


@given(st.lists(st.integers(1, 1000), max_size=60))
def test_folding_keeps_few_runs(sizes):
    """A bucket keeps runs that fall by half in size; each byte is rewritten a logarithm of times."""
    held, written = [], 0
    for size in sizes:
        held.append(size)
        start = runs_to_fold(held)
        if start is not None:
            written += sum(held[start:])
            held[start:] = [sum(held[start:])]
        assert all(a > sum(held[i + 1 :]) for i, a in enumerate(held[:-1]))
    assert sum(held) == sum(sizes)
    assert written <= sum(sizes) * (1 + sum(sizes).bit_length())


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_plain_state(spark, seed):
    """Batches in any order, with NULL keys and deletes, folded or not."""
    rng = random.Random(seed)
    log = [
        (rng.choice([None, *range(6)]), rng.choice("ccud"), f"n{i}", i, i, rng.randrange(6)) for i in range(40)
    ]
    log = [x if x[0] is not None else (None, "c", *x[2:]) for x in log]
    path, lake = new_path(spark), new_lake(spark, buckets=2)
    parts = list(range(6))
    rng.shuffle(parts)
    kept = {x[2] for x in log if x[0] is None}
    for number, part in enumerate(parts):
        # NULL keys are never matched; a batch keeps the newest of them.
        batch = [x[:5] for x in log if x[5] == part]
        kept -= {x[2] for x in batch if x[0] is None} - {x[2] for x in [y for y in batch if y[0] is None][-1:]}
        for _ in range(2):
            apply_changes(staged(spark, batch), path, "s", number, lake)
    expected = rows(current_state(staged(spark, [x[:5] for x in log if x[0] is not None])))
    got = rows(read_curated(spark, path))
    assert [r for r in got if r[0] is not None] == expected
    assert {r[1] for r in got if r[0] is None} == kept


def test_small_batch_writes_little(spark):
    """A hundred changes add their own size to a table of many rows, whatever buckets they touch."""
    path = new_path(spark)
    shape = [F.col("id").cast("int").alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("name")]
    whole = spark.range(200_000).select(*shape, F.lit(1).alias("at"), F.lit("c").alias("op"))
    overwrite_table(spark, path, whole, keys=["id"], buckets=4, order="at")
    size = newest_version(spark, path).sizeInBytes
    for at in (2, 3):
        some = spark.range(0, 200_000, 2000).select(*shape, F.lit(at).alias("at"), F.lit("u").alias("op"))
        before = newest_version(spark, path)
        merge_runs(spark, path, some, "s", at)
        after = newest_version(spark, path)
        old = {(b, f) for b, folders in before.folders.items() for f in folders}
        added = [n[1] for b, folders in after.folders.items() for f, n in folders.items() if (b, f) not in old]
        assert sum(added) < size / 100
        assert after.operationMetrics["numUpserts"] == "100"
    table = read_table(spark, path)
    assert table.count() == 200_000
    assert rows(table.groupBy("op", "at").count()) == [("c", 1, 199_900), ("u", 3, 100)]
    # What has no run is scanned, and keys without change skip the window.
    assert read_table(spark, path, 0).count() == 200_000
    _, files, fewer = compact_files(spark, path, new_lake(spark, max_num_files_allowed=4))
    assert fewer == 4 < files
    assert newest_version(spark, path).order == "at"
    assert rows(read_table(spark, path).groupBy("op", "at").count()) == [("c", 1, 199_900), ("u", 3, 100)]


def test_runs_evolve(spark):
    """New columns come with a run; a batch that lacks columns leaves them as they are."""
    path = new_path(spark)
    overwrite_table(spark, path, keyed(spark, [(1, "a", 1, "c"), (2, "b", 1, "c")]), keys=["id"], buckets=2, order="at")
    wide = keyed(spark, [(1, "A", 2, "u")]).withColumn("extra", F.lit(7))
    merge_runs(spark, path, wide)
    assert rows(read_table(spark, path), "id", "name", "extra") == [(1, "A", 7), (2, "b", None)]
    merge_runs(spark, path, keyed(spark, [(1, "B", 3, "u"), (2, "old", 0, "u"), (3, "c", 3, "c")]))
    assert rows(read_table(spark, path), "id", "name", "extra") == [(1, "B", 7), (2, "b", None), (3, "c", None)]
    with pytest.raises(ValueError, match="cannot hold"):
        merge_runs(spark, path, wide.withColumn("extra", F.lit("text")))
    with pytest.raises(ValueError, match="merge them"):
        append_table(spark, path, wide)


def test_file_limit_folds_all(spark):
    path = new_path(spark)
    many = spark.range(500).select(
        F.col("id").cast("int"), F.lit("x").alias("name"), F.lit(1).alias("at"), F.lit("c").alias("op")
    )
    overwrite_table(spark, path, many, keys=["id"], buckets=2, order="at")
    one = keyed(spark, [(1, "y", 2, "u")])
    merge_runs(spark, path, one)
    assert newest_version(spark, path).numFiles == 3
    merge_runs(spark, path, keyed(spark, [(1, "z", 3, "d")]), most_files=3, tidy=lambda r: r.where("op != 'd'"))
    assert newest_version(spark, path).numFiles == 2
    assert read_table(spark, path).count() == 499
    assert load_version(spark, path, 1).numFiles == 3


def test_tables_without_order_refuse_runs(spark):
    path = new_path(spark)
    overwrite_table(spark, path, keyed(spark, [(1, "a", 1, "c")]), keys=["id"])
    with pytest.raises(ValueError, match="no order"):
        merge_runs(spark, path, keyed(spark, [(1, "b", 2, "u")]))


def test_rows_without_key_stay_when_columns_come(spark):
    """Rows of NULL keys are dealt by all columns: a new column moves them, which must lose nothing."""
    path = new_path(spark)
    many = [(None, f"n{i}", 1, "c") for i in range(30)] + [(i, "k", 1, "c") for i in range(30)]
    overwrite_table(spark, path, keyed(spark, many), keys=["id"], buckets=8)
    changes = keyed(spark, [(1, "new", 2, "u")]).withColumn("extra", F.lit(1))
    merge_table(spark, path, changes, ["id"])
    table = read_table(spark, path)
    assert table.count() == 60 and table.where("id IS NULL").count() == 30
