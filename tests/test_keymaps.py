"""Merges that skip folders without a changed key."""

import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import keymaps
from ebbtide.operators.keymaps import add_keymaps, drop_keymaps, folders_with_keys, merge_pruned
from ebbtide.operators.tables import (
    append_table,
    grow_table,
    merge_runs,
    merge_table,
    newest_version,
    overwrite_table,
    read_table,
)
from ebbtide.operators.upkeep import vacuum
from ebbtide.sources.storage import list_names, stored
from tests.helpers import new_path, rows

SHAPE = "id bigint, part string, name string"


def parted(spark, path, data, parts, buckets=3):
    """A table whose buckets have a folder for each part of the rows."""
    for i in range(parts):
        some = spark.createDataFrame(data[i::parts], SHAPE)
        if i:
            append_table(spark, path, some)
        else:
            overwrite_table(spark, path, some, keys=["id", "part"], buckets=buckets)


def changes(spark, data):
    return stored(spark.createDataFrame(data, SHAPE + ", op string"), "changes")


def maps(spark, path):
    return list_names(spark, f"{path}/{keymaps.KEYMAPS}", r"[^/,}]+")


@pytest.mark.parametrize("positions", [1 << 26, 16])
def test_same_rows_as_a_full_merge(spark, monkeypatch, positions):
    """Also where nearly all positions are taken; with NULL keys, deletes, new keys and new columns."""
    monkeypatch.setattr(keymaps, "POSITIONS", positions)
    rng = random.Random(5)
    pruned, full = new_path(spark), new_path(spark)
    data = [(i, rng.choice("ab"), f"n{i}") for i in range(300)] + [(None, "a", "x"), (7, None, "y")]
    for path in (pruned, full):
        parted(spark, path, data, 3)
    for batch in range(3):
        keys = rng.sample(data, 12) + [(1000 + batch, "a", ""), (None, "b", ""), (2000, "a", "")]
        batch_rows = [(i, p, f"b{batch}", "d" if i == 2000 else rng.choice("ucd")) for i, p, _ in keys]
        some = changes(spark, batch_rows)
        if batch == 2:
            some = some.withColumn("more", F.lit(1))
            for path in (pruned, full):
                grow_table(spark, path, newest_version(spark, path).sizeInBytes // 5 + 1)
        new = merge_pruned(spark, pruned, some, ["id", "part"])
        merge_table(spark, full, some, ["id", "part"])
        assert rows(read_table(spark, pruned)) == rows(read_table(spark, full))
        assert positions == 16 or batch == 2 or int(new.operationMetrics["numFilesSkipped"]) > 0


def test_only_folders_of_changed_keys_are_read(spark):
    path = new_path(spark)
    data = [(i, "a", "n") for i in range(400)]
    parted(spark, path, data, 4, buckets=1)
    before = newest_version(spark, path)
    some = changes(spark, [(5, "a", "new", "u"), (9, "a", "", "d"), (1001, "a", "new", "c")])  # of part 1
    held = folders_with_keys(spark, path, before, some, ["0"])["0"]
    assert held == list(before.folders["0"])  # no bitmaps yet
    assert add_keymaps(spark, path) == sorted(held) and add_keymaps(spark, path) == []
    assert folders_with_keys(spark, path, before, some, ["0"])["0"] == held[1:2]
    assert folders_with_keys(spark, path, before, some.where("id > 1000"), ["0"])["0"] == []
    after = merge_pruned(spark, path, some, ["id", "part"])
    kept = set(before.folders["0"]) & set(after.folders["0"])
    assert kept == set(held) - {held[1]} and len(after.folders["0"]) == 4
    skipped = sum(before.folders["0"][f][0] for f in kept)
    assert after.operationMetrics["numFilesSkipped"] == str(skipped)
    got = {r.id: r.name for r in read_table(spark, path).collect()}
    assert len(got) == 400 and got[5] == "new" and 9 not in got and got[1001] == "new"
    assert read_table(spark, path, before.version).count() == 400


def test_edges(spark):
    path = new_path(spark)
    overwrite_table(spark, path, spark.createDataFrame([(None, "a", "x")], SHAPE), keys=["id", "part"], buckets=2)
    none = changes(spark, [])
    assert rows(read_table(spark, path)) == [(None, "a", "x")]
    merge_pruned(spark, path, none, ["id", "part"], "s", 0)
    new = merge_pruned(spark, path, changes(spark, [(1, "a", "one", "c"), (None, "b", "y", "c")]), ["id", "part"], "s", 1)
    assert merge_pruned(spark, path, changes(spark, [(1, "a", "two", "u")]), ["id", "part"], "s", 1).version == new.version
    assert sorted(r.name for r in read_table(spark, path).collect()) == ["one", "x", "y"]
    with pytest.raises(ValueError, match="several changes"):
        merge_pruned(spark, path, changes(spark, [(1, "a", "", "u"), (1, "a", "", "d")]), ["id", "part"])
    runs = new_path(spark)
    overwrite_table(spark, runs, spark.createDataFrame([(1, "a", "x")], SHAPE), keys=["id"], buckets=1, order="name")
    with pytest.raises(ValueError, match="runs"):
        merge_pruned(spark, runs, none, ["id"])
    assert merge_runs(spark, runs, none).version == 1


def test_bitmaps_go_with_their_folders(spark):
    path = new_path(spark)
    parted(spark, path, [(i, "a", "n") for i in range(100)], 2)
    merge_pruned(spark, path, changes(spark, [(1, "a", "new", "u")]), ["id", "part"])
    add_keymaps(spark, path)
    assert len(maps(spark, path)) == 3
    assert drop_keymaps(spark, path) == 0
    overwrite_table(spark, path, spark.createDataFrame([(1, "a", "n")], SHAPE))
    vacuum(spark, path, retention_hours=0)
    assert maps(spark, path) == []
    assert rows(read_table(spark, path)) == [(1, "a", "n")]
