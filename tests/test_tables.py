from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ebbtide.config import DEFAULT
from ebbtide.operators import upkeep
from ebbtide.operators.tables import (
    append_table,
    bucket_of,
    is_versioned,
    list_versions,
    merge_table,
    newest_version,
    overwrite_table,
    publish,
    read_buckets,
    read_table,
    require_version,
    write_buckets,
)
from ebbtide.sources.storage import (
    create_text,
    delete_path,
    list_files,
    list_names,
    path_exists,
    scratch_path,
    stored,
    table_detail,
)
from tests.helpers import new_path, rows


def numbers(spark, start, end, parts=4):
    return spark.range(start, end, 1, parts).select("id", F.concat(F.lit("n"), "id").alias("name"))


def keyed(spark, path, df, buckets=4, **more):
    return overwrite_table(spark, path, df, keys=["id"], buckets=buckets, **more)


def changes(spark, data):
    return stored(spark.createDataFrame(data, "id bigint, name string, op string"), "changes")


def files_read(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_merge_reads_and_rewrites_only_touched_buckets(spark):
    path = new_path(spark)
    first = keyed(spark, path, numbers(spark, 0, 100))
    ids = spark.range(100).select("id", bucket_of(["id"], ["id"], 4).alias("b")).collect()
    bucket = next(r.b for r in ids if r.id == 5)
    other = next(r.id for r in ids if r.b == bucket and r.id != 5)
    assert files_read(read_buckets(spark, path, first, [str(bucket)])) == {f"_b={bucket}"}
    second = merge_table(spark, path, changes(spark, [(5, "five", "u"), (other, "", "d")]), ["id"])
    assert len(first.folders) == 4
    changed = {b for b in first.folders if first.folders[b] != second.folders[b]}
    assert changed == {str(bucket)}
    assert second.operationMetrics == {
        "numUpserts": "1", "numDeletes": "1", "numBucketsRewritten": "1",
    }
    got = {r.id: r.name for r in read_table(spark, path).collect()}
    assert len(got) == 99 and got[5] == "five" and other not in got
    assert read_table(spark, path, version=0).count() == 100


def test_merge_without_changes_keeps_all_folders(spark):
    path = new_path(spark)
    first = keyed(spark, path, numbers(spark, 0, 10))
    second = merge_table(spark, path, changes(spark, [(3, "", None)]), ["id"])
    assert second.folders == first.folders and second.version == 1
    merge_table(spark, path, changes(spark, [(50, "new", "c"), (99, "", "d")]), ["id"])
    assert read_table(spark, path).count() == 11
    with pytest.raises(ValueError, match="dealt by"):
        merge_table(spark, path, changes(spark, [(1, "", "d")]), ["name"])


def test_merge_of_null_keys(spark):
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 10))
    for _ in range(2):
        merge_table(spark, path, changes(spark, [(None, "x", "c")]), ["id"])
    assert read_table(spark, path).filter("id is null").count() == 2


def test_two_changes_of_a_key_are_refused(spark):
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 10))
    with pytest.raises(ValueError, match="several changes"):
        merge_table(spark, path, changes(spark, [(1, "a", "u"), (1, "b", "u")]), ["id"])
    assert list_versions(spark, path) == [0]


def test_replayed_batch_is_skipped(spark):
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 10), source="s", batch_id=0)
    assert keyed(spark, path, numbers(spark, 0, 3), source="s", batch_id=0).version == 0
    assert append_table(spark, path, numbers(spark, 0, 3), "s", 0).version == 0
    for batch_id, expected in ((1, 1), (1, 1), (0, 1), (2, 2)):
        update = changes(spark, [(1, f"b{batch_id}", "u")])
        assert merge_table(spark, path, update, ["id"], "s", batch_id).version == expected
    assert merge_table(spark, path, changes(spark, []), ["id"], "other", 0).version == 3
    assert newest_version(spark, path).applied == {"s": 2, "other": 0}


def test_version_numbers_are_taken_once(spark):
    path = new_path(spark)
    base = overwrite_table(spark, path, numbers(spark, 0, 10))
    with pytest.raises(Exception, match="already exists"):
        publish(spark, path, 0, "WRITE", base.struct_type, {})


def test_unversioned_paths(spark):
    path = new_path(spark)
    assert not is_versioned(spark, path)
    with pytest.raises(ValueError, match="not a versioned table"):
        require_version(spark, path)
    numbers(spark, 0, 10).write.parquet(path)
    with pytest.raises(ValueError, match="not a versioned table"):
        overwrite_table(spark, path, numbers(spark, 0, 10))
    assert upkeep.compact_files(spark, path) == (False, 0, None)
    with pytest.raises(ValueError):
        upkeep.vacuum(spark, path)


def test_unpublished_files_do_not_show(spark):
    path = new_path(spark)
    numbers(spark, 0, 5).write.parquet(f"{path}/data/00000000-lost")
    assert not is_versioned(spark, path)
    overwrite_table(spark, path, numbers(spark, 0, 10))
    assert read_table(spark, path).count() == 10
    assert upkeep.vacuum(spark, path, retention_hours=0) > 0
    assert not list_names(spark, f"{path}/data/00000000-lost", r"[^/,]*\.parquet")
    assert read_table(spark, path).count() == 10


def test_append_adds_columns(spark):
    path = new_path(spark)
    append_table(spark, path, numbers(spark, 0, 2))
    wide = spark.createDataFrame([(9, True)], "id bigint, flag boolean")
    append_table(spark, path, wide)
    assert rows(read_table(spark, path)) == [(0, "n0", None), (1, "n1", None), (9, None, True)]
    with pytest.raises(ValueError, match="type"):
        append_table(spark, path, spark.createDataFrame([("a",)], "flag string"))


def test_torn_version_file_is_not_seen(spark, monkeypatch):
    """A writer lost while it writes leaves nothing under the version's name."""
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 10))
    draft = f"{path}/_versions/.{1:020d}.json.lost"
    create_text(spark, draft, '{"version": 1, "time')
    assert list_versions(spark, path) == [0]
    assert read_table(spark, path).count() == 10
    append_table(spark, path, numbers(spark, 10, 12))
    assert read_table(spark, path).count() == 12


def test_compaction_keeps_rows(spark):
    settings = replace(DEFAULT, max_num_files_allowed=7)
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 50), buckets=2, source="s", batch_id=4)
    for i in range(3):
        before = append_table(spark, path, numbers(spark, 50 + 10 * i, 60 + 10 * i))
    expected = rows(read_table(spark, path))
    assert upkeep.compact_files(spark, path, settings) == (True, 8, 2)
    after = newest_version(spark, path)
    assert (after.version, after.operation, after.numFiles) == (4, "COMPACT", 2)
    assert after.applied == before.applied
    assert rows(read_table(spark, path)) == expected
    for bucket in after.folders:
        held = read_buckets(spark, path, after, [bucket]).select(bucket_of(["id"], ["id"], 2).alias("b"))
        assert {str(r.b) for r in held.collect()} == {bucket}
    assert upkeep.compact_files(spark, path, settings) == (False, 2, None)


def test_compaction_leaves_full_buckets(spark):
    """A bucket with no more files than its bytes need is carried over."""
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 20000), buckets=2)
    ids = spark.range(20000, 20100).select("id", bucket_of(["id"], ["id"], 2).alias("b")).collect()
    one = [r.id for r in ids if r.b == 0][:4]
    for i in one:
        base = append_table(spark, path, numbers(spark, i, i + 1, 1))
    settings = replace(DEFAULT, max_num_files_allowed=3)
    assert upkeep.compact_files(spark, path, settings) == (True, 6, 2)
    after = newest_version(spark, path)
    assert after.folders["1"] == base.folders["1"] and after.folders["0"] != base.folders["0"]
    assert read_table(spark, path).count() == 20004


def test_folders_to_pack():
    mib = 1 << 20
    pack = upkeep.folders_to_pack
    assert pack({"a": [1, 100 * mib], "b": [3, 9 * mib], "c": [1, mib]}, 128 * mib) == (["b", "c"], 1)
    assert pack({"a": [2, 128 * mib]}, 128 * mib) == ([], 0)
    assert pack({"a": [1, mib]}, 128 * mib) == ([], 0)
    assert pack({"a": [10, 300 * mib], "b": [1, 128 * mib]}, 128 * mib) == (["a"], 3)
    assert pack({"a": [1, 0], "b": [1, 0]}, 128 * mib) == (["a", "b"], 1)


@pytest.mark.parametrize("ordered", [False, True])
def test_compaction_keeps_large_folders(spark, ordered):
    """Small folders are packed beside a large one; runs keep their place behind it."""
    path, order = new_path(spark), "at" if ordered else None
    made = lambda a, b, at: numbers(spark, a, b).withColumn("at", F.lit(at))
    overwrite_table(spark, path, made(0, 20000, 0), keys=["id"], buckets=1, order=order)
    first = newest_version(spark, path)
    for i in range(1, 4):
        rows_of = made(20000 if not ordered else 0, 20003 if not ordered else 3, i)
        if ordered:
            # Runs kept apart, as they are before they reach the size that folds them.
            with_runs = newest_version(spark, path)
            added = write_buckets(rows_of, path, with_runs.version + 1, ["id"], 1)
            folders = {"0": {**with_runs.folders["0"], **added["0"]}}
            publish(spark, path, with_runs.version + 1, "MERGE", with_runs.struct_type, folders,
                    keys=["id"], buckets=1, order="at")
        else:
            append_table(spark, path, rows_of)
    expected = rows(read_table(spark, path))
    large = first.sizeInBytes // first.numFiles
    settings = replace(DEFAULT, max_num_files_allowed=1, target_file_bytes=large)
    assert upkeep.compact_files(spark, path, settings)[0]
    after = newest_version(spark, path)
    assert list(after.folders["0"])[0] == list(first.folders["0"])[0] and len(after.folders["0"]) == 2
    assert int(after.operationMetrics["numBytesRewritten"]) < large
    assert rows(read_table(spark, path)) == expected


def test_history(spark):
    path, history = new_path(spark), new_path(spark)
    settings = replace(DEFAULT, max_num_files_allowed=1)
    overwrite_table(spark, path, numbers(spark, 0, 100, 8), "CREATE", {"numUpserts": 100})
    upkeep.compact_files(spark, path, settings)
    assert upkeep.record_history(spark, path, history) == 2
    assert upkeep.record_history(spark, path, history) == 0
    append_table(spark, path, numbers(spark, 0, 1, 1))
    assert upkeep.record_history(spark, path, history) == 1
    got = upkeep.read_history(spark, history)
    assert rows(got, "version", "operation", "numFiles") == [
        (0, "CREATE", 8), (1, "COMPACT", 1), (2, "APPEND", 2),
    ]
    assert got.filter("version = 0").first().operationMetrics == {"numUpserts": "100"}
    assert [r.version for r in upkeep.table_history(spark, path, 2).collect()] == [2, 1]
    assert upkeep.table_history(spark, path, 0).count() == 0
    assert upkeep.table_history(spark, path).count() == 3
    assert got.filter("timestamp is null").count() == 0


def test_manifest(spark):
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 10, 2))
    upkeep.write_manifest(spark, path)
    merge_table(spark, path, changes(spark, [(1, "one", "u")]), ["id"])
    names = [r.value for r in spark.read.text(upkeep.write_manifest(spark, path)).collect()]
    assert len(names) == newest_version(spark, path).numFiles == len(set(names))
    assert rows(spark.read.parquet(*names), "id", "name") == rows(
        read_table(spark, path), "id", "name"
    )


def test_vacuum_respects_retention(spark):
    path = new_path(spark)
    keyed(spark, path, numbers(spark, 0, 100))
    keyed(spark, path, numbers(spark, 0, 50))
    assert upkeep.vacuum(spark, path) == 0
    assert read_table(spark, path, version=0).count() == 100
    assert upkeep.retained_versions(spark, path, datetime.now(timezone.utc)) == [1]
    assert upkeep.vacuum(spark, path, retention_hours=0) == 4
    assert list_versions(spark, path) == [1]
    assert read_table(spark, path).count() == 50
    assert upkeep.vacuum(spark, path, retention_hours=0) == 0


def test_detail_and_listing(spark):
    path = new_path(spark)
    version = overwrite_table(spark, path, numbers(spark, 0, 10, 3))
    detail = table_detail(spark, path).first()
    assert (detail.numFiles, detail.sizeInBytes) == (version.numFiles, version.sizeInBytes)
    plan = list_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_delete_is_guarded(spark):
    path = new_path(spark)
    numbers(spark, 0, 1).write.parquet(f"{path}/a")
    for bad in (path, f"{path}/../x", "/elsewhere"):
        with pytest.raises(ValueError, match="refusing"):
            delete_path(spark, bad, within=path)
    assert delete_path(spark, f"{path}/a", within=path)
    assert not delete_path(spark, f"{path}/a", within=path)
    assert not path_exists(spark, f"{path}/a")


def test_scratch_is_in_the_shared_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir") in scratch_path(spark, "x")
