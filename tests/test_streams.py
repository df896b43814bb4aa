import json
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.address import TableRef
from ebbtide.functions.frames import frame
from ebbtide.operators.changes import current_state
from ebbtide.operators.tables import list_versions, load_version, newest_version, read_table
from ebbtide.operators.upkeep import read_history
from ebbtide.plans.change_logs import AVRO_SCHEMAS, avro_messages, event_changes, json_messages
from ebbtide.plans.pipeline import TableRunsFailed, run_table, run_tables
from ebbtide.plans.queries import _captured
from ebbtide.sources.capture import captured_messages, kafka_messages, tail
from ebbtide.sources.layers import (
    read_layer,
    start_stream,
    stream_layer,
    write_layer,
)
from ebbtide.sources.records import ingest_records, read_records, synthetic_products
from ebbtide.sources.storage import delete_path, list_names, modified, path_exists, set_modified
from ebbtide.streaming.curate import apply_changes, finish_run, read_curated, staged_to_curated
from ebbtide.streaming.land import kafka_to_raw, land_messages, land_topics
from ebbtide.streaming.stage import newest_commit, raw_to_staged, read_staged, stream_commits
from tests.helpers import REF, SAMPLE_KEY, SAMPLE_VALUE, messages, new_lake, new_path, rows, staged

ADDRESS = (REF.project_name, REF.database, REF.table_name)
EVENTS = "event_id bigint, user_id bigint, event_type string, value double, props string, ts timestamp_ntz"


def events(spark, data):
    """(event id, user, type) as the events table has them."""
    filled = [(i, user, kind, float(i), f"p{i}") for i, user, kind in data]
    df = spark.createDataFrame(filled, EVENTS.rsplit(",", 1)[0])
    return df.withColumn("ts", F.timestamp_micros(F.col("event_id") * 1000).cast("timestamp_ntz"))


def capture(spark, settings, df):
    df.coalesce(1).write.mode("append").parquet(settings.url("capture"))


def run(spark, settings, environment="local", content_type="avro"):
    source = lambda ref: captured_messages(spark, settings.url("capture"), ref.topic, settings)
    run_table(spark, REF, environment, content_type, source, settings)


def curated(spark, settings):
    return read_curated(spark, REF.path("curated", settings))


def test_runs_resume_and_evolve(spark):
    settings = new_lake(spark)
    path = REF.path("curated", settings)

    capture(spark, settings, avro_messages(event_changes(events(spark, [(0, 1, "signup"), (2, 2, "view")]))))
    run(spark, settings)
    assert "revision" not in curated(spark, settings).columns
    assert rows(curated(spark, settings), "id", "name", "op") == [(1, "signup", "c"), (2, "view", "r")]

    run(spark, settings)  # nothing new
    assert list_versions(spark, path) == [0]

    later = [(3, 3, "click"), (4, 2, "error"), (5, 1, "purchase")]
    capture(spark, settings, avro_messages(event_changes(events(spark, later))))
    run(spark, settings)
    assert rows(curated(spark, settings), "id", "name", "revision", "op") == [
        (1, "purchase", 5, "u"), (3, "click", 3, "u"),
    ]
    assert rows(curated(spark, settings).select("id", "weight")) == [(1, 5.0), (3, 3.0)]

    capture(spark, settings, avro_messages(event_changes(events(spark, [(6, 9, "signup")]))))
    run(spark, settings)
    assert rows(curated(spark, settings), "id", "revision") == [(1, 5), (3, 3), (9, None)]

    history = read_history(spark, REF.history("curated", settings))
    assert rows(history, "version", "operation") == [(0, "CREATE"), (1, "MERGE"), (2, "MERGE")]
    assert list_names(spark, f"{path}/_symlink_format_manifest", r"part-[^,}]*")
    control = settings.url(settings.spark_control)
    assert not list_names(spark, f"{control}/_work", r"[^/,}]+")

    # The curated table is gone: all of staged is applied again.
    expected = rows(curated(spark, settings), "id", "name", "op")
    delete_path(spark, path, within=settings.url(settings.curated))
    staged_to_curated(spark, *ADDRESS, settings=settings)
    assert rows(curated(spark, settings), "id", "name", "op") == expected


def dated_back(spark, folder, days, known=()):
    """Date the files of a folder that are not yet known; returns all their names."""
    names = list_names(spark, folder, r"part-[^/,}]+\.parquet")
    for name in set(names) - set(known):
        set_modified(spark, f"{folder}/{name}", modified(spark, f"{folder}/{name}") - days * 86_400)
    return names


def test_old_files_are_not_lost(spark):
    """Files older than Spark's default age: captured ones, those of a layer, and staged ones."""
    settings = new_lake(spark)
    folder, known = settings.url("capture"), []
    for i, days in enumerate([0, 10, 0, 400]):
        capture(spark, settings, avro_messages(event_changes(events(spark, [(i, i, "signup")]))))
        known = dated_back(spark, folder, days, known)
        land_messages(captured_messages(spark, folder, settings=settings), "raw", REF, settings)
        assert read_layer(spark, "raw", REF, settings=settings).count() == i + 1
        raw_to_staged(spark, *ADDRESS, "local", "avro", settings)
        assert read_staged(spark, REF, settings).count() == i + 1
        staged_folder = REF.path("staged", settings)
        for name in list_names(spark, staged_folder, r"[0-9a-f-]{36}-\d+"):
            dated_back(spark, f"{staged_folder}/{name}", days)
        staged_to_curated(spark, *ADDRESS, settings=settings)
        assert [r[0] for r in rows(curated(spark, settings), "id")] == list(range(i + 1))

    other, known = TableRef("a", "b", "layer"), []
    for i, days in enumerate([0, 30]):
        write_layer(spark.range(i, i + 1).coalesce(1), "raw", other, mode="append", settings=settings)
        known = dated_back(spark, other.path("raw", settings), days, known)
        stream = stream_layer(spark, "raw", other, schema="id long", settings=settings)
        writer = stream.writeStream.format("parquet").trigger(availableNow=True)
        start_stream(writer, "staged", other, settings).awaitTermination()
    assert rows(read_layer(spark, "staged", other, settings=settings)) == [(0,), (1,)]


def test_followers_read_named_folders_only(spark):
    """What lies in staged without a commit takes no part, and no data folder is listed again."""
    settings = new_lake(spark)
    capture(spark, settings, avro_messages(event_changes(events(spark, [(0, 1, "signup")]))))
    run(spark, settings)
    stray = staged(spark, [(9, "c", "stray", 9, 9)])
    stray.write.parquet(f"{REF.path('staged', settings)}/stray-0")
    capture(spark, settings, avro_messages(event_changes(events(spark, [(2, 2, "view")]))))
    run(spark, settings)
    assert rows(curated(spark, settings), "id", "name") == [(1, "signup"), (2, "view")]
    commits = stream_commits(spark, REF, settings)
    assert commits.isStreaming and commits.columns == ["value"]
    files = list_names(spark, f"{REF.path('staged', settings)}/_commits", r"\d{20}\.json")
    assert len(files) == 2


def test_many_batches_in_one_run(spark):
    settings = new_lake(spark, max_files_per_trigger=1, vacuum_every_versions=2)
    for i, kind in enumerate(["signup", "click", "error", "purchase"]):
        capture(spark, settings, avro_messages(event_changes(events(spark, [(i, 1, kind), (10 + i, i, "view")]))))
    run(spark, settings)
    assert list_versions(spark, REF.path("curated", settings)) == [0, 1, 2, 3]
    # The view of user 1 is the newest event, though it came before the purchase.
    got = {r.id: r.name for r in curated(spark, settings).collect()}
    assert got == {0: "view", 1: "view", 2: "view", 3: "view"}


@given(
    log=st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from("cudr"), st.integers(0, 2)), min_size=2, max_size=9
    ),
    seed=st.integers(0, 99),
)
@hypothesis_settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
def test_batches_in_any_order(spark, log, seed):
    """Changes dealt to batches that come in random order give what one batch gives."""
    numbered = [(k, op, f"n{i}", i, i, part) for i, (k, op, part) in enumerate(log)]
    expected = rows(current_state(staged(spark, [x[:5] for x in numbered])))
    path, lake = new_path(spark), new_lake(spark, buckets=2)
    parts = sorted({x[5] for x in numbered})
    random.Random(seed).shuffle(parts)
    for number, part in enumerate(parts):
        batch = [x[:5] for x in numbered if x[5] == part]
        for _ in range(2):
            apply_changes(staged(spark, batch), path, "s", number, lake)
    assert rows(read_curated(spark, path)) == expected


def test_marks_of_deleted_rows_expire(spark):
    path, lake = new_path(spark), new_lake(spark, buckets=1, vacuum_retention_hours=0)
    apply_changes(staged(spark, [(1, "c", "a", 1, 1)]), path, "s", 0, lake)
    apply_changes(staged(spark, [(1, "d", "a", 2, 2)]), path, "s", 1, lake)
    apply_changes(staged(spark, [(2, "c", "b", 3, 3)]), path, "s", 2, lake)
    assert rows(read_curated(spark, path)) == [(2, "b", "c")]
    assert read_table(spark, path).count() == 1


def test_tombstones_are_skipped_and_counted(spark):
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1), (SAMPLE_KEY, None, 2), (None, None, 3)]))
    run(spark, settings, "sample")
    assert read_layer(spark, "raw", REF, settings=settings).count() == 3
    commit = newest_commit(spark, REF.path("staged", settings))
    assert (commit.rows, commit.tombstones) == (1, 2)
    assert rows(curated(spark, settings)) == [(1001, "ab", 2.5, "c")]


def test_value_without_key_fails(spark):
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(None, SAMPLE_VALUE, 1)]))
    with pytest.raises(Exception, match="no key"):
        run(spark, settings, "sample")


def test_only_tombstones(spark):
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(SAMPLE_KEY, None, 2)]))
    run(spark, settings, "sample")
    assert not path_exists(spark, REF.path("curated", settings))


def test_failed_batch_is_done_again(spark):
    """A batch that died before its commit is replaced, not added."""
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1)]))
    unknown = replace(settings, schema_registry={"sample": {1: AVRO_SCHEMAS[1]}})
    with pytest.raises(Exception, match="schema id 2 is not registered"):
        run(spark, unknown, "sample")
    run(spark, settings, "sample")
    assert read_staged(spark, REF, settings).count() == 1
    assert rows(curated(spark, settings)) == [(1001, "ab", 2.5, "c")]


def test_same_batch_twice(spark):
    path = new_path(spark)
    settings = new_lake(spark)
    first = staged(spark, [(1, "c", "a", 1, 1), (2, "c", "b", 1, 2)])
    assert apply_changes(first, path, "s", 0, settings)
    assert not apply_changes(first, path, "s", 0, settings)
    second = staged(spark, [(1, "d", "a", 2, 3)])
    assert apply_changes(second, path, "s", 1, settings)
    assert not apply_changes(second, path, "s", 1, settings)
    assert rows(read_curated(spark, path)) == [(2, "b", "c")]
    assert newest_version(spark, path).version == 1


def test_first_batch_of_deletes_only(spark):
    path, settings = new_path(spark), new_lake(spark)
    apply_changes(staged(spark, [(1, "d", "a", 1, 1)]), path, "s", 0, settings)
    assert read_curated(spark, path).count() == 0
    apply_changes(staged(spark, [(1, "c", "a", 2, 2)]), path, "s", 1, settings)
    assert rows(read_curated(spark, path)) == [(1, "a", "c")]


def test_compaction_within_a_run(spark):
    path = new_path(spark)
    settings = new_lake(spark, max_num_files_allowed=3, buckets=2)
    for i in range(4):
        apply_changes(staged(spark, [(i, "c", "a", i, i)]), path, "s", i, settings)
    operations = [load_version(spark, path, v).operation for v in list_versions(spark, path)]
    assert operations == ["CREATE", "MERGE", "MERGE", "MERGE"]  # a merge leaves one file a bucket
    newest = newest_version(spark, path)
    assert newest.numFiles <= 2
    assert newest.applied == {"s": 3}
    assert read_curated(spark, path).count() == 4


def test_upkeep_only_after_new_versions(spark):
    path, settings = new_path(spark), new_lake(spark)
    apply_changes(staged(spark, [(1, "c", "a", 1, 1)]), path, "s", 0, settings)
    finish_run(spark, path, 0, 0, settings)
    assert not path_exists(spark, f"{path}/_symlink_format_manifest")
    finish_run(spark, path, -1, 0, settings)
    assert path_exists(spark, f"{path}/_symlink_format_manifest")


def test_nothing_staged(spark):
    settings = new_lake(spark)
    staged_to_curated(spark, *ADDRESS, settings=settings)
    assert not path_exists(spark, REF.path("curated", settings))
    with pytest.raises(ValueError, match="nothing is staged"):
        read_staged(spark, REF, settings)


def test_unknown_content_type(spark):
    with pytest.raises(NotImplementedError, match="xml"):
        raw_to_staged(spark, *ADDRESS, "local", "xml", new_lake(spark))


def test_tables_are_independent(spark):
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1)]))
    bad = messages(spark, [(b"junk", SAMPLE_VALUE, 1)]).withColumn("topic", F.lit("a.b.bad"))
    capture(spark, settings, bad)
    source = lambda ref: captured_messages(spark, settings.url("capture"), ref.topic)
    with pytest.raises(TableRunsFailed) as failure:
        run_tables(spark, ["a.b.bad", REF], "sample", "avro", source, settings)
    assert list(failure.value.errors) == [TableRef("a", "b", "bad")]
    assert curated(spark, settings).count() == 1
    with pytest.raises(ValueError):
        run_tables(spark, ["a.b"], "sample", "avro", source, settings)


def test_one_stream_lands_many_topics(spark):
    settings = new_lake(spark, max_files_per_trigger=1)
    other = TableRef("a", "b", "second")
    for start in (0, 10):
        sent = messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, start + i) for i in range(3)])
        capture(spark, settings, sent.withColumn("topic", F.when(F.col("offset") % 2 == 1, other.topic).otherwise(REF.topic)))
    shared = captured_messages(spark, settings.url("capture"), settings=settings)
    for _ in range(2):
        run_tables(spark, [REF, other], "sample", "avro", settings=settings, shared=shared)
    landed = {
        ref: spark.read.option("recursiveFileLookup", "true").parquet(ref.path("raw", settings)).count()
        for ref in (REF, other)
    }
    assert landed == {REF: 4, other: 2}
    assert read_staged(spark, other, settings).count() == 2
    assert rows(curated(spark, settings)) == [(1001, "ab", 2.5, "c")]


def test_kafka_needs_its_connector(spark):
    for start in (
        lambda: kafka_messages(spark, "localhost:1", REF.topic),
        lambda: kafka_to_raw(spark, "raw", "localhost:1", REF.topic, new_lake(spark)),
    ):
        with pytest.raises(Exception, match="(?i)kafka"):
            start()
    with pytest.raises(ValueError, match="project.database.table"):
        kafka_to_raw(spark, "raw", "localhost:1", "two.parts")


def test_tail(spark, capfd):
    settings = new_lake(spark)
    capture(spark, settings, messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 77)]))
    assert not tail(captured_messages(spark, settings.url("capture"))).isActive


def test_start_stream_options(spark):
    settings = new_lake(spark)
    write_layer(spark.range(5), "raw", REF, settings=settings)

    def copy(layer, ref, **options):
        stream = stream_layer(spark, "raw", REF, schema="id long", settings=settings)
        writer = stream.writeStream.format("parquet").trigger(availableNow=True)
        start_stream(writer, layer, ref, settings, **options).awaitTermination()

    copy("staged", REF)
    assert path_exists(spark, REF.checkpoint("staged", settings))
    other = settings.url("elsewhere")
    copy("curated", REF, checkpointLocation=f"{other}/ck")
    assert path_exists(spark, f"{other}/ck")
    assert not path_exists(spark, REF.checkpoint("curated", settings))
    copy(None, None, path=f"{other}/data", checkpointLocation=f"{other}/ck2")
    assert spark.read.parquet(f"{other}/data").count() == 5


def test_raw_keeps_bytes(spark):
    settings = new_lake(spark)
    sent = messages(spark, [(SAMPLE_KEY, SAMPLE_VALUE, 1), (b"junk", b"", 2), (None, None, 3)])
    capture(spark, settings, sent)
    land_messages(captured_messages(spark, settings.url("capture")), "raw", REF, settings)
    got = read_layer(spark, "raw", REF, settings=settings)
    assert got.schema == sent.schema
    assert rows(got) == rows(sent)


def test_write_modes(spark):
    settings = new_lake(spark)
    write_layer(spark.range(5), "raw", REF, settings=settings)
    with pytest.raises(Exception, match="(?i)exists"):
        write_layer(spark.range(5), "raw", REF, settings=settings)
    write_layer(spark.range(3), "raw", REF, mode="overwrite", settings=settings)
    assert read_layer(spark, "raw", REF, settings=settings).count() == 3


def test_record_lists(spark):
    settings = new_lake(spark)
    folder = settings.url("records")
    text = json.dumps({"results": [{"name": "a", "url": "u1"}, {"name": "b", "url": "u2"}]})
    spark.createDataFrame([(text,)], "value string").write.text(folder)
    assert rows(read_records(spark, folder)) == [("a", "u1"), ("b", "u2")]
    ingest_records(spark, folder, "raw", REF, settings=settings)
    ingest_records(spark, folder, "raw", REF, settings=settings)
    assert read_layer(spark, "raw", REF, settings=settings).count() == 2


def test_synthetic_products(spark):
    df = synthetic_products(spark, 1000)
    assert df.dropDuplicates(["name", "description"]).count() == 1000
    low, high, parts = df.agg(
        F.min("weight"), F.max("weight"), F.min(F.length("name"))
    ).first()
    assert 0 <= low < high < 1_000_000 and parts == 32
    assert rows(df) == rows(synthetic_products(spark, 1000).repartition(7))


def test_frame_of_other_schema_ids(spark):
    df = spark.createDataFrame([(7, b"x")], "id int, body binary")
    assert bytes(df.select(frame(F.col("id"), F.col("body"))).first()[0]) == b"\x00\x00\x00\x00\x07x"


def test_raw_messages_are_read_by_many_tasks(spark):
    """Messages compress so well that a default row group, which one task reads, would hold all of these."""
    settings = new_lake(spark)
    ids = F.col("id")
    made = spark.range(150_000).select(
        ids.alias("event_id"), (ids % 1000).alias("user_id"), F.lit("view").alias("event_type"),
        ids.cast("double").alias("value"), F.sha2(ids.cast("string"), 256).alias("props"),
        F.timestamp_micros(ids).cast("timestamp_ntz").alias("ts"),
    )
    captured = json_messages(event_changes(made)).withColumn("topic", F.lit(REF.topic))
    capture(spark, settings, captured)  # one file of one row group
    land_topics(captured_messages(spark, settings.url("capture"), settings=settings), "raw", "all", settings)
    landed = read_layer(spark, "raw", REF, settings=settings, recursiveFileLookup="true")
    again = replace(settings, base=settings.base + "again/")
    _captured(captured.coalesce(1), again.url("capture"))
    land_messages(captured_messages(spark, again.url("capture"), REF.topic, again), "raw", REF, again)
    for raw in (landed, read_layer(spark, "raw", REF, settings=again)):
        found = raw.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in found) == 150_000
        assert len(found) >= 3 and max(r["count"] for r in found) < 75_000
