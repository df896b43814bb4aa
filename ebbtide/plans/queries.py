"""Registered queries: every operator of the lake over whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings
from ebbtide.functions.envelopes import decode_frames, decode_json_messages
from ebbtide.functions.frames import frame, split_frames
from ebbtide.functions.topics import topic_parts, topic_path
from ebbtide.operators.changes import (
    change_rows,
    current_state,
    latest_per_key,
    merge_changes,
    route_schema_pair,
    schema_pairs,
)
from ebbtide.operators.keymaps import merge_pruned
from ebbtide.operators.tables import (
    append_table,
    grow_table,
    merge_table,
    newest_version,
    overwrite_table,
    read_table,
)
from ebbtide.operators.upkeep import (
    compact_files,
    read_history,
    table_history,
    vacuum,
    write_manifest,
)
from ebbtide.operators.versions import version_changes as changes_between
from ebbtide.plans.change_logs import (
    AVRO_SCHEMAS,
    CONNECT_KEY,
    CONNECT_VALUES,
    LINE_ORDER,
    TOPIC,
    avro_messages,
    event_changes,
    json_messages,
    order_changes,
    protobuf_messages,
    protobuf_schemas,
)
from ebbtide.plans.pipeline import run_table, run_tables
from ebbtide.sources.capture import SMALL_ROW_GROUPS, captured_messages, without_resent
from ebbtide.sources.layers import (
    read_layer,
    read_layer_evolving,
    start_stream,
    stream_layer,
    write_layer,
)
from ebbtide.sources.records import generate_products, ingest_records
from ebbtide.sources.storage import (
    delete_path,
    list_names,
    modified,
    scratch_path,
    set_modified,
    stored,
    table_detail,
)
from ebbtide.streaming.curate import apply_changes, read_curated, staged_to_curated
from ebbtide.streaming.land import land_messages
from ebbtide.streaming.stage import raw_to_staged, read_staged

Query = Callable[[SparkSession, str], DataFrame]

PRODUCTS = TableRef.from_topic(TOPIC)
IMAGE = ["id", "name", "weight", "description", "revision"]
CHANGE_BATCHES = 4
MAX_ID = 2**31 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_changes(table(spark, sf_dir, "events"))


def lake(spark: SparkSession, name: str) -> Settings:
    """Settings of a fresh lake in the session's shared folder."""
    protocol, _, base = scratch_path(spark, name).partition(":")
    return replace(
        DEFAULT,
        prefix_protocol=protocol,
        base="/" + base.lstrip("/") + "/" if protocol == "file" else base.lstrip("/") + "/",
        schema_registry={"local": AVRO_SCHEMAS},
    )


# --- change logs ---------------------------------------------------------


def cdc_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_changes(spark, sf_dir)).select(
        F.col("key.id").alias("id"),
        F.col("value.op").alias("op"),
        F.col("offset").alias("offset_no"),
        F.col("timestamp").alias("changed_at"),
        "valueSchemaId",
    )


def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(_changes(spark, sf_dir)).select(*IMAGE, "op")


def cdc_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_rows(_changes(spark, sf_dir)).select(*IMAGE, "op")


def cdc_merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("weight"),
        F.col("c_mktsegment").alias("description"),
    )
    changes = change_rows(latest_per_key(_changes(spark, sf_dir)))
    return merge_changes(customers, changes, ["id"]).select(*IMAGE, "op")


def cdc_delete_without_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes that log the key only, merged into the state before them."""
    changes = _changes(spark, sf_dir)
    image = changes.schema["value"].dataType["before"].dataType
    bare = F.col("value").withField("before", F.lit(None).cast(image))
    staged = changes.withColumn("value", bare)
    half = changes.agg(F.expr("(min(offset) + max(offset)) div 2")).first()[0]
    first = current_state(staged.where(F.col("offset") <= half))
    later = change_rows(latest_per_key(staged.where(F.col("offset") > half)))
    return merge_changes(first, later, ["id"]).select(*IMAGE, "op")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(table(spark, sf_dir, "lineitem"))
    return latest_per_key(changes, "o_orderkey", LINE_ORDER).select(*ORDER_COLUMNS, "op")


def cdc_merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return merge_changes(orders, _order_changes(spark, sf_dir), ["o_orderkey"]).select(
        *ORDER_COLUMNS, "o_orderpriority", "op"
    )


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def cdc_merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished lines as they first were, after all their changes."""
    lines = table(spark, sf_dir, "lineitem")
    oldest = [F.col(c).asc() for c in LINE_ORDER]
    target = latest_per_key(lines.filter("l_linestatus = 'F'"), LINE_KEY, oldest)
    op = F.when(F.col("l_returnflag") == "R", "d").otherwise("u").alias("op")
    changes = latest_per_key(lines, LINE_KEY, LINE_ORDER).select(*LINE_KEY, *LINE_COLUMNS, op)
    return merge_changes(target.select(*LINE_KEY, *LINE_COLUMNS), changes, LINE_KEY)


def cdc_schema_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_pairs(_changes(spark, sf_dir))


def cdc_schema_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all schema pairs as one table: the merged type holds every pair's fields."""
    image = F.coalesce("value.after", "value.before")
    return _changes(spark, sf_dir).select(
        F.col("offset").alias("offset_no"), "valueSchemaId", *[image[f].alias(f) for f in IMAGE]
    )


# --- frames and envelopes ------------------------------------------------


def frame_decode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    key_id = ((F.col("user_id") + 1) % MAX_ID).cast("int")
    value_id = (F.col("event_id") * 1000 % MAX_ID).cast("int")
    framed = events.select(
        "event_id",
        frame(key_id, F.col("event_type").cast("binary")).alias("key"),
        frame(value_id, F.col("props").cast("binary")).alias("value"),
    )
    return split_frames(framed).select(
        "event_id",
        "keySchemaId",
        "valueSchemaId",
        F.col("key").cast("string").alias("key_text"),
        F.col("value").cast("string").alias("value_text"),
    )


def _flat(staged: DataFrame, fields: list[str] = IMAGE) -> DataFrame:
    return staged.select(
        F.col("offset").alias("offset_no"),
        F.col("key.id").alias("key_id"),
        F.col("value.op").alias("op"),
        *[F.col(f"value.before.{f}").alias(f"before_{f}") for f in fields],
        *[F.col(f"value.after.{f}").alias(f"after_{f}") for f in fields],
    )


def avro_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = split_frames(avro_messages(_changes(spark, sf_dir)))
    key_schemas = {1: AVRO_SCHEMAS[1]}
    value_schemas = {i: AVRO_SCHEMAS[i] for i in (2, 3)}
    return _flat(decode_frames(spark, messages, key_schemas, value_schemas))


def protobuf_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = split_frames(protobuf_messages(_changes(spark, sf_dir)))
    texts = protobuf_schemas()
    staged = decode_frames(spark, messages, {1: texts[1]}, {2: texts[2]}, "protobuf")
    return _flat(staged, IMAGE[:-1])


def json_envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = json_messages(_changes(spark, sf_dir))
    return _flat(decode_json_messages(messages, [CONNECT_KEY], list(CONNECT_VALUES.values())))


def topic_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.concat_ws(".", F.lit("dbserver1"), "source", "lang")
    documents = table(spark, sf_dir, "documents").select("doc_id", topic.alias("topic"))
    return documents.select(
        "doc_id",
        topic_parts(F.col("topic")).alias("address"),
        topic_path(F.col("topic"), "raw").alias("raw_path"),
    ).select("doc_id", "address.*", "raw_path")


def synthetic_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_products(table(spark, sf_dir, "orders"), "o_orderkey")


# --- tables by address ---------------------------------------------------


def layer_roundtrip(name: str, fmt: str) -> Query:
    """Write a table by address and read it back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings = lake(spark, f"roundtrip-{fmt}")
        ref = TableRef("shop", "public", name)
        rows = table(spark, sf_dir, name)
        write_layer(rows, "curated", ref, fmt, settings=settings)
        schema = None if fmt in ("parquet", "orc") else rows.schema
        return read_layer(spark, "curated", ref, fmt, schema, settings)

    return query


def layer_roundtrip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files hold one column: each row goes in as one JSON text."""
    settings = lake(spark, "roundtrip-text")
    ref = TableRef("shop", "public", "documents")
    rows = table(spark, sf_dir, "documents")
    write_layer(rows.select(F.to_json(F.struct("*")).alias("value")), "raw", ref, "text", settings=settings)
    lines = read_layer(spark, "raw", ref, "text", settings=settings)
    return lines.select(F.from_json("value", rows.schema).alias("row")).select("row.*")


def layer_stream(name: str, fmt: str, **options: str) -> Query:
    """Write a table by address, stream it into another layer, read that."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings = lake(spark, f"stream-{fmt}")
        ref = TableRef("shop", "public", name)
        rows = table(spark, sf_dir, name)
        as_text = rows.select(F.to_json(F.struct("*")).alias("value"))
        write_layer(as_text if fmt == "text" else rows, "raw", ref, fmt, settings=settings)
        schema = None if fmt == "text" else rows.schema
        stream = stream_layer(spark, "raw", ref, fmt, schema, settings, **options)
        writer = stream.writeStream.format("parquet").trigger(availableNow=True)
        start_stream(writer, "staged", ref, settings).awaitTermination()
        copied = read_layer(spark, "staged", ref, settings=settings)
        if fmt != "text":
            return copied
        return copied.select(F.from_json("value", rows.schema).alias("row")).select("row.*")

    return query


def append_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append files of a wider schema; older rows get NULL."""
    settings = lake(spark, "evolution")
    changes = _changes(spark, sf_dir)
    for value_schema, fields in ((2, IMAGE[:-1]), (3, IMAGE)):
        rows = change_rows(route_schema_pair(changes, 1, value_schema))
        write_layer(rows.select(*fields, "op"), "staged", PRODUCTS, mode="append", settings=settings)
    return read_layer_evolving(spark, "staged", PRODUCTS, settings).select(*IMAGE, "op")


def record_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = lake(spark, "records")
    records, ref = TableRef("chat", "files", "records"), TableRef("chat", "files", "turns")
    folder = write_layer(
        table(spark, sf_dir, "conversations"), "raw", records, "json", settings=settings
    )
    ingest_records(spark, folder, "raw", ref, settings=settings)
    return read_layer(spark, "raw", ref, settings=settings)


# --- versioned tables ----------------------------------------------------


def _orders_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = TableRef("shop", "public", "orders").path("curated", lake(spark, name))
    orders = table(spark, sf_dir, "orders")
    overwrite_table(spark, path, orders, "CREATE", keys=["o_orderkey"], buckets=DEFAULT.buckets)
    return path


def table_merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy-on-write merge, then clean-up of what only old versions need."""
    path = _orders_table(spark, sf_dir, "merge")
    merge_table(spark, path, stored(_order_changes(spark, sf_dir), "changes"), ["o_orderkey"])
    vacuum(spark, path, retention_hours=0)
    return read_table(spark, path).select(*ORDER_COLUMNS, "o_orderpriority", "op")


def table_grown_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table that was given more buckets, and one after it got yet more."""
    path = _orders_table(spark, sf_dir, "grown")
    changes = stored(_order_changes(spark, sf_dir), "changes")
    for half in range(2):
        size = newest_version(spark, path).sizeInBytes
        grow_table(spark, path, -(-size // (DEFAULT.buckets + 3 + 7 * half)))
        merge_table(spark, path, changes.where(F.col("o_orderkey") % 2 == half), ["o_orderkey"])
    return read_table(spark, path).select(*ORDER_COLUMNS, "o_orderpriority", "op")


def merge_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes whose column has a wider type than the table's."""
    path = TableRef("shop", "public", "orders").path("curated", lake(spark, "widened"))
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("int"))
    overwrite_table(spark, path, orders, "CREATE", keys=["o_orderkey"], buckets=DEFAULT.buckets)
    merge_table(spark, path, stored(_order_changes(spark, sf_dir), "changes"), ["o_orderkey"])
    return read_table(spark, path).select(*ORDER_COLUMNS, "o_orderpriority", "op")


def merge_pruned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four merges into a table of four folders a bucket, each with the changes of one folder's keys."""
    path = TableRef("shop", "public", "orders").path("curated", lake(spark, "pruned"))
    orders = table(spark, sf_dir, "orders")
    for part in range(4):
        rows = orders.where(F.col("o_orderkey") % 4 == part)
        if part:
            append_table(spark, path, rows)
        else:
            overwrite_table(spark, path, rows, "CREATE", keys=["o_orderkey"], buckets=DEFAULT.buckets)
    changes = stored(_order_changes(spark, sf_dir), "changes")
    skipped = []
    for part in range(4):
        new = merge_pruned(spark, path, changes.where(F.col("o_orderkey") % 4 == part), ["o_orderkey"])
        skipped.append(int(new.operationMetrics["numFilesSkipped"]))
    rows = read_table(spark, path).select(*ORDER_COLUMNS, "o_orderpriority", "op")
    return rows.withColumn("always_skipped", F.lit(min(skipped) > 0))


def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a merge made differ, found from the folders of two versions with a split between."""
    path = _orders_table(spark, sf_dir, "version-changes")
    merge_table(spark, path, stored(_order_changes(spark, sf_dir), "changes"), ["o_orderkey"])
    size = newest_version(spark, path).sizeInBytes
    new = grow_table(spark, path, -(-size // (DEFAULT.buckets + 1))).version
    found = changes_between(spark, path, 0, new)
    return found.select(
        F.coalesce("before.o_orderkey", "after.o_orderkey").alias("o_orderkey"),
        "change",
        F.col("before.o_totalprice").alias("price_before"),
        F.col("after.o_totalprice").alias("price_after"),
        F.col("after.op").alias("op"),
    )


def table_append_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended rows with other columns than the table."""
    path = _orders_table(spark, sf_dir, "append")
    append_table(spark, path, _order_changes(spark, sf_dir))
    return read_table(spark, path).select(*ORDER_COLUMNS, "o_orderpriority", "op")


def table_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version after a merge made a second one."""
    path = _orders_table(spark, sf_dir, "travel")
    merge_table(spark, path, stored(_order_changes(spark, sf_dir), "changes"), ["o_orderkey"])
    return read_table(spark, path, version=0)


def append_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch appended twice, the second time in vain."""
    path = TableRef("shop", "public", "orders").path("curated", lake(spark, "append-replay"))
    orders = table(spark, sf_dir, "orders")
    for batch in range(3):
        for _ in range(2):
            append_table(spark, path, orders.where(F.col("o_orderkey") % 3 == batch), "orders", batch)
    return read_table(spark, path)


def _scattered(spark: SparkSession, sf_dir: str, name: str) -> tuple[Settings, str]:
    """A table of parts in more files than its limit of eight."""
    settings = replace(lake(spark, name), max_num_files_allowed=8)
    path = TableRef("shop", "public", "part").path("curated", settings)
    part = table(spark, sf_dir, "part")
    for batch in range(4):
        rows = part.where(F.col("p_partkey") % 4 == batch)
        if batch:
            append_table(spark, path, rows)
        else:
            overwrite_table(spark, path, rows, "CREATE", keys=["p_partkey"], buckets=4)
    return settings, path


def compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files into few: the rows stay."""
    settings, path = _scattered(spark, sf_dir, "compact")
    compact_files(spark, path, settings)
    return read_table(spark, path)


def compaction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What compaction and clean-up did: files and rows of both versions, folders deleted."""
    settings, path = _scattered(spark, sf_dir, "compaction-report")
    rows_before = read_table(spark, path).count()
    _, files_before, files_after = compact_files(spark, path, settings)
    gone = vacuum(spark, path, retention_hours=0)
    left = len(list_names(spark, f"{path}/_versions", r"\d{20}\.json"))
    numbers = {
        "rows_before": rows_before,
        "files_before": files_before,
        "files_after": files_after,
        "folders_deleted": gone,
        "versions_left": left,
    }
    return read_table(spark, path).agg(F.count("*").alias("rows_after")).select(
        "*", *(F.lit(n).cast("bigint").alias(name) for name, n in numbers.items())
    )


def compact_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What packing did to a table of large files and small ones: the large ones stay."""
    settings = replace(lake(spark, "compact-packed"), max_num_files_allowed=8)
    path = TableRef("shop", "public", "orders").path("curated", settings)
    orders = table(spark, sf_dir, "orders")
    first = overwrite_table(
        spark, path, orders.where("o_orderkey % 8 != 0"), "CREATE", keys=["o_orderkey"], buckets=2
    )
    for part in range(4):
        before = append_table(spark, path, orders.where(f"o_orderkey % 32 = {8 * part}"))
    settings = replace(settings, target_file_bytes=first.sizeInBytes // first.numFiles)
    compact_files(spark, path, settings)
    after = newest_version(spark, path)
    kept = {(b, f) for b, some in after.folders.items() for f in some if f in before.folders[b]}
    small = sum(
        size for b, some in before.folders.items() for f, (_, size) in some.items() if (b, f) not in kept
    )
    numbers = {"files_before": before.numFiles, "files_after": after.numFiles, "folders_kept": len(kept)}
    return read_table(spark, path).agg(F.count("*").alias("rows_after"), F.sum("o_orderkey").alias("keys_after")).select(
        "*",
        *(F.lit(n).cast("bigint").alias(name) for name, n in numbers.items()),
        F.lit(int(after.operationMetrics["numBytesRewritten"]) == small).alias("only_small_rewritten"),
    )


def table_detail_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail of a table: the files listed are those that its newest version counts."""
    path = _orders_table(spark, sf_dir, "detail")
    version = newest_version(spark, path)
    return table_detail(spark, path).select(
        F.lit(read_table(spark, path).count()).cast("bigint").alias("rows"),
        (F.col("numFiles") == version.numFiles).alias("same_files"),
        (F.col("sizeInBytes") == version.sizeInBytes).alias("same_bytes"),
    )


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files the reader manifest names, after a merge."""
    path = _orders_table(spark, sf_dir, "manifest")
    merge_table(spark, path, stored(_order_changes(spark, sf_dir), "changes"), ["o_orderkey"])
    names = [row.value for row in spark.read.text(write_manifest(spark, path)).collect()]
    schema = newest_version(spark, path).struct_type
    return spark.read.schema(schema).parquet(*names).select(
        *ORDER_COLUMNS, "o_orderpriority", "op"
    )


# --- streams -------------------------------------------------------------


def batches(changes: DataFrame) -> list[DataFrame]:
    """Even ranges of the offsets, in order."""
    low, high = changes.agg(F.min("offset"), F.max("offset")).first()
    cuts = [low + (high + 1 - low) * i // CHANGE_BATCHES for i in range(CHANGE_BATCHES + 1)]
    return [
        changes.filter((F.col("offset") >= start) & (F.col("offset") < end))
        for start, end in zip(cuts, cuts[1:])
    ]


def _capture(spark: SparkSession, settings: Settings):
    """Folder of captured messages, and the stream of one table from it."""
    folder = settings.url("capture")
    return folder, lambda ref: captured_messages(spark, folder, ref.topic, settings)


def _captured(messages: DataFrame, folder: str) -> None:
    messages.write.mode("append").options(**SMALL_ROW_GROUPS).parquet(folder)


def run_products(
    spark: SparkSession, sf_dir: str, name: str, content_type: str, rounds: int
) -> Settings:
    """Capture the changes bit by bit and run the whole chain after each bit."""
    settings = lake(spark, name)
    folder, stream = _capture(spark, settings)
    encode = avro_messages if content_type == "avro" else json_messages
    parts = batches(_changes(spark, sf_dir))
    for start in range(0, CHANGE_BATCHES, CHANGE_BATCHES // rounds):
        for part in parts[start : start + CHANGE_BATCHES // rounds]:
            _captured(encode(part.hint("rebalance")), folder)
        run_table(spark, PRODUCTS, "local", content_type, stream, settings)
    return settings


def stream_pipeline_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = run_products(spark, sf_dir, "avro", "avro", rounds=2)
    return read_curated(spark, PRODUCTS.path("curated", settings)).select(*IMAGE, "op")


def stream_pipeline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = run_products(spark, sf_dir, "json", "json", rounds=2)
    return read_curated(spark, PRODUCTS.path("curated", settings)).select(*IMAGE, "op")


def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages captured and run twice."""
    settings = lake(spark, "replay")
    folder, stream = _capture(spark, settings)
    messages = json_messages(_changes(spark, sf_dir).hint("rebalance"))
    for _ in range(2):
        _captured(messages, folder)
        run_table(spark, PRODUCTS, "local", "json", stream, settings)
    return read_curated(spark, PRODUCTS.path("curated", settings)).select(*IMAGE, "op")


def _in_batches(spark: SparkSession, folder: str, settings: Settings) -> Settings:
    """The same with a limit that lets a folder's files come in CHANGE_BATCHES micro-batches."""
    files = len(list_names(spark, folder, r"part-[^/,}]+\.parquet"))
    return replace(settings, max_files_per_trigger=max(1, -(-files // CHANGE_BATCHES)))


def stream_any_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes captured in files without order, a few files for each micro-batch."""
    settings = lake(spark, "any-batches")
    folder, _ = _capture(spark, settings)
    changes = _changes(spark, sf_dir)
    part = F.pmod(F.xxhash64("offset"), F.lit(CHANGE_BATCHES))
    for batch in range(CHANGE_BATCHES):
        _captured(json_messages(changes.where(part == batch).hint("rebalance")), folder)
    some = _in_batches(spark, folder, settings)
    land_messages(captured_messages(spark, folder, TOPIC, some), "raw", PRODUCTS, some)
    some = _in_batches(spark, PRODUCTS.path("raw", settings), settings)
    raw_to_staged(spark, *TOPIC.split("."), "local", "json", some)
    one = replace(settings, max_files_per_trigger=1)
    staged_to_curated(spark, *TOPIC.split("."), settings=one)
    return read_curated(spark, PRODUCTS.path("curated", settings)).select(*IMAGE, "op")


def stream_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run finds messages in files dated a month before those of the first."""
    settings = lake(spark, "old-files")
    folder, stream = _capture(spark, settings)
    parts = batches(_changes(spark, sf_dir))
    known: list[str] = []
    for days, some in ((0, parts[1::2]), (30, parts[::2])):
        for part in some:
            _captured(json_messages(part.hint("rebalance")), folder)
        names = list_names(spark, folder, r"part-[^/,}]+\.parquet")
        for name in set(names) - set(known):
            dated = modified(spark, f"{folder}/{name}") - days * 86_400
            set_modified(spark, f"{folder}/{name}", dated)
        known = names
        run_table(spark, PRODUCTS, "local", "json", stream, settings)
    return read_curated(spark, PRODUCTS.path("curated", settings)).select(*IMAGE, "op")


def merge_runs_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the changes at once, then the others bit by bit, each a run of the buckets it touches."""
    settings = lake(spark, "runs")
    path = PRODUCTS.path("curated", settings)
    first, second, *later = batches(_changes(spark, sf_dir))
    for number, part in enumerate([first.unionByName(second), *later]):
        for piece in range(1 if number == 0 else 3):
            bit = part if number == 0 else part.where(F.col("offset") % 3 == piece)
            apply_changes(bit, path, "changes", 3 * number + piece, settings)
    return read_curated(spark, path).select(*IMAGE, "op")


def merge_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of staged changes applied newest first."""
    settings = lake(spark, "any-order")
    path = PRODUCTS.path("curated", settings)
    for number, part in enumerate(reversed(batches(_changes(spark, sf_dir)))):
        apply_changes(part, path, "changes", number, settings)
    return read_curated(spark, path).select(*IMAGE, "op")


def stream_bootstrap_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table is dropped and made again from all of staged."""
    settings = run_products(spark, sf_dir, "bootstrap", "json", rounds=2)
    path = PRODUCTS.path("curated", settings)
    delete_path(spark, path, within=settings.url(settings.curated))
    staged_to_curated(spark, *TOPIC.split("."), settings=settings)
    return read_curated(spark, path).select(*IMAGE, "op")


def stream_staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and staged only, with a tombstone after each delete."""
    settings = lake(spark, "staged")
    folder, stream = _capture(spark, settings)
    changes = _changes(spark, sf_dir)
    deletes = avro_messages(changes.filter("value.op = 'd'"))
    tombstones = deletes.withColumn("value", F.lit(None).cast("binary"))
    _captured(avro_messages(changes.hint("rebalance")).unionByName(tombstones), folder)
    land_messages(stream(PRODUCTS), "raw", PRODUCTS, settings)
    raw_to_staged(spark, *TOPIC.split("."), "local", "avro", settings)
    return _flat(read_staged(spark, PRODUCTS, settings))


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in raw, byte for byte."""
    settings = lake(spark, "raw")
    folder, stream = _capture(spark, settings)
    _captured(json_messages(_changes(spark, sf_dir).hint("rebalance")), folder)
    land_messages(stream(PRODUCTS), "raw", PRODUCTS, settings)
    return _landed(spark, settings)


def _landed(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_layer(spark, "raw", PRODUCTS, settings=settings).select(
        "topic",
        "partition",
        F.col("offset").alias("offset_no"),
        F.col("timestamp").cast("timestamp_ntz").alias("captured_at"),
        F.get_json_object(F.col("key").cast("string"), "$.payload.id").cast("bigint").alias("id"),
        F.get_json_object(F.col("value").cast("string"), "$.payload.op").alias("op"),
    )


def raw_landing_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages captured a second time, some of them in the same run: raw has each once."""
    settings = lake(spark, "raw-resent")
    folder, stream = _capture(spark, settings)
    changes = _changes(spark, sf_dir)
    again = json_messages(changes.where(F.col("offset") % 3 == 0))
    for some in (json_messages(changes).unionByName(again), json_messages(changes)):
        _captured(some, folder)
        land_messages(without_resent(stream(PRODUCTS)), "raw", PRODUCTS, settings)
    return _landed(spark, settings)


def pipeline_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a table that took the changes in four runs."""
    settings = run_products(spark, sf_dir, "history", "json", rounds=CHANGE_BATCHES)
    history = read_history(spark, PRODUCTS.history("curated", settings))
    newest = table_history(spark, PRODUCTS.path("curated", settings), CHANGE_BATCHES)
    return history.join(newest.select("version"), "version", "left_semi").select(
        "version",
        "operation",
        F.col("operationMetrics")["numUpserts"].cast("bigint").alias("upserts"),
        F.col("operationMetrics")["numDeletes"].cast("bigint").alias("deletes"),
    )


def multi_table_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture folder with a topic per event type, run as many tables."""
    settings = lake(spark, "tables")
    folder, _ = _capture(spark, settings)
    kind = F.coalesce("value.after.name", "value.before.name")
    changes = _changes(spark, sf_dir).withColumn(
        "topic", F.concat(F.lit("dbserver1.inventory."), kind)
    )
    _captured(json_messages(changes.hint("rebalance")), folder)
    topics = [r.topic for r in changes.select("topic").distinct().collect()]
    messages = captured_messages(spark, folder, settings=settings)
    refs = run_tables(spark, topics, "local", "json", settings=settings, shared=messages)
    result = None
    for ref in refs:
        rows = read_curated(spark, ref.path("curated", settings)).select(
            F.lit(ref.table_name).alias("table_name"), *IMAGE, "op"
        )
        result = rows if result is None else result.unionByName(rows)
    return result


QUERIES: dict[str, Query] = {
    "cdc_latest_per_key": cdc_latest_per_key,
    "cdc_current_state": cdc_current_state,
    "cdc_change_rows": cdc_change_rows,
    "cdc_merge_customers": cdc_merge_customers,
    "cdc_delete_without_image": cdc_delete_without_image,
    "cdc_merge_orders": cdc_merge_orders,
    "cdc_merge_composite": cdc_merge_composite,
    "cdc_schema_pairs": cdc_schema_pairs,
    "cdc_schema_route": cdc_schema_route,
    "frame_decode_ids": frame_decode_ids,
    "avro_decode": avro_decode,
    "protobuf_decode": protobuf_decode,
    "json_envelope_decode": json_envelope_decode,
    "topic_address": topic_address,
    "synthetic_products": synthetic_products,
    "layer_roundtrip_parquet": layer_roundtrip("lineitem", "parquet"),
    "layer_roundtrip_orc": layer_roundtrip("orders", "orc"),
    "layer_roundtrip_json": layer_roundtrip("events", "json"),
    "layer_roundtrip_csv": layer_roundtrip("customer", "csv"),
    "layer_roundtrip_text": layer_roundtrip_text,
    "layer_stream_parquet": layer_stream("orders", "parquet"),
    "layer_stream_orc": layer_stream("customer", "orc"),
    "layer_stream_json": layer_stream("events", "json"),
    "layer_stream_csv": layer_stream("documents", "csv", multiLine="true"),
    "layer_stream_text": layer_stream("conversations", "text"),
    "append_evolution": append_evolution,
    "record_ingest": record_ingest,
    "table_merge_orders": table_merge_orders,
    "table_grown_buckets": table_grown_buckets,
    "merge_widened": merge_widened,
    "merge_pruned_files": merge_pruned_files,
    "version_changes": version_changes,
    "table_append_orders": table_append_orders,
    "table_time_travel": table_time_travel,
    "append_replay": append_replay,
    "compact_rows": compact_rows,
    "compaction_report": compaction_report,
    "compact_packed": compact_packed,
    "table_detail_row": table_detail_row,
    "file_manifest": file_manifest,
    "stream_pipeline_avro": stream_pipeline_avro,
    "stream_pipeline_json": stream_pipeline_json,
    "stream_replay_idempotent": stream_replay_idempotent,
    "stream_any_batches": stream_any_batches,
    "stream_old_files": stream_old_files,
    "merge_runs_state": merge_runs_state,
    "merge_any_order": merge_any_order,
    "stream_bootstrap_replay": stream_bootstrap_replay,
    "stream_staged_rows": stream_staged_rows,
    "raw_landing": raw_landing,
    "raw_landing_resent": raw_landing_resent,
    "pipeline_history": pipeline_history,
    "multi_table_pipeline": multi_table_pipeline,
}
