"""Raw messages to decoded rows in the staged layer.

The staged table is append-only. Each micro-batch writes one folder named after
its stream and number, then a small commit file that also carries the schema of
the table so far. A repeated batch replaces its folder, or is skipped if it was
committed. Who follows the table streams the commit files and reads the folders
they name: data folders are never listed, and files take part whatever their age.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings, schema_text
from ebbtide.functions.envelopes import (
    FRAME_DECODERS,
    decode_frames,
    decode_json_messages,
    json_schema_cut,
    json_schema_text,
)
from ebbtide.functions.frames import split_frames
from ebbtide.functions.schemas import merge_types
from ebbtide.sources.capture import ANY_AGE, KAFKA_SCHEMA, file_limits
from ebbtide.sources.layers import stream_layer
from ebbtide.sources.storage import create_text, list_names, read_text

CONTENT_TYPES = ("avro", "json", "protobuf")
_COMMITS = "_commits"
#: Commits that one micro-batch of a follower takes, unless the settings say how many.
_COMMITS_AT_ONCE = 64


@dataclass(frozen=True)
class StagedCommit:
    number: int
    stream: str
    batch_id: int
    schema: T.StructType
    rows: int
    tombstones: int


def staged_commits(spark: SparkSession, path: str) -> list[str]:
    return list_names(spark, f"{path}/{_COMMITS}", r"\d{20}\.json")


def newest_commit(spark: SparkSession, path: str) -> StagedCommit | None:
    names = staged_commits(spark, path)
    if not names:
        return None
    commit = json.loads(read_text(spark, f"{path}/{_COMMITS}/{names[-1]}"))
    return StagedCommit(**{**commit, "schema": T.StructType.fromJson(commit["schema"])})


def committed_folders(commits: DataFrame, path: str) -> list[str]:
    """Folders that some commit files (rows of one text each) name, oldest first; one for each micro-batch staged."""
    fields = F.from_json("value", "number long, stream string, batch_id long, rows long")
    rows = commits.select(fields.alias("c")).where("c.rows > 0").orderBy("c.number").collect()
    return [f"{path}/{r.c.stream}-{r.c.batch_id}" for r in rows]


def stream_commits(spark: SparkSession, ref: TableRef, settings: Settings = DEFAULT) -> DataFrame:
    """Stream of the commit files of a staged table; see ``committed_folders``."""
    limit = settings.max_files_per_trigger or _COMMITS_AT_ONCE
    options = {**ANY_AGE, "maxFilesPerTrigger": limit, "wholetext": "true"}
    return spark.readStream.options(**options).text(f"{ref.path('staged', settings)}/{_COMMITS}")


def staged_schema(spark: SparkSession, ref: TableRef, settings: Settings = DEFAULT):
    """Schema that holds the fields of every staged file, or None before any."""
    commit = newest_commit(spark, ref.path("staged", settings))
    return commit.schema if commit else None


def read_staged(spark: SparkSession, ref: TableRef, settings: Settings = DEFAULT) -> DataFrame:
    schema = staged_schema(spark, ref, settings)
    if schema is None:
        raise ValueError(f"nothing is staged for {ref.topic}")
    path = ref.path("staged", settings)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def stream_staged(spark: SparkSession, ref: TableRef, settings: Settings = DEFAULT) -> DataFrame:
    return stream_layer(
        spark,
        "staged",
        ref,
        schema=staged_schema(spark, ref, settings),
        settings=settings,
        recursiveFileLookup="true",
        **file_limits(settings),
    )


def running_stream_id(df: DataFrame) -> str:
    """Id of the stream whose micro-batch this is; kept by its checkpoint."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _is_json(text: str | None) -> bool:
    try:
        return text is None or json.loads(text) is not None
    except ValueError:
        return False


def decode_batch(
    messages: DataFrame, content_type: str, lookup, schema_of=json_schema_cut
) -> tuple[DataFrame, int, int]:
    """(staged rows, how many, tombstones skipped) of a batch of messages.

    A tombstone is a message without value. A value without key is an error,
    since there is nothing to merge it on. JSON messages are parsed once, with the
    types of the schemas that a first look finds by ``schema_of``; if that is not
    the whole schema of some message, all are parsed for their schema.
    """
    given = messages
    spark = messages.sparkSession
    framed = content_type in FRAME_DECODERS
    if framed:
        key_id, value_id = "keySchemaId", "valueSchemaId"
        messages = split_frames(messages)
    else:
        key_id, value_id = "keySchema", "valueSchema"
        messages = messages.withColumns(
            {key_id: schema_of(F.col("key")), value_id: schema_of(F.col("value"))}
        )
    no_value = F.col("value").isNull()
    marked = messages.withColumns(
        {
            value_id: F.when(no_value, None).otherwise(F.col(value_id)),
            "_tombstone": no_value,
            "_no_key": F.col("key").isNull(),
        }
    )
    pairs = (
        marked.groupBy("_tombstone", "_no_key", key_id, value_id)
        .agg(F.count("*").alias("rows"))
        .collect()
    )
    tombstones = sum(p["rows"] for p in pairs if p["_tombstone"])
    live = [p for p in pairs if not p["_tombstone"]]
    rows = sum(p["rows"] for p in live)
    if any(p["_no_key"] for p in live):
        raise ValueError("messages with a value but no key")
    if any(p[key_id] is None or p[value_id] is None for p in live):
        raise ValueError("messages that do not say their schema")

    keys, values = ({p[c] for p in live} for c in (key_id, value_id))
    if not framed and schema_of is not json_schema_text and not all(map(_is_json, keys | values)):
        return decode_batch(given, content_type, lookup, json_schema_text)
    messages = messages.filter(F.col("value").isNotNull())
    if not live:
        return messages.limit(0), 0, tombstones
    if framed:
        key_schemas, value_schemas = (
            {i: schema_text(lookup, i) for i in sorted(ids)} for ids in (keys, values)
        )
        decoded = decode_frames(spark, messages, key_schemas, value_schemas, content_type)
        return decoded, rows, tombstones
    return decode_json_messages(messages, sorted(keys), sorted(values)), rows, tombstones


def raw_to_staged(
    spark: SparkSession,
    project_name: str,
    database: str,
    table_name: str,
    environment: str,
    content_type: str = "avro",
    settings: Settings = DEFAULT,
) -> None:
    """Decode all raw messages not yet decoded, and return."""
    if content_type not in CONTENT_TYPES:
        raise NotImplementedError(f"content type {content_type!r}, known are {CONTENT_TYPES}")
    lookup = settings.schema_lookup(environment) if content_type in FRAME_DECODERS else None
    ref = TableRef(project_name, database, table_name)
    path = ref.path("staged", settings)

    def stage(batch: DataFrame, batch_id: int) -> None:
        session, stream = batch.sparkSession, running_stream_id(batch)
        last = newest_commit(session, path)
        if last and last.stream == stream and batch_id <= last.batch_id:
            return
        rows, count, tombstones = decode_batch(batch, content_type, lookup)
        if count:
            rows.write.mode("overwrite").parquet(f"{path}/{stream}-{batch_id}")
        schema = last.schema if last else None
        if count:
            schema = merge_types([schema, rows.schema], widen=True) if schema else rows.schema
        if schema is None:
            return
        commit = StagedCommit(
            last.number + 1 if last else 0, stream, batch_id, schema, count, tombstones
        )
        create_text(
            session,
            f"{path}/{_COMMITS}/{commit.number:020d}.json",
            json.dumps({**commit.__dict__, "schema": schema.jsonValue()}),
        )

    raw = stream_layer(
        spark,
        "raw",
        ref,
        schema=KAFKA_SCHEMA,
        settings=settings,
        recursiveFileLookup="true",
        **file_limits(settings),
    )
    (
        raw.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", ref.checkpoint("staged", settings))
        .foreachBatch(stage)
        .start()
        .awaitTermination()
    )
