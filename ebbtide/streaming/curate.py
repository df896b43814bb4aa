"""Staged changes to a mirror of the source table in the curated layer.

A curated table holds two columns more than its readers see: ``_order`` tells
when a row's change was captured, so that an older change that comes later is
not applied, and ``_deleted_at`` marks the rows of deleted keys, which stay
until the retention ends for the same reason.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings
from ebbtide.operators.changes import (
    ARRIVAL_ORDER,
    DELETE,
    change_rows,
    key_fields,
    latest_per_key,
)
from ebbtide.operators.tables import (
    counted,
    grow_table,
    merge_runs,
    merge_table,
    newest_version,
    overwrite_table,
    read_table,
)
from ebbtide.operators.upkeep import compact_files, record_history, vacuum, write_manifest
from ebbtide.sources.storage import delete_path, stored
from ebbtide.streaming.stage import (
    committed_folders,
    running_stream_id,
    staged_schema,
    stream_commits,
)

ORDER, DELETED = "_order", "_deleted_at"


def read_curated(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The mirrored rows, without the marks of deleted ones."""
    return read_table(spark, path, version).where(F.col(DELETED).isNull()).drop(ORDER, DELETED)


def apply_changes(
    batch: DataFrame, path: str, source: str, batch_id: int, settings: Settings = DEFAULT
) -> bool:
    """First load of a table or merge into it; False if the batch was applied before.

    The newest change of a key wins, whichever batch it comes in.
    """
    spark = batch.sparkSession
    base = newest_version(spark, path)
    if base is not None and base.has_applied(source, batch_id):
        return False
    keys = key_fields(batch)
    now = datetime.now(timezone.utc)
    rows = change_rows(latest_per_key(batch), keep=[F.struct(*ARRIVAL_ORDER).alias(ORDER)])
    mark = F.when(F.col("op") == DELETE, F.lit(now).cast("timestamp"))
    changes = rows.withColumn(DELETED, mark)
    expired = now - timedelta(hours=settings.vacuum_retention_hours)
    keep = F.col(DELETED).isNull() | (F.col(DELETED) > F.lit(expired))
    if base is None:
        observed, counts = counted(changes)
        overwrite_table(
            spark, path, observed, "CREATE", lambda: {**counts(), "numDeletes": 0}, source, batch_id,
            keys, settings.buckets, ORDER,
        )
    elif base.order:
        if keys != list(base.keys):
            raise ValueError(f"the table is dealt by {list(base.keys)}, not by {keys}")
        merge_runs(
            spark, path, changes, source, batch_id,
            tidy=lambda merged: merged.where(keep), most_files=settings.max_num_files_allowed,
        )
    else:  # made before tables had an order
        merge_table(
            spark, path, stored(changes, "changes"), keys, source, batch_id, ORDER,
            unique=True, tidy=lambda merged: merged.where(keep),
        )
    grow_table(spark, path, settings.bucket_bytes)
    compact_files(spark, path, settings)
    return True


def finish_run(
    spark: SparkSession, path: str, before: int, after: int, settings: Settings = DEFAULT
) -> None:
    """Upkeep after a run that took the table from one version to another."""
    if after == before:
        return
    write_manifest(spark, path)
    every = settings.vacuum_every_versions
    if after // every > max(before, 0) // every:
        vacuum(spark, path, settings=settings)


def staged_to_curated(
    spark: SparkSession,
    project_name: str,
    database: str,
    table_name: str,
    environment: str | None = None,
    settings: Settings = DEFAULT,
) -> None:
    """Apply all staged changes not yet applied, and return.

    If the curated table is gone, its checkpoint is dropped, so that all of
    staged is applied again.
    """
    ref = TableRef(project_name, database, table_name)
    path, checkpoint = ref.path("curated", settings), ref.checkpoint("curated", settings)
    staged, schema = ref.path("staged", settings), staged_schema(spark, ref, settings)
    if schema is None:
        return

    def number() -> int:
        newest = newest_version(spark, path)
        return newest.version if newest else -1

    def curate(commits: DataFrame, batch_id: int) -> None:
        session = commits.sparkSession
        folders = committed_folders(commits, staged)
        if folders:
            batch = session.read.schema(schema).parquet(*folders)
            apply_changes(batch, path, running_stream_id(commits), batch_id, settings)
        record_history(session, path, ref.history("curated", settings))

    before = number()
    if before < 0:
        delete_path(spark, checkpoint, within=settings.url(settings.spark_control))
    (
        stream_commits(spark, ref, settings)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(curate)
        .start()
        .awaitTermination()
    )
    finish_run(spark, path, before, number(), settings)
