"""Whole runs: raw, staged and curated for many tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings
from ebbtide.sources.capture import kafka_messages
from ebbtide.streaming.curate import staged_to_curated
from ebbtide.streaming.land import land_messages, land_topics
from ebbtide.streaming.stage import raw_to_staged


class TableRunsFailed(Exception):
    """Some tables failed; the others are up to date."""

    def __init__(self, errors: dict[TableRef, Exception]):
        self.errors = errors
        details = "; ".join(f"{ref.topic}: {error}" for ref, error in errors.items())
        super().__init__(f"{len(errors)} table runs failed: {details}")


def run_table(
    spark: SparkSession,
    ref: TableRef,
    environment: str,
    content_type: str = "avro",
    messages: Callable[[TableRef], DataFrame] | None = None,
    settings: Settings = DEFAULT,
) -> None:
    """Bring one table up to date: land, decode, apply, one after the other.

    ``messages`` gives the stream of a table; without it, Kafka is read.
    """
    if messages is None:
        options = dict(settings.kafka[environment])
        servers = options.pop("bootstrap_servers")
        stream = kafka_messages(spark, servers, ref.topic, settings, **options)
    else:
        stream = messages(ref)
    land_messages(stream, "raw", ref, settings)
    update_table(spark, ref, environment, content_type, settings)


def update_table(
    spark: SparkSession,
    ref: TableRef,
    environment: str,
    content_type: str = "avro",
    settings: Settings = DEFAULT,
) -> None:
    """Decode and apply what has landed of a table."""
    address = (ref.project_name, ref.database, ref.table_name)
    raw_to_staged(spark, *address, environment, content_type, settings)
    staged_to_curated(spark, *address, environment, settings)


def run_tables(
    spark: SparkSession,
    tables: Iterable[TableRef | str],
    environment: str,
    content_type: str = "avro",
    messages: Callable[[TableRef], DataFrame] | None = None,
    settings: Settings = DEFAULT,
    at_once: int = 4,
    shared: DataFrame | None = None,
) -> list[TableRef]:
    """Run the chain for each table (or topic), some tables at once.

    Tables are independent: one that fails does not stop the others. ``shared``
    is one stream with the messages of all of them, which is read once; without
    it each table has its own stream.
    """
    refs = [TableRef.from_topic(t) if isinstance(t, str) else t for t in tables]
    if shared is not None:
        land_topics(shared, "raw", environment, settings)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        runs = {
            ref: pool.submit(update_table, spark, ref, environment, content_type, settings)
            if shared is not None
            else pool.submit(run_table, spark, ref, environment, content_type, messages, settings)
            for ref in refs
        }
    errors = {ref: run.exception() for ref, run in runs.items() if run.exception()}
    if errors:
        raise TableRunsFailed(errors)
    return refs
