"""Captured change messages: from Kafka, or from a folder of captured files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.config import DEFAULT, MIB, Settings

# Fixed: the columns of Spark's Kafka source.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


#: A stream takes every file, whenever it was last modified. Spark's default leaves
#: out files a week older than the newest one seen: copies, restored files.
ANY_AGE = {"maxFileAge": "36500d"}


#: How batch writes lay out files of messages: a task reads whole row groups, and in Spark's 128 MB
#: there are millions of messages, since they compress so well. Spark's streaming file sink takes
#: no such option; it writes a file for each task that reads these.
SMALL_ROW_GROUPS = {"parquet.block.size": 4 * MIB}


def file_limits(settings: Settings) -> dict[str, int | str]:
    """Options of file sources: any age, and a micro-batch limit; Spark takes one of the two."""
    if settings.max_files_per_trigger is not None:
        return {**ANY_AGE, "maxFilesPerTrigger": settings.max_files_per_trigger}
    if settings.max_bytes_per_trigger is not None:
        return {**ANY_AGE, "maxBytesPerTrigger": settings.max_bytes_per_trigger}
    return dict(ANY_AGE)


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    settings: Settings = DEFAULT,
    **options,
) -> DataFrame:
    """Stream of one topic from its beginning; needs the Kafka connector.

    ``options`` are the connector's, such as ``kafka.security.protocol``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if settings.max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger)
    return reader.options(**options).load()


def captured_messages(
    spark: SparkSession, folder: str, topic: str | None = None, settings: Settings = DEFAULT
) -> DataFrame:
    """The same stream from Parquet files of captured messages."""
    stream = (
        spark.readStream.schema(KAFKA_SCHEMA).options(**file_limits(settings)).parquet(folder)
    )
    return stream if topic is None else stream.filter(F.col("topic") == topic)


def without_resent(messages: DataFrame, within: str = "7 days") -> DataFrame:
    """A stream without messages that came before: of equal topic, partition and offset, the first.

    What has come is remembered in the stream's state for a time after its
    arrival. The watermark is on the arrival, not on the messages' timestamps, so
    no message is ever late and dropped for that.
    """
    arrived = messages.withColumn("_arrived", F.current_timestamp())
    once = arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(
        ["topic", "partition", "offset"]
    )
    return once.drop("_arrived")


def tail(messages: DataFrame, rows: int = 20):
    """Print the first rows of each available micro-batch of a stream to the console and stop."""
    query = (
        messages.writeStream.format("console")
        .option("numRows", rows)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
