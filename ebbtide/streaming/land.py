"""Messages to the raw layer, byte for byte."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.address import TableRef
from ebbtide.config import DEFAULT, Settings
from ebbtide.sources.capture import SMALL_ROW_GROUPS, kafka_messages
from ebbtide.sources.layers import start_stream
from ebbtide.sources.storage import delete_path, list_names, move_path
from ebbtide.streaming.stage import running_stream_id

_TOPIC = "_topic"


def land_messages(
    messages: DataFrame, output_layer: str, ref: TableRef, settings: Settings = DEFAULT
) -> None:
    """Append all that a stream has to a table, exactly once, and return.

    The file sink keeps a log of committed files, which the stream that reads
    the layer follows.
    """
    writer = messages.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    start_stream(writer, output_layer, ref, settings).awaitTermination()


def land_topics(
    messages: DataFrame, output_layer: str, name: str, settings: Settings = DEFAULT
) -> None:
    """Append all that a stream has to the tables its topics name, in one pass, and return.

    Each micro-batch is written once, split by topic, and its folders then move to
    the tables, under the stream's id and the batch's number: a repeated batch
    replaces them. ``name`` is that of the stream's checkpoint. One stream lands
    a topic, by this function or by ``land_messages``.
    """
    control = settings.url(settings.spark_control)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, f"{running_stream_id(batch)}-{batch_id}"
        work = f"{control}/_work/land-{run}"
        dealt = batch.withColumn(_TOPIC, F.col("topic"))
        dealt.write.mode("overwrite").options(**SMALL_ROW_GROUPS).partitionBy(_TOPIC).parquet(work)
        for folder in list_names(spark, work, rf"{_TOPIC}=[^/,}}]+"):
            path = TableRef.from_topic(unquote(folder.partition("=")[2])).path(output_layer, settings)
            delete_path(spark, f"{path}/{run}", within=path)
            move_path(spark, f"{work}/{folder}", f"{path}/{run}")
        delete_path(spark, work, within=control)

    (
        messages.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{control}/_checkpoint/{settings.bucket(output_layer)}/_topics/{name}")
        .foreachBatch(land)
        .start()
        .awaitTermination()
    )


def kafka_to_raw(
    spark: SparkSession,
    output_layer: str,
    bootstrap_servers: str,
    topic: str,
    settings: Settings = DEFAULT,
    **options,
) -> None:
    ref = TableRef.from_topic(topic)
    messages = kafka_messages(spark, bootstrap_servers, topic, settings, **options)
    land_messages(messages, output_layer, ref, settings)
