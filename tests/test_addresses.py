import pytest
from pyspark.sql import functions as F

from ebbtide.address import TableRef, mount_checkpoint_path, mount_history_path, mount_path
from ebbtide.config import Settings, schema_text
from ebbtide.functions.topics import topic_parts, topic_path


def test_paths():
    ref = TableRef.from_topic("dbserver1.inventory.products")
    assert ref.path("raw") == "s3://datalake-raw/dbserver1/inventory/products"
    assert ref.checkpoint("staged") == (
        "s3://spark-control/_checkpoint/datalake-staged/dbserver1/inventory/products"
    )
    assert ref.history("curated") == (
        "s3://spark-control/_history/datalake-curated/dbserver1/inventory/products"
    )


def test_missing_parts():
    assert mount_path("raw", "p", None, "t") is None
    assert mount_path(None, "p", "d", "t") is None
    assert mount_checkpoint_path("raw", "p", "d") is None


def test_unknown_layer():
    for mount in (mount_path, mount_checkpoint_path, mount_history_path):
        with pytest.raises(KeyError, match="gold"):
            mount("gold", "p", "d", "t")


@pytest.mark.parametrize("topic", ["a.b", "a.b.c.d", "a..c", ""])
def test_bad_topics(spark, topic):
    with pytest.raises(ValueError):
        TableRef.from_topic(topic)
    rows = spark.createDataFrame([(topic,)], "topic string")
    with pytest.raises(Exception, match="not project.database.table"):
        rows.select(topic_parts(F.col("topic"))).collect()


def test_topic_columns(spark):
    rows = spark.createDataFrame([("a.b.c",), (None,)], "topic string")
    path = topic_path(F.col("topic"), "curated", Settings(prefix_protocol="file", base="/x/"))
    assert [r[0] for r in rows.select(path).collect()] == ["file:///x/datalake-curated/a/b/c", None]


def test_schema_lookup():
    assert schema_text({1: "a"}, 1) == "a"
    assert schema_text(lambda i: f"s{i}", 7) == "s7"
    with pytest.raises(KeyError, match="9"):
        schema_text({1: "a"}, 9)
    with pytest.raises(KeyError, match="nowhere"):
        Settings().schema_lookup("nowhere")
