"""Topic names as columns, so that one stream can carry many topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.config import DEFAULT, Settings


def topic_parts(topic: Column) -> Column:
    """struct(project_name, database, table_name); fails unless three parts."""
    parts = F.split(topic, "[.]")
    names = ["project_name", "database", "table_name"]
    address = F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
    valid = (F.size(parts) == 3) & ~F.array_contains(parts, "")
    return F.when(topic.isNull() | valid, address).otherwise(
        F.raise_error(F.concat(F.lit("not project.database.table: "), topic))
    )


def topic_path(topic: Column, layer: str, settings: Settings = DEFAULT) -> Column:
    """Data path of the table a topic belongs to."""
    parts = topic_parts(topic)
    names = [parts["project_name"], parts["database"], parts["table_name"]]
    steps = [step for name in names for step in (F.lit("/"), name)]
    return F.concat(F.lit(settings.url(settings.bucket(layer))), *steps)
