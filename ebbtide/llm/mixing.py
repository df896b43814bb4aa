"""Mixing sources to target weights, with built-in functions only.

Each document gets a random key: the MD5 of its id. Within a source, documents
are ordered by key, and running sums of their sizes say which ones the source's
budget reaches; budgets above a source's size take it again. The key's first
three hexadecimal digits are ranges of the order: sums by range, summed up along
a source, and running sums within a range make up the running sum of the whole,
so no task sees more than about 1/4096 of a source.

Defined results: NULL and empty texts have size 0; a NULL source is a source of
its own, after all others; documents with the same id have the same key and are
ordered by size (equal rows are interchangeable); a NULL id has the key of the
empty text; sources of size 0 have target 0; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: How often a document may be taken, at most.
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    The sizes of all sources are shared by weight. A target stops at ``most``
    times its source's size and the excess is shared again, until none is above:
    with the sources ordered by size over weight, the first ones stop and the
    others share the rest at one level.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.asc_nulls_last("source"))
    by_room = Window.orderBy("room", F.asc_nulls_last("source"))
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    before, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(
        0, Window.unboundedFollowing
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("room", most * F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.sum("weight").over(rest))
        .withColumn("level", F.when(F.col("room") >= F.col("level"), F.struct("room", "level")))
        .withColumn("level", F.min("level").over(everything)["level"])
        .select(
            "source",
            "source_size",
            F.least(
                (most * F.col("source_size")).cast("double"), F.col("weight") * F.col("level")
            ).alias("target"),
        )
    )


def mix_sources(
    sized: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights=WEIGHTS,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """All rows and columns, with source_size, target and taken.

    ``taken`` is the part of a document's size that the mix takes, repeats
    counted: the whole of it for each full round of its source, and in the last
    round the part that the rest of the budget reaches, so that a source's taken
    sizes add up to its target, rounded down.
    """
    rows = sized.select(
        F.struct("*").alias("row"),
        F.col(source).isNull().alias("_none"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        F.col(size).alias("_size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("_key"),
    ).withColumn("_range", F.substring("_key", 1, 3))
    group = ["_none", "_source"]
    ranges = stored(
        rows.groupBy(*group, "_range").agg(F.sum("_size").alias("range_size")), "mix-ranges"
    )
    targets = source_targets(
        ranges.groupBy(*group)
        .agg(F.sum("range_size").alias("source_size"))
        .select(
            "source_size", F.when(~F.col("_none"), F.col("_source")).alias("source")
        ),
        weights,
        most,
    ).select(
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_source"),
        "source_size",
        "target",
    )
    along = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reached = ranges.select(
        *group, "_range", F.coalesce(F.sum("range_size").over(along), F.lit(0)).alias("_before")
    ).join(targets, group)
    within = (
        Window.partitionBy(*group, "_range")
        .orderBy("_key", "_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget = F.floor("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - F.col("_rounds") * F.col("source_size") - F.col("_before") - F.col("_within")
    cut = F.least(F.greatest(left, F.lit(0)), F.col("_size"))
    return (
        rows.join(reached, [*group, "_range"])
        .withColumn("_within", F.coalesce(F.sum("_size").over(within), F.lit(0)))
        .withColumn("_rounds", rounds)
        .select(
            "row.*",
            "source_size",
            "target",
            (F.col("_rounds") * F.col("_size") + cut).cast("long").alias("taken"),
        )
    )


#: DuckDB's form of ``mix_sources`` over documents, for the registered query.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source),
rooms AS (SELECT *, 3 * source_size / weight AS room, sum(source_size) OVER () AS total FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (
           ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         AS level FROM rooms),
targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE,
         weight * (SELECT arg_min(level, room) FROM levels WHERE room >= level)) AS target FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
         + least(greatest(budget % source_size - before, 0), size) END)::BIGINT AS taken
FROM placed
"""
