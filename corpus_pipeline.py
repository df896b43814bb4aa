"""A training corpus from documents: five stages, each over all that the one before kept.

Every stage takes and returns a table with the columns of ``documents``; the last
one adds the mix. ``run`` writes each stage's rows to the shared folder and reads
them again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, mixing, pii, quality, setjoin
from ebbtide.sources.storage import stored

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3


def _good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, quality.train(docs, labels), LEAST_QUALITY)


def _distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setjoin.one_of_each_group(docs)


def _unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, benchmark.select("item_id", "text"))
    return decontaminate.without_contaminated(docs, found)


def _masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; n_chars follows the text."""
    rows = docs.select(F.struct("*").alias("doc"), "text")
    found = pii.find_personal_data(rows, "doc", "text").withColumn(
        "clean", F.when(F.size("spans") > 0, pii.masked(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    )
    length = F.when(F.size("spans") > 0, F.char_length("clean").cast("long")).otherwise(F.col("doc.n_chars"))
    changed = {"text": F.col("clean"), "n_chars": length}
    return found.select(*(changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken (in words)."""
    kept = docs.select("doc_id", "text", "lang", "source", "n_chars")
    sized = kept.withColumn("size", mixing.word_count(F.col("text")))
    return mixing.mix_sources(sized).where("taken > 0")


STAGES = [
    ("quality classifier", _good),
    ("n-gram jaccard join", _distinct),
    ("benchmark decontamination", _unleaked),
    ("personal data", _masked),
    ("source mixing", _mixed),
]

#: Not expressible in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
