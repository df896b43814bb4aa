"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    decontaminate,
    langid,
    licenses,
    mixing,
    pii,
    prefixtrie,
    quality,
    setjoin,
    sketchdedup,
    suffixes,
    tokencounts,
    whitening,
    winnow,
)
from ebbtide.sources.storage import stored


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    weights = quality.train(docs, _table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, weights).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.with_follower(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix_sources(stored(sized, "mix-sizes")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = quality.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held_out))
    return langid.score(docs, model).withColumn("held_out", held_out)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_groups(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "text")
    return tokencounts.length_histogram(tokencounts.token_lengths(docs))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")
    counts = {
        f"n_{kind}": F.size(F.filter("base", lambda s: s["order"] == order)).cast("long")
        for order, (kind, _, _) in enumerate(pii.KINDS)
    }
    return found.select(
        "doc_id",
        *(count.alias(name) for name, count in counts.items()),
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below source/lang; those a fifth of whose words stand in lines on licences are licence files."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    about = lambda text: text.rlike("(?i)licen[cs]e")
    lines = F.array_join(F.filter(F.split("text", r"\R"), about), " ")
    share = mixing.word_count(lines) * 5 >= mixing.word_count(F.col("text"))
    name = F.when(F.when(about(F.col("text")), share), "LICENSE").otherwise(F.col("doc_id").cast("string"))
    path = F.concat_ws("/", "source", "lang", name)
    files = docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.fit(vectors))
    # A deviation beyond a long is NULL.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return sketchdedup.remove_repeated_windows(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefixtrie.describe(prefixtrie.branched(prefixtrie.ordered_turns(conversations)), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_document_fingerprints,
        op3_source_mixing,
        op4_language_id,
        op5_ngram_jaccard_join,
        op6_token_counts,
        op7_benchmark_decontamination,
        op8_personal_data,
        op9_suffix_dedup,
        op10_license_scan,
        op11_embedding_whitening,
        op12_substring_dedup,
        op13_conversation_prefix_trie,
    )
}

#: DuckDB's form of the queries that SQL can express.
ORACLES: dict[str, str] = {"op3_source_mixing": mixing.ORACLE}
