"""Token counts of a corpus as an exact histogram of document lengths.

Each text is encoded once and counted under its length in tokens. Sums from the
end of the histogram then answer, for every context limit, how many documents
and tokens lie above it and what is left if each document is cut there.

The histogram is summed in blocks of lengths: sums by block, summed up over the
blocks, and running sums within a block, so no task needs all lengths.

Defined results: NULL and empty texts have 0 tokens; repeated rows count each;
no rows give an empty histogram; strings that look like special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

#: Ranks of a public byte-level vocabulary, on every machine of the cluster.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary's encoder cuts text into words (a fixed value).
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
BLOCK = 64


@lru_cache
def _encoder(path: str, pattern: str):
    import tiktoken

    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(
    docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY, words: str = WORDS
) -> DataFrame:
    """One row (n_tokens, docs) for each length in each batch of texts."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(vocabulary, words).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch["text"]]
            found = pd.Series(lengths, dtype="int64").value_counts()
            yield pd.DataFrame({"n_tokens": found.index, "docs": found.to_numpy()})

    return docs.select(F.col(text).alias("text")).mapInPandas(counted, "n_tokens long, docs long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length of (n_tokens, docs) rows, in no order.

    docs and tokens of that length; docs_above and tokens_above of longer
    documents; truncated_tokens, what is left if every document is cut at that
    length; share_at_most, the share of documents of that length at most.
    """
    counts = stored(
        lengths.groupBy("n_tokens")
        .agg(F.sum("docs").alias("docs"))
        .withColumn("tokens", F.col("n_tokens") * F.col("docs"))
        .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)),
        "token-lengths",
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = (
        counts.groupBy("block")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .select(
            "block",
            F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("later_docs"),
            F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("later_tokens"),
            F.sum("docs").over(everything).alias("all_docs"),
        )
    )
    longer = (
        Window.partitionBy("block")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.sum("tokens").over(Window.partitionBy("block"))
    above = F.coalesce(F.sum("tokens").over(longer), F.lit(0))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("block").agg(F.sum("tokens").alias("tokens")).select(
        "block", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("earlier_tokens")
    )
    return (
        counts.join(blocks, "block")
        .join(totals, "block")
        .withColumn(
            "docs_above",
            F.col("later_docs") + F.coalesce(F.sum("docs").over(longer), F.lit(0)),
        )
        .withColumn("tokens_above", F.col("later_tokens") + above)
        .withColumn("tokens_at_most", F.col("earlier_tokens") + below - above)
        .select(
            "n_tokens",
            "docs",
            "tokens",
            "docs_above",
            "tokens_above",
            (F.col("tokens_at_most") + F.col("n_tokens") * F.col("docs_above")).alias(
                "truncated_tokens"
            ),
            ((F.col("all_docs") - F.col("docs_above")) / F.col("all_docs")).alias("share_at_most"),
        )
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_above, tokens, truncated_tokens) for each limit, one row each."""
    context = F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("context")
    above = F.col("n_tokens") > F.col("context")
    return (
        histogram.select("n_tokens", "docs", "tokens", context)
        .groupBy("context")
        .agg(
            F.sum(F.when(above, F.col("docs")).otherwise(0)).alias("docs_above"),
            F.sum("tokens").alias("tokens"),
            F.sum(F.least("n_tokens", "context") * F.col("docs")).alias("truncated_tokens"),
        )
    )


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that this share of the documents does not exceed."""
    share = F.explode(F.array(*(F.lit(float(x)) for x in shares))).alias("share")
    return (
        histogram.select("n_tokens", "share_at_most", share)
        .where(F.col("share_at_most") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
