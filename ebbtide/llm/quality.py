"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are word n-grams hashed into a fixed number of weights: one to two
words as written, and one to three word forms (letter case, marks, digits,
whether a word repeats the one before it), which carry over to unseen words.
A document's score is the logistic function of a sparse dot product, each
family of n-grams weighed by one over its number in the document.

Defined results: NULL and empty texts have no n-grams and score the bias alone;
repeated rows are scored (and learned from) one by one; NULL labels and
documents with NULL ids are not learned from; without any label every score is
0.5; all columns but the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import mix, prefix_hash, slices, span_hashes, words

#: Weights; a model has as many 4-byte numbers, whatever it was trained on.
BUCKETS = 1 << 18
#: Labelled documents learned from, at most: those that come first by a hash of their id.
TRAIN_ROWS = 24_000
#: Models trained side by side, whose weights are averaged.
SHARDS = 6
_EPOCHS, _ALPHA, _BETA, _L1, _L2, _SCALE = 3, 0.3, 1.0, 0.01, 0.01, 12.0
_FAMILIES = ("word", "word pair", "form", "form pair", "form triple")

_KIND = np.zeros(256, dtype=np.int64)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[0x80:] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _forms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    kinds = _KIND[data]
    has = [np.add.reduceat(kinds == k, starts) for k in (0, 1, 2, 3)]
    repeats = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    # Marks at the end of a word tell sentence ends from decoration.
    mark = np.where(_KIND[data[ends - 1]] == 0, data[ends - 1], 0).astype(np.uint64)
    flags = (has[1] > 0) * 1 + np.minimum(has[2], 2) * 2 + (has[3] > 0) * 8
    flags = flags + np.minimum(has[0], 3) * 16 + repeats * 64
    return mix(flags.astype(np.uint64) * np.uint64(256) + mark)


def _features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family: bucket of each n-gram, and each text's first n-gram (and the end)."""
    data, starts, ends, first = words(texts)
    if not len(starts):
        yield from ((np.zeros(0, np.int64), first) for _ in _FAMILIES)
        return
    word = span_hashes(prefix_hash(data), starts, ends)
    form = _forms(data, starts, ends, word)
    size, text = len(word), np.repeat(np.arange(len(texts)), np.diff(first))
    for family, (base, n) in enumerate(((word, 1), (word, 2), (form, 1), (form, 2), (form, 3))):
        gram = base[: size - n + 1] + np.uint64(family + 1)
        for k in range(1, n):
            gram = mix(gram) + base[k : size - n + 1 + k]
        whole = text[: size - n + 1] == text[n - 1 :]
        buckets = (mix(gram) % np.uint64(BUCKETS)).astype(np.int64)[whole]
        yield buckets, np.searchsorted(text[: size - n + 1][whole], np.arange(len(texts) + 1))


def _scores(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    out = np.full(len(texts), float(weights[BUCKETS]))
    for start, part in slices(texts):
        for buckets, first in _features(part):
            sums = np.concatenate(([0.0], np.cumsum(weights[buckets], dtype=np.float64)))
            counts = np.diff(first)
            dots = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)
            out[start : start + len(part)] += _SCALE * dots
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def _vectors(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sparse vector of each text: buckets and values, the bias last."""
    for _, part in slices(texts):
        families = list(_features(part))
        for i in range(len(part)):
            found = [(b[f[i] : f[i + 1]]) for b, f in families]
            share = [np.full(len(b), _SCALE / max(len(b), 1)) for b in found]
            buckets, where = np.unique(np.concatenate(found), return_inverse=True)
            values = np.bincount(where, np.concatenate(share), len(buckets))
            yield np.append(buckets, BUCKETS), np.append(values, 1.0)


def _follow_leader(vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> np.ndarray:
    """FTRL-proximal with per-weight rates over the vectors in order."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - _L1, 0)
        return -shrunk / ((_BETA + np.sqrt(n[at])) / _ALPHA + _L2)

    for _ in range(_EPOCHS):
        for (at, x), y in zip(vectors, labels, strict=True):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / _ALPHA * w
            n[at] += g * g
    return weights(slice(None))


def _train_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    vectors: list = []
    labels: list[int] = []
    for batch in batches:
        vectors += _vectors(batch["text"].tolist())
        labels += batch["label"].tolist()
    if vectors:
        weights = _follow_leader(vectors, labels)
        at = np.flatnonzero(weights)
        yield pd.DataFrame({"bucket": at, "weight": weights[at]})
        yield pd.DataFrame({"bucket": [BUCKETS + 1], "weight": [1.0]})


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> np.ndarray:
    """Weights (the bias last) from at most ``rows`` labelled documents outside the held-out fold.

    Labels of one id that disagree go by their majority (a tie counts as 1).
    """
    chosen = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("id"))
        .orderBy("turn", "id")
        .limit(rows)
    )
    sample = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "id")  # at most `rows` ids
        .withColumn("shard", F.pmod(F.col("turn"), F.lit(SHARDS)))
        .repartition(SHARDS, "shard")
        .sortWithinPartitions("shard", "turn", "id", "text")
        .select("text", "label")
    )
    model = np.zeros(BUCKETS + 2)
    trained = sample.mapInPandas(_train_shard, "bucket long, weight double")
    # One row for each weight at most, and their sum is divided by the shards that had rows.
    for row in trained.groupBy("bucket").agg(F.sum("weight").alias("weight")).toLocalIterator():
        model[row.bucket] = row.weight
    return (model[:-1] / max(model[-1], 1)).astype(np.float32)


def score(
    docs: DataFrame, weights: np.ndarray, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = _scores(batch["text"].tolist(), shared.value)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(scored, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, least: float) -> DataFrame:
    """The rows, with all their columns, whose ``text`` scores ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(texts.tolist(), shared.value))

    return docs.where(scored(F.col("text")) >= least)
