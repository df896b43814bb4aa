"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased, and what is neither a letter nor a mark becomes one space. A language's
model gives each character a probability after the three before it, with one
discount for each order estimated from the counts, the lower orders counting
distinct left neighbours. All labelled text is counted: each batch counts its
runs of four characters, Spark adds them up, and the lower orders and
probabilities are joins and sums over these counts.

For scoring, the models of all languages are held in one sorted array of hashes
for each order with one column of log probabilities per language. A hash is the
run itself, four 16-bit units packed into 64 bits, so no two runs share one, and
the arrays grow with the distinct runs of the labelled texts.
A text gets the language of the lowest cross-entropy per character; it counts as
rejected where that is above what the language's own labelled texts reach (mean and
three deviations over all of them that the model gives their language).

Defined results: NULL texts and texts without letters are ``und`` with score 0
and are not learned from, nor are rows with a NULL language; without any model
every text is ``und``; repeated rows count as often as they come; equal
cross-entropies go to the first language by code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.vectors import slices
from ebbtide.sources.storage import stored

ORDER = 4
UNKNOWN = "und"
_OTHER, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")
_SHARP = 12.0


def _clean(text: str) -> str:
    """Letters with their marks, other stretches as one space; nothing for a text without letter."""
    return _OTHER.sub(" ", text.lower()).strip() if _LETTER.search(text) else ""


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of four 16-bit units, one ending at each unit of the cleaned texts, and each text's first.

    A text without letters has none. Each text starts after three spaces and ends with one.
    """
    cleaned = [_clean(t) for t in texts]
    parts = [f"   {t} " if t else "" for t in cleaned]
    units = np.frombuffer("".join(parts).encode("utf-16-le", "surrogatepass"), dtype="<u2")
    lengths = np.array([len(p.encode("utf-16-le", "surrogatepass")) // 2 for p in parts])
    if not len(units):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    u = units.astype(np.int64)
    packed = (u[:-3] << 48) | (u[1:-2] << 32) | (u[2:-1] << 16) | u[3:]
    ends = np.cumsum(lengths)
    counts = np.maximum(lengths - 3, 0)
    own = np.ones(len(packed), dtype=bool)
    for k in (3, 2, 1):  # runs that would reach into the next text
        at = ends[lengths > 0] - k
        own[at[at < len(packed)]] = False
    return packed[own], np.concatenate(([0], np.cumsum(counts)))


def _suffix(g: Column, length: int) -> Column:
    return g.bitwiseAND(F.lit((1 << (16 * length)) - 1)) if length < 4 else g


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, g, n): how often each run of four characters comes in a language."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=True):
                for _, texts in slices(part["text"].tolist()):
                    g, n = np.unique(_grams(texts)[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "g": g, "n": n})

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = rows.mapInPandas(counted, "lang string, g long, n long")
    return counts.groupBy("lang", "g").agg(F.sum("n").alias("n"))


def _tables(docs: DataFrame) -> DataFrame:
    """(kind, k, lang, g, p): log probabilities of runs ('p') and of backing off from contexts ('b')."""
    grams = {ORDER: stored(_counts(docs), "langid-counts")}
    for k in range(ORDER - 1, 0, -1):
        grams[k] = stored(
            grams[k + 1]
            .groupBy("lang", _suffix(F.col("g"), k).alias("g"))
            .agg(F.count("*").alias("n")),
            "langid-counts",
        )
    per_lang = Window.partitionBy("lang")
    lower = grams[1].select(
        "lang", F.lit(0).cast("long").alias("g"), (1 / (F.count("*").over(per_lang) + 1)).alias("q")
    ).distinct()
    parts = []
    for k in range(1, ORDER + 1):
        once = F.sum(F.when(F.col("n") == 1, 1).otherwise(0))
        twice = F.sum(F.when(F.col("n") == 2, 1).otherwise(0))
        discount = grams[k].groupBy("lang").agg(
            F.greatest(F.lit(0.1), F.least(F.lit(0.95), (once + 1) / (once + 2 * twice + 2))).alias("d")
        )
        counted = grams[k].withColumn("context", F.shiftrightunsigned("g", 16))
        contexts = (
            counted.groupBy("lang", "context")
            .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            .join(discount, "lang")
            .withColumn("back", F.col("d") * F.col("kinds") / F.col("total"))
        )
        smaller = lower.select("lang", F.col("g").alias("short"), F.col("q").alias("below"))
        short = _suffix(F.col("g"), k - 1) if k > 1 else F.lit(0).cast("long")
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        lower = stored(
            counted.join(contexts, ["lang", "context"])
            .withColumn("short", short)
            .join(smaller, ["lang", "short"])
            .select("lang", "g", (own + F.col("back") * F.col("below")).alias("q")),
            "langid-model",
        )
        parts.append(lower.select(F.lit("p").alias("kind"), F.lit(k).alias("k"), "lang", "g", "q"))
        parts.append(
            contexts.select(
                F.lit("b").alias("kind"), F.lit(k).alias("k"), "lang",
                F.col("context").alias("g"), F.col("back").alias("q"),
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select("kind", "k", "lang", "g", F.log("q").alias("p"))


class Model:
    """Log probabilities of all languages in sorted hash arrays."""

    def __init__(self, table: pd.DataFrame):
        self.langs = sorted(table["lang"].unique().tolist())
        self.limits = np.full(len(self.langs), np.inf)
        column = {lang: i for i, lang in enumerate(self.langs)}
        self.arrays: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        floor = table[(table["kind"] == "p") & (table["k"] == 1)]["lang"].value_counts()
        self.floor = -np.log(np.array([floor.get(lang, 0) for lang in self.langs]) + 1.0)
        for k in range(1, ORDER + 1):
            for kind in ("b", "p"):
                part = table[(table["kind"] == kind) & (table["k"] == k)]
                keys, rows = np.unique(part["g"].to_numpy(), return_inverse=True)
                cells = np.full((len(keys), len(self.langs)), np.nan if kind == "p" else 0.0)
                cells[rows, part["lang"].map(column).to_numpy(dtype=int)] = part["p"].to_numpy(float)
                if kind == "p" and len(keys):
                    # What a language has not seen is backed off now rather than at each look-up.
                    cells = np.where(np.isnan(cells), self._backed_off(k, keys), cells)
                self.arrays[kind, k] = keys.astype(np.int64), cells.astype(np.float32)

    def _found(self, kind: str, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, _ = self.arrays[kind, k]
        at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
        return at, keys[at] == grams if len(keys) else np.zeros(len(grams), dtype=bool)

    def _backed_off(self, k: int, grams: np.ndarray) -> np.ndarray:
        context = (grams >> 16) & ((1 << (16 * (k - 1))) - 1)
        at, there = self._found("b", k, context)
        back = np.zeros((len(grams), len(self.langs)), dtype=np.float32)
        back[there] = self.arrays["b", k][1][at[there]]
        if k == 1:
            return back + self.floor
        return back + self.log_probabilities(grams & ((1 << (16 * (k - 1))) - 1), k - 1)

    def log_probabilities(self, grams: np.ndarray, k: int = ORDER) -> np.ndarray:
        at, there = self._found("p", k, grams)
        cells = self.arrays["p", k][1]
        out = cells[at] if len(cells) else np.zeros((len(grams), len(self.langs)), np.float32)
        if not there.all():
            out[~there] = self._backed_off(k, grams[~there])
        return out

    def cross_entropies(self, texts: list[str | None]) -> np.ndarray:
        """One row for each text, one column for each language; NaN without letters."""
        out = np.full((len(texts), len(self.langs)), np.nan)
        for start, part in slices(texts, 1 << 19):
            grams, first = _grams(part)
            counts = np.diff(first)
            some = np.flatnonzero(counts)
            if len(some):
                sums = np.add.reduceat(self.log_probabilities(grams), first[:-1][some], dtype=float)
                out[start + some] = -sums / counts[some, None]
        return out


def train(docs: DataFrame) -> Model:
    """A model from all rows (doc_id, text, lang), with limits of rejection from all of them."""
    # As many rows as the labelled texts have distinct runs.
    model = Model(_tables(docs).toArrow().to_pandas(categories=["kind", "lang"]))
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    limits = (
        _scored(labelled, model, "lang")
        .where(F.col("lang") == F.col("lang_pred"))
        .groupBy("lang")
        .agg((F.avg("cross_entropy") + 3 * F.stddev_pop("cross_entropy")).alias("most"))
    )
    for row in limits.collect():  # one for each language
        model.limits[model.langs.index(row.lang)] = row.most
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of every whole text.

    The score is the language's share among all, by their cross-entropies.
    """
    return _scored(docs, model, "doc_id")


def _scored(docs: DataFrame, model: Model, label: str) -> DataFrame:
    """As ``score``, with another column than the id."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[label].dataType.simpleString()

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch["text"].tolist()
            costs = model.cross_entropies(texts)
            known = ~np.isnan(costs).any(axis=1) if model.langs else np.zeros(len(texts), bool)
            best = np.full(len(texts), len(model.langs))
            share, least = np.zeros(len(texts)), np.full(len(texts), np.nan)
            if known.any():
                best[known] = costs[known].argmin(axis=1)
                least[known] = costs[known].min(axis=1)
                share[known] = 1 / np.exp(-_SHARP * (costs[known] - least[known, None])).sum(axis=1)
            limits = np.append(model.limits, -np.inf)[best]
            yield pd.DataFrame(
                {
                    label: batch[label],
                    "lang_pred": names[best],
                    "score": share,
                    "cross_entropy": least,
                    "rejected": ~(least <= limits),
                }
            )

    return docs.select(label, "text").mapInPandas(
        scored,
        f"{label} {kind}, lang_pred string, score double, cross_entropy double, rejected boolean",
    )
