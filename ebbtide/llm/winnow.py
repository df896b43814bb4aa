"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed; of each ``w`` successive hashes the
smallest is chosen, the rightmost of equal ones, and its position is kept. Two
texts that share ``k + w - 1`` code points share a fingerprint entry.

Defined results: NULL is the empty text, whose fingerprint is empty; a text
shorter than ``k`` is one run of its own length; two empty fingerprints are
alike (1.0), an empty and another one are not (0.0). Documents are ordered by
id, NULL first, and by text among equal ids; a single document follows itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import sliding_min, window_hashes

K, WINDOW = 16, 49
_LOW = np.uint64(0xFFFFFFFF)
#: Bytes of text that one range of ids should hold.
RANGE_BYTES = 32 << 20


def winnow(text: str, k: int = K, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the chosen runs, in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    hashes = window_hashes(codes, min(k, len(codes)))
    # The hash decides; among equal hashes the larger position is the smaller key.
    keys = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    least = sliding_min(keys, min(w, len(keys)))
    least = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return (least >> np.uint64(32)).astype(np.uint32), (_LOW - (least & _LOW)).astype(np.uint32)


def packed(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Hexadecimal text: eight digits of hash and eight of position for each entry."""
    return np.stack([hashes, positions], axis=1).astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the common distinct hashes over the sum of both numbers."""
    if not len(a) and not len(b):
        return 1.0
    a, b = np.unique(a), np.unique(b)
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K, w: int = WINDOW
) -> DataFrame:
    """(doc_id, hashes array<bigint>, positions array<bigint>) of every whole text."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [winnow(t or "", k, w) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "hashes": [h.astype(np.int64) for h, _ in pairs],
                    "positions": [p.astype(np.int64) for _, p in pairs],
                }
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(
        found, f"doc_id {kind}, hashes array<bigint>, positions array<bigint>"
    )


class _Current:
    """A document whose follower has not come yet."""

    def __init__(self, doc_id, text: str, k: int, w: int):
        self.doc_id, self.text = doc_id, text
        self.mark = winnow(text, k, w)

    def row(self, following: _Current, k: int, w: int) -> tuple:
        half = len(self.text) // 2
        edited = self.text[: len(self.text) - half] + following.text[:half]
        mark = winnow(edited, k, w)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(self.mark[0], mark[0]), likeness(self.mark[0], following.mark[0])
        return self.doc_id, len(self.text), digest, packed(*self.mark), packed(*mark), *near


def with_follower(docs: DataFrame, k: int = K, w: int = WINDOW) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    Takes (doc_id, text). Texts are dealt once, by ranges of ids; the first
    document of a range also goes to the range before it, and the very first one
    to the last range, so that each range finds all its followers. The range
    limits are quantiles of the ids: a few numbers for each range.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total, lowest, nulls = rows.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.min("doc_id"),
        F.count(F.when(F.col("doc_id").isNull(), 1)),
    ).first()
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2 * deals, total // RANGE_BYTES)
    wanted = [i / parts for i in range(1, parts)]
    limits = rows.agg(F.percentile_approx("doc_id", wanted, 20 * parts)).first()[0] or []
    limits = np.array(sorted({x for x in limits if x != lowest or nulls}), dtype=np.int64)

    @F.pandas_udf("array<int>")
    def ranges(ids: pd.Series) -> pd.Series:
        missing = ids.isna().to_numpy()
        values = ids.fillna(0).to_numpy().astype(np.int64)
        own = np.where(missing, 0, np.searchsorted(limits, values, side="right"))
        starts = ~missing & (own > 0) & np.isin(values, limits)
        first = missing if nulls else values == lowest
        # Range r also as ~r: the row only follows there.
        return pd.Series(
            [
                [r, *([~(r - 1)] if s else []), *([~len(limits)] if f else [])]
                for r, s, f in zip(own.tolist(), starts.tolist(), first.tolist(), strict=True)
            ]
        )

    dealt = (
        rows.select("*", F.explode(ranges("doc_id")).alias("r"))
        .select(
            "doc_id",
            "text",
            F.when(F.col("r") < 0, -F.col("r") - 1).otherwise(F.col("r")).alias("range"),
            (F.col("r") < 0).alias("follows"),
        )
        .repartition(max(deals, min(parts, 1 << 16)), "range")
        .sortWithinPartitions("range", "follows", F.asc_nulls_first("doc_id"), "text")
    )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, out, size = None, [], 0
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for doc_id, text, follows in zip(ids, batch["text"], batch["follows"], strict=True):
                if follows and current is None:
                    continue  # another row of the id that follows
                own = _Current(doc_id, text, k, w)
                if current is not None:
                    out.append(current.row(own, k, w))
                    size += len(current.text)
                current = None if follows else own
                if size > 1 << 22:
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                    out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    return dealt.mapInPandas(compared, schema)
