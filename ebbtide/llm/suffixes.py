"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A window is the first ``width`` bytes of a suffix; windows that start in several
places are to go. Suffixes are ordered by digits, most significant first, and
only groups of several suffixes reach the next pass. The digits are taken from
inside the window rather than from its first byte on, so that neighbouring
windows can travel as one row:

1. the smallest hash of the window's runs of ``_share(width)`` bytes (rightmost
   of equal ones). Neighbouring windows mostly have the same run, so a row stands
   for a stretch of windows about one run;
2. of stretches that share the run but are not equal as a whole: the bytes that
   16 neighbouring windows have in common;
3. of such neighbours that are not all equal: the whole windows.

Equal windows have equal digits, so a group of the last pass is exactly one
repeated window. Stretches that are equal as a whole are repeated windows all
along, and only one of them goes on, to be compared with others. Equal stretches
of one batch travel as one row, so a passage that a third of all documents share
is one row for each batch.

Texts are compared as UTF-8 bytes by 64-bit hashes of whole windows. Defined
results: NULL is the empty text; texts shorter than a window have none; matches
never cross documents; repeated rows are copies of each other and repeat all
their windows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.vectors import mix, prefix_hash, sliding_min, span_hashes
from ebbtide.sources.storage import stored

WIDTH = 200
#: Windows that the second digit takes together.
_BLOCK = 16
#: Windows hashed at once, and bytes of rows that one task sorts.
_SEGMENT, _PART_BYTES = 1 << 21, 32 << 20
#: Bytes up to which a checked table is sent to all executors.
_SMALL = 32 << 20
_LOW = np.uint64(0xFFFFFFFF)
_STRETCH = np.dtype(
    [("a", "<u8"), ("c", "<u8"), ("d", "<i8"), ("pos", "<u4"), ("l", "<u2"), ("r", "<u2"), ("known", "u1")]
)
_NEAR = np.dtype(
    [("a", "<u8"), ("c", "<u8"), ("d", "<i8"), ("lo", "<u4"), ("n", "u1"), ("known", "u1"), ("w", "<u8", (_BLOCK,))]
)
_RANGES = "d long, lo long, hi long, pos long, known boolean"


def _share(width: int) -> int:
    return max(1, width * 7 // 25)


def _stretches(data: np.ndarray, d: int, width: int) -> Iterator[np.ndarray]:
    """Rows of ``_STRETCH``: the windows pos-l .. pos-r, whose run is at pos."""
    run = _share(width)
    windows = len(data) - width + 1
    for s in range(0, windows, _SEGMENT):
        part = data[s : min(s + _SEGMENT, windows) + width - 1]
        prefix = prefix_hash(part)
        starts = np.arange(len(part) - run + 1)
        hashes = span_hashes(prefix, starts, starts + run)
        least = sliding_min(
            (hashes & ~_LOW) | (_LOW - starts.astype(np.uint64)), width - run + 1
        )
        lo = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        hi = np.append(lo[1:], len(least)) - 1
        pos = (_LOW - (least[lo] & _LOW)).astype(np.int64)
        rows = np.zeros(len(lo), _STRETCH)
        shape = (pos - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - lo).astype(np.uint64)
        rows["a"], rows["c"] = hashes[pos], mix(span_hashes(prefix, lo, hi + width) + shape)
        rows["d"], rows["pos"], rows["l"], rows["r"] = d, pos + s, pos - lo, pos - hi
        yield rows


def _near(data: np.ndarray, d: int, pos, lo, hi, known, width: int) -> np.ndarray:
    """Rows of ``_NEAR``: up to 16 windows of each stretch that lie in one block around its run."""
    prefix = prefix_hash(data)
    first, last = (pos - hi) // _BLOCK, (pos - lo) // _BLOCK
    count = last - first + 1
    of = np.repeat(np.arange(len(pos)), count)
    block = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]
    top = pos[of] - block * _BLOCK
    low, high = np.maximum(lo[of], top - _BLOCK + 1), np.minimum(hi[of], top)
    rows = np.zeros(len(of), _NEAR)
    rows["a"] = mix(span_hashes(prefix, top, top - _BLOCK + 1 + width) + block.astype(np.uint64))
    shape = (top - low) * _BLOCK + (high - low)
    rows["c"] = mix(span_hashes(prefix, low, high + width) + shape.astype(np.uint64))
    rows["d"], rows["lo"], rows["n"], rows["known"] = d, low, high - low + 1, known[of]
    for i in range(_BLOCK):
        at = np.minimum(low + i, high)
        rows["w"][:, i] = span_hashes(prefix, at, at + width)
    return rows


def _dealt(rows: np.ndarray, parts: int) -> pd.DataFrame:
    """The rows as packed arrays, one for each part, by their first digit."""
    part = (rows["a"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rows, limits = rows[order], np.searchsorted(part[order], np.arange(parts + 1))
    cut = [rows[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:], strict=True)]
    out = pd.DataFrame({"part": range(parts), "data": cut})
    return out[out["data"].str.len() > 0]


def _groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by digit and content; which begin a content; contents' and digits' group of each."""
    rows = rows[np.lexsort((rows["c"], rows["a"]))]
    new_a = np.concatenate(([True], rows["a"][1:] != rows["a"][:-1]))
    new_c = new_a | np.concatenate(([True], rows["c"][1:] != rows["c"][:-1]))
    return rows, new_c, np.cumsum(new_c) - 1, np.cumsum(new_a) - 1


def _frame(d, lo, hi, pos=-1, known=True) -> pd.DataFrame:
    columns = {"d": d, "lo": lo, "hi": hi, "pos": pos, "known": known}
    return pd.DataFrame({k: v if np.ndim(v) == 0 else v.astype(np.int64) for k, v in columns.items()}, index=range(len(d))).astype({"known": bool})


def _of_stretches(rows: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(repeated stretches, one stretch of each content that shares its run with another content)."""
    rows, new_c, c, a = _groups(rows)
    size = np.bincount(c)
    repeated = (size[c] > 1) | (np.bincount(c, rows["known"])[c] > 0)
    contents = np.bincount(a, new_c)
    lo, hi = rows["pos"].astype(np.int64) - rows["l"], rows["pos"].astype(np.int64) - rows["r"]
    done = repeated & (rows["known"] == 0)
    more = new_c & (contents[a] > 1)
    return (
        _frame(rows["d"][done], lo[done], hi[done]),
        _frame(rows["d"][more], lo[more], hi[more], rows["pos"][more], repeated[more]),
    )


def _of_near(rows: np.ndarray) -> Iterator[pd.DataFrame]:
    """Repeated windows among rows of ``_NEAR``."""
    rows, new_c, c, a = _groups(rows)
    repeated = (np.bincount(c)[c] > 1) | (np.bincount(c, rows["known"])[c] > 0)
    low = rows["lo"].astype(np.int64)
    done = repeated & (rows["known"] == 0)
    yield _frame(rows["d"][done], low[done], low[done] + rows["n"][done] - 1)
    several = new_c & (np.bincount(a, new_c)[a] > 1)
    open_rows, whole = rows[several], repeated[several]
    inside = np.arange(_BLOCK) < open_rows["n"][:, None]
    values = open_rows["w"][inside]
    if not len(values):
        return
    _, at, count = np.unique(values, return_inverse=True, return_counts=True)
    row, offset = np.nonzero(inside)
    found = (count[at] > 1) & ~whole[row]
    start = open_rows["lo"][row[found]].astype(np.int64) + offset[found]
    yield _frame(open_rows["d"][row[found]], start, start)


def _repeats(docs: DataFrame, width: int, parts: int) -> DataFrame:
    """Ranges of windows (d, lo, hi): with pos -1, repeated ones; else stretches to go on with."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                rows
                for d, data in zip(batch["d"], batch["data"], strict=True)
                for rows in _stretches(np.frombuffer(data, np.uint8), d, width)
            ]
            if not found:
                continue
            rows, new_c, c, _ = _groups(np.concatenate(found))
            several = np.bincount(c)[c] > 1
            rows["known"] = several
            yield _dealt(rows[new_c], parts)
            # Equal within the batch: repeated, whatever the other batches hold.
            again = rows[several]
            again["a"] = again["d"].view(np.uint64)
            again["known"] = 2
            yield _dealt(again, parts)

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(group["data"]), _STRETCH)
        again, rows = rows[rows["known"] == 2], rows[rows["known"] != 2]
        pos = again["pos"].astype(np.int64)
        settled = _frame(again["d"], pos - again["l"], pos - again["r"])
        return pd.concat([settled, *_of_stretches(rows)]) if len(rows) else settled

    blobs = docs.mapInPandas(cut, "part int, data binary")
    return blobs.groupBy("part").applyInPandas(sort, _RANGES)


def _joined(docs: DataFrame, per_doc: DataFrame, numbers: int, how: str) -> DataFrame:
    """Documents with what a table has about each; small tables are sent rather than dealt."""
    if numbers * 8 <= _SMALL:
        per_doc = F.broadcast(per_doc)  # its size is checked; larger ones are joined by shuffle
    return docs.join(per_doc, "d", how)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The documents as (d, doc_id, data), and (d, start, end): their maximal runs of repeated bytes."""
    if width < _BLOCK:
        raise ValueError(f"windows of at least {_BLOCK} bytes are needed")
    spark = docs.sparkSession
    docs = docs.select(
        F.xxhash64("doc_id", "text").alias("d"),
        "doc_id",
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"),
    )
    total = docs.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = 2 * _STRETCH.itemsize / (width - _share(width) + 2)
    parts = max(deals, int(total * row) // _PART_BYTES)
    long_enough = docs.where(F.octet_length("data") >= width).select("d", "data")
    ranges = stored(_repeats(long_enough, width, parts), "repeats")

    going = ranges.where("pos >= 0")
    open_docs = stored(
        going.groupBy("d").agg(*(F.collect_list(c).alias(c) for c in ("pos", "lo", "hi", "known"))),
        "repeats-open",
    )

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                _near(np.frombuffer(r.data, np.uint8), r.d, *map(np.asarray, (r.pos, r.lo, r.hi, r.known)), width)
                for r in batch.itertuples()
            ]
            for start in range(0, len(found), 2000):
                yield _dealt(np.concatenate(found[start : start + 2000]), parts)

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(list(_of_near(np.frombuffer(b"".join(group["data"]), _NEAR))))

    more = (
        _joined(long_enough, open_docs, going.count() * 4, "inner")
        .mapInPandas(near, "part int, data binary")
        .groupBy("part")
        .applyInPandas(sort, _RANGES)
    )
    # Ranges of window starts become runs of bytes: touching ones are one.
    every = ranges.where("pos < 0").unionByName(more).select(
        "d", F.col("lo").alias("start"), (F.col("hi") + width).alias("end")
    )
    order = Window.partitionBy("d").orderBy("start")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        every.withColumn("new", (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int"))
        .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("d", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("d", "start", "end")
    )
    return docs, runs


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs, runs = repeated_spans(docs, width)
    per_doc = stored(
        runs.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs")).select(
            "d", F.col("runs.start").alias("starts"), F.col("runs.end").alias("ends")
        ),
        "repeats-runs",
    )
    numbers = per_doc.agg(F.coalesce(F.sum(2 * F.size("starts") + 8), F.lit(0))).first()[0]

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                starts = [] if r.starts is None else r.starts.tolist()
                ends = [] if r.ends is None else r.ends.tolist()
                pieces = zip([0, *ends], [*starts, len(r.data)], strict=True)
                rest = b"".join([r.data[a:b] for a, b in pieces])
                out.append((len(r.data), len(r.data) - len(rest), len(starts), rest))
            rows = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            yield rows.assign(doc_id=batch["doc_id"].to_numpy())

    joined = _joined(docs, per_doc, numbers, "left").select("doc_id", "data", "starts", "ends")
    schema = f"n_bytes long, n_removed long, n_spans long, kept binary, doc_id {kind}"
    return joined.mapInPandas(kept, schema)
