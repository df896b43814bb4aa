"""Removal of repeated word windows behind a count-min prefilter.

A window is ``width`` consecutive words of one document. Words go that are covered
by a window which also starts in a document with a smaller id.

Documents are dealt into chunks by one shuffle of the texts. Two passes follow:

1. Every chunk sketches its distinct windows: in each of two rows of a count-min
   sketch, a window adds one to the cell of its hash. The chunks' sketches are
   merged by adding, part by part of a row, and each chunk is told which of its
   cells reached two. A window's smallest count is never too low, so every window
   of two chunks is among those estimated repeated.
2. Only these are sent, with the smallest id that the chunk has for each, and
   grouped exactly; the chunk is told which start under a smaller id elsewhere.

Inside a chunk windows are compared directly. Chunks and parts send each other
sorted, packed arrays and get back one bit for each entry, in the order sent; a
window that a third of all documents hold is one entry for each chunk. A sketch
row has a cell for each byte of text, six or more for a window, so the share of
unique windows that pass (a few in a hundred) is the same at every size. Chunks
and parts grow with the square root of the input, so that what a chunk sends to
a part does not shrink; at 100 TB each has about 250 MB of texts.

Windows are compared by 64-bit hashes. Defined results: words are runs of
characters other than space and 0x09 to 0x0D; NULL is the empty text; texts
shorter than a window lose nothing; windows are judged on the input; rows of
equal id do not count as smaller than each other; a NULL id is larger than all
others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import mix, prefix_hash, span_hashes, window_hashes, words

WIDTH = 13
#: Bytes of texts in a chunk: at least, and as a multiple of the root of all bytes.
_CHUNK, _CHUNK_ROOT = 4 << 20, 25
#: Rows of the sketch, told apart by these; the exact pass is a third kind of message.
_SEEDS = (0, 0x632BE59BD9B4E019)
_EXACT = len(_SEEDS)
_SENT = "chunk long, kind int, part long, entries binary, ids binary"
_TOLD = "chunk long, kind int, part long, bits binary"
_LAST = np.iinfo(np.int64).max


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Sorted integers as the byte planes of their differences."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype(kind)
    return zlib.compress(steps.view(np.uint8).reshape(-1, steps.itemsize).T.tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().cumsum(dtype=np.dtype(kind) if size == 8 else np.uint64)


class _Chunk:
    """Words and windows of a chunk's documents, in the order of ids and texts."""

    def __init__(self, docs: pa.Table, width: int):
        order = docs.select(["doc_id", "text"])
        order = order.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.doc_ids = order.column("doc_id")
        self.ids = self.doc_ids.fill_null(_LAST).to_numpy()
        texts = [t or "" for t in order.column("text").to_pylist()]
        self.data, self.starts, self.ends, self.first = words(texts)
        of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        hashes = span_hashes(prefix_hash(self.data), self.starts, self.ends)
        if len(hashes) >= width:
            self.at = np.flatnonzero(of[: len(of) - width + 1] == of[width - 1 :])
            found = window_hashes(hashes, width)[self.at]
        else:
            self.at, found = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        # Documents ascend by id, so a window's first place has its smallest id.
        self.windows, place, self.which = np.unique(found, return_index=True, return_inverse=True)
        self.window_ids = self.ids[of[self.at]]
        self.least = self.window_ids[place]

    def cells(self, row: int, width_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, cells in that order) of the distinct windows in a row of the sketch."""
        key = self.windows if not row else mix(self.windows + np.uint64(_SEEDS[row]))
        cells = key >> np.uint64(64 - width_bits)
        order = np.argsort(cells, kind="stable")
        return order, cells[order]


class _Plan:
    """Sizes that all tasks share: chunks, bits of a sketch row's width, bits of a part's number."""

    def __init__(self, total: int, deals: int, width: int):
        size = max(_CHUNK, int(total**0.5 * _CHUNK_ROOT))
        self.width = width
        self.chunks = max(1, -(-total // size))
        self.part_bits = max(1, (max(self.chunks, deals) - 1).bit_length())
        self.cell_bits = max(self.part_bits + 1, (max(1, total) - 1).bit_length())

    def limits(self, ordered: np.ndarray, bits: int) -> np.ndarray:
        """Where each part begins among sorted values of so many bits."""
        parts = np.arange(1 << self.part_bits, dtype=np.uint64) << np.uint64(bits - self.part_bits)
        return np.append(np.searchsorted(ordered, parts), len(ordered))

    def sent(self, chunk: int, kind: int, limits: np.ndarray, entries, ids=None) -> pa.Table:
        """One row for each part that gets something."""
        parts = np.flatnonzero(np.diff(limits))
        cut = [(int(limits[p]), int(limits[p + 1])) for p in parts]
        columns = [
            pa.array(np.full(len(parts), chunk, np.int64)),
            pa.array(np.full(len(parts), kind, np.int32)),
            pa.array(parts),
            pa.array([entries(a, b) for a, b in cut], pa.binary()),
            pa.array([ids(a, b) if ids else None for a, b in cut], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, names=["chunk", "kind", "part", "entries", "ids"])

    def told(self, replies: pa.Table, kind: int, limits: np.ndarray) -> np.ndarray:
        """The bits that parts sent back about a kind of message, in the order sent."""
        out = np.zeros(limits[-1], bool)
        for k, part, bits in zip(*(replies.column(c).to_pylist() for c in ("kind", "part", "bits")), strict=True):
            if k == kind:
                a, b = limits[part], limits[part + 1]
                out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return out

    def sketch(self, key, docs: pa.Table) -> pa.Table:
        """A chunk's sketch: the cells of its windows, row by row and part by part."""
        chunk, low = _Chunk(docs, self.width), np.uint64(self.cell_bits - self.part_bits)
        out = []
        for row in range(len(_SEEDS)):
            _, cells = chunk.cells(row, self.cell_bits)
            inside = cells & ((np.uint64(1) << low) - np.uint64(1))
            limits = self.limits(cells, self.cell_bits)
            out.append(self.sent(key[0].as_py(), row, limits, lambda a, b, x=inside: _packed(x[a:b], "<u4")))
        return pa.concat_tables(out)

    def merge(self, messages: pa.Table) -> pa.Table:
        """A part of a sketch row: counts (two or more are two) of all chunks, and who met such a cell."""
        counts = np.zeros(1 << (self.cell_bits - self.part_bits), np.uint8)
        cells = [_unpacked(e, "<u4") for e in messages.column("entries").to_pylist()]
        for c in cells:
            counts[c] = np.minimum(counts[c] + 1, 2)
            counts[c[1:][c[1:] == c[:-1]]] = 2
        bits = [np.packbits(counts[c] == 2).tobytes() for c in cells]
        return messages.select(["chunk", "kind", "part"]).append_column("bits", pa.array(bits, pa.binary()))

    def _open(self, chunk: _Chunk, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows estimated repeated, by part, id and hash; where each part begins."""
        least = np.ones(len(chunk.windows), bool)
        for row in range(len(_SEEDS)):
            order, cells = chunk.cells(row, self.cell_bits)
            least[order] &= self.told(replies, row, self.limits(cells, self.cell_bits))
        found = np.flatnonzero(least)
        part = chunk.windows[found] >> np.uint64(64 - self.part_bits)
        found = found[np.lexsort((chunk.windows[found], chunk.least[found], part))]
        return found, np.append(
            np.searchsorted(np.sort(part), np.arange(1 << self.part_bits, dtype=np.uint64)), len(found)
        )

    def repeated(self, key, docs: pa.Table, replies: pa.Table) -> pa.Table:
        """A chunk's windows estimated repeated, with the smallest id it has for each."""
        chunk = _Chunk(docs, self.width)
        found, limits = self._open(chunk, replies)
        hashes, ids = chunk.windows[found], chunk.least[found].view(np.uint64)
        return self.sent(
            key[0].as_py(), _EXACT, limits, lambda a, b: hashes[a:b].tobytes(), lambda a, b: _packed(ids[a:b], "<u8")
        )

    def group(self, messages: pa.Table) -> pa.Table:
        """A part of all windows estimated repeated: which of them start under a smaller id elsewhere."""
        hashes = [np.frombuffer(e, np.uint64) for e in messages.column("entries").to_pylist()]
        ids = [_unpacked(i, "<u8").view(np.int64) for i in messages.column("ids").to_pylist()]
        values, which = np.unique(np.concatenate(hashes), return_inverse=True)
        every = np.concatenate(ids)
        least = np.full(len(values), _LAST)
        np.minimum.at(least, which, every)
        later = np.split(every > least[which], np.cumsum([len(h) for h in hashes])[:-1])
        bits = [np.packbits(x).tobytes() for x in later]
        return messages.select(["chunk", "kind", "part"]).append_column("bits", pa.array(bits, pa.binary()))

    def kept(self, key, docs: pa.Table, replies: pa.Table) -> pa.Table:
        """A chunk's documents without the words that repeated windows cover."""
        chunk = _Chunk(docs, self.width)
        found, limits = self._open(chunk, replies)
        later = np.zeros(len(chunk.windows), bool)
        later[found] = self.told(replies, _EXACT, limits)
        goes = chunk.at[later[chunk.which] | (chunk.window_ids > chunk.least[chunk.which])]
        # Words under a window, from the windows' starts and ends.
        change = np.zeros(len(chunk.starts) + 1, np.int64)
        change[goes] += 1
        change[goes + self.width] -= 1
        stays = np.cumsum(change)[:-1] == 0
        before = np.concatenate(([0], np.cumsum(stays)))[chunk.first]
        n_words, n_kept = np.diff(chunk.first), np.diff(before)
        # A word and the gap after it, which becomes one space.
        starts, ends = chunk.starts[stays], chunk.ends[stays]
        data = chunk.data.copy()
        data[ends] = 0x20
        edges = np.zeros(len(data) + 1, np.int8)
        edges[starts] += 1
        edges[ends + 1] -= 1
        text = data[np.cumsum(edges[:-1], dtype=np.int8) > 0].tobytes()
        sizes = np.concatenate(([0], np.cumsum(ends - starts + 1)))[before]
        rest = [text[a : max(a, b - 1)] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]
        columns = [
            chunk.doc_ids.combine_chunks(),
            pa.array(n_words.astype(np.int64)),
            pa.array((n_words - n_kept).astype(np.int64)),
            pa.array(rest, pa.binary()).cast(pa.string()),
        ]
        return pa.Table.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of (doc_id, text); kept words are a space apart."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    plan = _Plan(total, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), width)
    # All three passes over the texts read this one shuffle.
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(plan.chunks))).groupBy("chunk")

    sketches = dealt.applyInArrow(lambda key, docs: plan.sketch(key, docs), _SENT)
    over = sketches.groupBy("kind", "part").applyInArrow(lambda sent: plan.merge(sent), _TOLD)
    open_windows = dealt.cogroup(over.groupBy("chunk")).applyInArrow(lambda key, docs, told: plan.repeated(key, docs, told), _SENT)
    later = open_windows.groupBy("part").applyInArrow(lambda sent: plan.group(sent), _TOLD)
    replies = over.unionByName(later).groupBy("chunk")
    schema = "doc_id long, n_words long, n_removed long, kept string"
    return dealt.cogroup(replies).applyInArrow(lambda key, docs, told: plan.kept(key, docs, told), schema)
