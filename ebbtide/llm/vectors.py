"""Numpy helpers that run inside tasks: rolling hashes, sliding minima, words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; the longest run so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash, one longer than the input; see ``span_hashes``."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    terms = (values.astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, len(values))
    np.cumsum(terms, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal contents have equal hashes wherever they stand."""
    raw = (prefix[ends] - prefix[starts]) * _powers_of(_INVERSE, len(prefix))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values, by its start."""
    n = len(values) - width + 1
    prefix = prefix_hash(values)
    return mix((prefix[width:] - prefix[:n]) * _powers_of(_INVERSE, n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by its start."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def slices(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """The texts (NULL: empty) in runs of about ``size`` characters, each with its first index."""
    start, held, chars = 0, [], 0
    for text in texts:
        held.append(text or "")
        chars += len(held[-1])
        if chars >= size:
            yield start, held
            start, held, chars = start + len(held), [], 0
    if held:
        yield start, held


def words(
    texts: list[str], lower: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, first word of each text and the end) of some texts.

    A word is a run of bytes other than space and 0x09 to 0x0D; the texts are
    laid out one after the other, a line break apart. ``lower`` is for A to Z.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    if lower:
        encoded = [e.lower() for e in encoded]
    data = np.frombuffer(b"\n".join([*encoded, b""]) or b"\n", dtype=np.uint8)
    gap = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    return data, starts, ends, np.searchsorted(starts, offsets)
