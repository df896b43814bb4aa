"""Whitening of embeddings by polarisation covariance.

Entries become integers, ``x = floor(256 * c)``. The fit list holds each distinct
x vector once. Over it, Spark sums exact squares of centred values for every
dimension and for every sum of two dimensions; by polarisation,

    2 cov(a, b) = var(a + b) - var(a) - var(b),

which recovers all cross-covariances from variances. The matrix is assembled
from exact integers, so nothing cancels, and ``eigh`` gives the components.

Values are centred before they are squared, by the whole number next to the
mean; what the mean has beyond it is put right afterwards, in integers. Sums
travel as limbs of 32 bits, so no size of input or value overflows. Each task
sends one row for each pair of dimensions whatever its rows; the driver holds
the dimensions' square matrix, never vectors. Equal vectors are made one before
they are shuffled, so a vector that a third of all rows hold is one row a task.

Defined results: rows whose vector is NULL or holds NULL, NaN or infinite entries
are left out; shorter vectors are filled with zeros to the longest; entries
beyond a long are its largest or smallest value; rows with equal vectors have
equal results, NULL ids among them; no rows give no rows. A component without
variance (its eigenvalue is not above rounding) has NULL as ``whitened`` and
takes no part in ``identity_error``, which is 0 if there is none other. Where the
vectors have no variance at all, ``explained`` is NULL. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

SCALE = 256
_LIMBS, _LIMB_BITS = 5, 32
#: Values up to here, and rows at once, keep sums of squares of pairs within 64 bits.
_SAFE, _ROWS = 1 << 20, 1 << 14
_SUMS = ", ".join(f"s{k} long" for k in range(_LIMBS))


@dataclass
class Whitening:
    """What ``fit`` learns: n vectors, their sums by dimension, and the leading components."""

    n: int
    sums: list[int]
    values: list[float] = field(default_factory=list)
    vectors: np.ndarray | None = None
    trace: float = 0.0
    identity_error: float = 0.0


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & fine


def whole(vector: Column) -> Column:
    """The entries as whole numbers of 1/256."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(SCALE)))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The column x of a batch, one row for each vector, filled with zeros to ``width``."""
    column = batch.column(batch.schema.get_field_index("x"))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _exact(values: np.ndarray, bound: int) -> np.ndarray:
    """The values as 64-bit integers where all stay below ``bound``, else as Python's integers."""
    if len(values) and max(-int(values.min()), int(values.max())) >= bound:
        return values.astype(object)
    return values


def _limbs(totals: dict) -> dict[str, list[int]]:
    """Columns of signed totals cut into limbs; their sums by limb make up the sum."""
    mask = (1 << _LIMB_BITS) - 1
    out = {}
    for k in range(_LIMBS):
        last = k == _LIMBS - 1
        out[f"s{k}"] = [(t >> k * _LIMB_BITS) if last else (t >> k * _LIMB_BITS) & mask for t in totals.values()]
    return out


def _joined(rows: pa.Table) -> list[int]:
    """Totals from summed limbs."""
    columns = [rows.column(f"s{k}").to_pylist() for k in range(_LIMBS)]
    return [sum(v << k * _LIMB_BITS for k, v in enumerate(limbs)) for limbs in zip(*columns, strict=True)]


def _summed(rows: DataFrame, partial, *keys: str) -> pa.Table:
    """Totals by key over all tasks' partial totals ({key: total} from the batches of a task)."""

    def each_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = partial(batches)
        columns = {k: [key[i] for key in totals] for i, k in enumerate(keys)}
        types = [(k, pa.int64()) for k in (*keys, *(f"s{k}" for k in range(_LIMBS)))]
        yield pa.RecordBatch.from_pydict(columns | _limbs(totals), pa.schema(types))

    schema = ", ".join(f"{k} long" for k in keys) + f", {_SUMS}"
    sums = rows.mapInArrow(each_task, schema).groupBy(*keys)
    return sums.agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(_LIMBS))).toArrow()


def _sums_of(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """(number of vectors, sums by dimension)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> dict:
        totals = [0] * (width + 1)
        for batch in batches:
            x = _matrix(batch, width)
            totals[width] += len(x)
            sums = _exact(x, (1 << 62) // max(1, len(x))).sum(axis=0)
            totals[:width] = [a + int(b) for a, b in zip(totals, sums)]  # noqa: B905
        return {(i,): t for i, t in enumerate(totals)}

    found = _summed(rows, partial, "i")
    by_key = dict(zip(found.column("i").to_pylist(), _joined(found), strict=True))
    return by_key[width], [by_key[i] for i in range(width)]


def _squares_of(rows: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Sums of (x_i - centre_i)^2 by (i, i), and of (x_i - centre_i + x_j - centre_j)^2 by (i, j)."""
    width = len(centre)

    def partial(batches: Iterator[pa.RecordBatch]) -> dict:
        totals = {(i, j): 0 for i in range(width) for j in range(i, width)}
        for batch in batches:
            x = _matrix(batch, width)
            for start in range(0, len(x), _ROWS):
                part = x[start : start + _ROWS]
                safe = (np.abs(part.astype(float) - np.array(centre, float)) < _SAFE).all(axis=1)
                plain = part[safe] - np.array(centre) if safe.any() else part[:0]
                for w in (plain, part[~safe].astype(object) - np.array(centre, object)):
                    if not len(w):
                        continue
                    for i in range(width):
                        pairs = w[:, i:] + w[:, i : i + 1]
                        pairs[:, 0] = w[:, i]
                        for j, t in enumerate((pairs * pairs).sum(axis=0), i):
                            totals[i, j] += int(t)
        return totals

    found = _summed(rows, partial, "i", "j")
    keys = zip(found.column("i").to_pylist(), found.column("j").to_pylist(), strict=True)
    return dict(zip(keys, _joined(found), strict=True))


def covariance(rows: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums by dimension, covariance matrix with divisor n) of the vectors in column x."""
    n, sums = _sums_of(rows, width)
    if not n or not width:
        return n, sums, np.zeros((width, width))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    squares = _squares_of(rows, centre)
    # n times the sum of squared centred values of a dimension or of a sum of two:
    # the whole numbers next to the means leave (sum of rests)^2 / n of it.
    spread = {
        (i, j): n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), q in squares.items()
    }
    out = np.zeros((width, width))
    for (i, j), s in spread.items():
        twice = 2 * s if i == j else s - spread[i, i] - spread[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)
    return n, sums, out


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values by row and component; NaN where a component has no variance."""
    centred = _centred(x, model).astype(float) / model.n
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.array(model.values) > 0, centred @ model.vectors / np.sqrt(model.values), np.nan)


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums, exactly."""
    largest = max([1, *(abs(s) for s in model.sums)])
    x = _exact(x, ((1 << 62) - min(largest, 1 << 61)) // model.n)
    kind = object if x.dtype == object or largest >= 1 << 61 else np.int64
    return x.astype(kind) * model.n - np.array(model.sums, kind)


def _square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if y.dtype == object or (len(y) and y.shape[1] and int(np.abs(y).max()) >= 1 << 50):
        return [sum(v * v for v in map(int, row)) for row in y]
    high, low = y >> 25, y & ((1 << 25) - 1)
    parts = (high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)
    return [(a << 50) + (b << 26) + c for a, b, c in zip(*(p.tolist() for p in parts), strict=True)]


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    width, kept = len(model.sums), [k for k, v in enumerate(model.values) if v > 0]
    if not kept:
        return 0.0
    pairs = [(a, b) for i, a in enumerate(kept) for b in kept[i:]]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _projected(_matrix(batch, width), model)
            means = {f"m{a}": [w[:, a].sum()] for a in kept}
            products = {f"p{a}_{b}": [(w[:, a] * w[:, b]).sum()] for a, b in pairs}
            yield pa.RecordBatch.from_pydict(means | products)

    names = [*(f"m{a}" for a in kept), *(f"p{a}_{b}" for a, b in pairs)]
    sums = rows.mapInArrow(partial, ", ".join(f"{c} double" for c in names))
    found = sums.agg(*(F.sum(c).alias(c) for c in names)).first()
    errors = (
        found[f"p{a}_{b}"] / model.n - found[f"m{a}"] / model.n * found[f"m{b}"] / model.n - (a == b) for a, b in pairs
    )
    return max(map(abs, errors))


def fit(vectors: DataFrame, column: str = "embedding", components: int = 4) -> Whitening:
    """The leading components of the distinct usable vectors in a column."""
    usable_rows = vectors.where(usable(F.col(column))).select(whole(F.col(column)).alias("x"))
    rows = stored(usable_rows.distinct(), "whitening-fit")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    n, sums, matrix = covariance(rows, width)
    model = Whitening(n, sums)
    if not n or not width:
        return model
    values, vecs = np.linalg.eigh(matrix)
    values, vecs = values[::-1], vecs[:, ::-1]
    limit = width * np.finfo(float).eps * max(values[0], 0)
    count = min(components, width)
    model.values = [float(v) if v > limit else 0.0 for v in values[:count]]
    model.vectors = np.ascontiguousarray(vecs[:, :count])
    model.trace = float(np.trace(matrix))
    model.identity_error = _identity_error(rows, model)
    return model


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each usable vector.

    ``deviation`` is decimal(38, 0), NULL beyond it. Vectors longer than those of
    the fit list lose what is beyond its dimensions.
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    width, count = len(model.sums), len(model.values)
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = vectors.where(usable(F.col(column))).select(
        key, F.slice(whole(F.col(column)), 1, width).alias("x")
    )
    explained = [v / model.trace if model.trace > 0 else None for v in model.values]
    limit = 10**38

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, width)
            exact = [Decimal(d) if d < limit else None for d in _square_sums(_centred(x, model))]
            deviation = pa.array(exact, pa.decimal128(38, 0))
            whitened = _projected(x, model)
            for k in range(count):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(x), k + 1, np.int32)),
                        pa.array(np.full(len(x), model.n, np.int64)),
                        deviation,
                        pa.array(whitened[:, k], from_pandas=True),
                        pa.array([explained[k]] * len(x), pa.float64()),
                        pa.array(np.full(len(x), model.identity_error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(each, schema)
