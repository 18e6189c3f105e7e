"""Whitening of embeddings by a bit-sliced scatter matrix.

1. Every entry becomes an integer, ``floor(scale * c)``. A chunk of rows is shifted to start at 0 in
   each dimension and cut into bit planes; a plane of a dimension is packed along the rows, 64 to a word.
2. The sum of products of two dimensions is that of popcounts of ANDed planes, weighted 2^(a + b);
   the shift is then undone. Sums of dimensions are weighted popcounts of single planes. All of it is
   integer arithmetic, so neither the order nor the number of tasks changes a bit of the result.
3. A task sends one matrix, in limbs of 31 bits, so that a long holds the sum of 2^32 of them. They are
   added in two salted steps. The driver gets the sums of one matrix, dimensions x dimensions.
4. There it is centred as integers, ``n * Z - S * S'``, and taken apart into eigenvectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import staged

#: Entries become ``floor(SCALE * c) + SHIFT``. The shift cancels in all that is centred.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows whose planes are packed at once; a multiple of 64.
CHUNK_ROWS = 4096
#: Bytes of planes that are ANDed at once.
AND_BYTES = 1 << 22
#: Integers are kept within 62 bits; an entry beyond that counts as the limit.
LIMIT = 2**62
_LIMB = 31
#: Tasks' matrices are added by this many tasks first, then by one for each row of the matrix.
SALTS = 32

_SUMS = "size int, line int, limb int, sums binary"


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    finite = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf))
    return vectors.where(F.col(vector_col).isNotNull() & finite)


def integers(matrix: np.ndarray) -> np.ndarray:
    """``floor(SCALE * c)`` as longs."""
    scaled = np.floor(matrix * float(SCALE))
    return np.where(np.abs(scaled) < LIMIT, scaled, 0).astype(np.int64) + np.where(
        scaled >= LIMIT, LIMIT, np.where(scaled <= -LIMIT, -LIMIT, 0)
    ).astype(np.int64)


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each vector length of a batch; vectors without entries have no matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    lists = lists.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(lists.offsets)
    lengths = np.diff(offsets)
    values = np.asarray(lists.values)
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[offsets[rows][:, None] + np.arange(size)]


def planes(shifted: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative longs (rows x dimensions): words of shape dimensions, bits, rows / 64."""
    rows, size = shifted.shape
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    padded = np.zeros((size, -(-rows // 64) * 64), np.int64)
    padded[:, :rows] = shifted.T
    out = np.empty((size, bits, padded.shape[1] // 64), np.uint64)
    for b in range(bits):
        out[:, b] = np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1).view(np.uint64)
    return out


def _weighted(counts: np.ndarray, axis: int, wide: bool) -> np.ndarray:
    """Popcounts by bit number along ``axis``, each times its power of two, added up."""
    powers = [1 << b for b in range(counts.shape[axis])]
    counts = np.moveaxis(counts, axis, -1)
    if wide:
        return (counts.astype(object) * np.array(powers, object)).sum(axis=-1)
    return counts @ np.array(powers, np.int64)


def scatter(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over the rows of ``z``: of each column, and of the products of all pairs of columns.

    Longs where they surely fit, else Python's integers.
    """
    rows, size = z.shape
    low = z.min(axis=0)
    top = max(int(z.max()), -int(z.min()))
    wide = rows * (2 * top) ** 2 >= 2**62
    if int(z.max()) - int(low.min()) >= 2**63:  # a shift would pass 64 bits: take half of the range at a time
        values = z.astype(object)
        return values.sum(axis=0), values.T @ values
    sliced = planes(z - low)
    bits, words = sliced.shape[1:]
    sums = _weighted(np.bitwise_count(sliced).sum(axis=2, dtype=np.int64), 1, wide)
    products = np.zeros((size, size), object if wide else np.int64)
    step = max(1, AND_BYTES // (bits * words * 8))
    for i in range(size):
        for j in range(i, size, step):
            right = sliced[j : j + step]
            line = 0
            for a in range(bits):
                ones = np.bitwise_count(sliced[i, a] & right).sum(axis=2, dtype=np.int64)
                line = line + (_weighted(ones, 1, wide) << a if not wide else _weighted(ones, 1, True) * (1 << a))
            products[i, j : j + step] = line
            products[j : j + step, i] = line
    # The shift undone: (y + low) (y' + low').
    base = low.astype(object) if wide else low
    products = products + np.outer(base, sums) + np.outer(sums, base) + rows * np.outer(base, base)
    return sums + rows * base, products


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """``values`` as longs of 31 bits each, the last one with the sign."""
    out = []
    while True:
        rest = values >> _LIMB
        if not np.any((rest != 0) & (rest != -1)):
            return [*out, values.astype(np.int64)]
        out.append((values & ((1 << _LIMB) - 1)).astype(np.int64))
        values = rest


class _Total:
    """Sums by (size, line, limb); line ``size`` holds the column sums, line ``size + 1`` the number of rows."""

    def __init__(self) -> None:
        self.parts: dict[tuple[int, int, int], np.ndarray] = {}

    def add(self, key: tuple[int, int, int], values: np.ndarray) -> None:
        if key in self.parts:
            self.parts[key] = self.parts[key] + values
        else:
            self.parts[key] = values

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (size, line, limb), values in self.parts.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array([size], pa.int32()),
                    "line": pa.array([line], pa.int32()),
                    "limb": pa.array([limb], pa.int32()),
                    "sums": pa.array([values.astype("<i8").tobytes()], pa.binary()),
                }
            )


def _scatter_of(column: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Total()
        for batch in batches:
            for _, matrix in _matrices(batch, column):
                size = matrix.shape[1]
                for at in range(0, len(matrix), CHUNK_ROWS):
                    z = integers(matrix[at : at + CHUNK_ROWS])
                    sums, products = scatter(z)
                    for limb, part in enumerate(_limbs(products)):
                        for line in range(size):
                            total.add((size, line, limb), part[line])
                    for limb, part in enumerate(_limbs(sums)):
                        total.add((size, size, limb), part)
                    total.add((size, size + 1, 0), np.array([len(z)], np.int64))
        yield from total.batches()

    return task


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = _Total()
    for batch in batches:
        for row in batch.to_pylist():
            total.add((row["size"], row["line"], row["limb"]), np.frombuffer(row["sums"], "<i8").astype(np.int64))
    yield from total.batches()


def _salt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = TaskContext.get().partitionId() % SALTS
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([salt] * batch.num_rows, pa.int32())], names=[*batch.schema.names, "salt"]
        )


class Basis:
    """What one vector length is whitened with."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]], components: int) -> None:
        size = len(sums)
        self.n, self.sums, self.size = n, sums, size
        centred = np.array([[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)], object)
        # A quotient of two Python integers is the double nearest to it.
        covariance = np.array([[centred[i, j] / (n * n) for j in range(size)] for i in range(size)], float)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.trace = sum(centred[i, i] for i in range(size)) / (n * n)
        # No more than rounding: nothing varies along such a component.
        self.values = np.where(values[order] > self.trace * size * np.finfo(float).eps, values[order], 0.0)
        self.vectors = vectors[:, order]
        self.means = np.array([s / n for s in sums])
        roots = np.sqrt(np.where(self.values > 0, self.values, 1.0))
        self.scale = np.where(self.values > 0, 1 / roots, np.nan)
        self.explained = self.values / self.trace if self.trace > 0 else np.zeros(len(order))

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * z - S)^2, exact; None where it passes 64 bits."""
        sums = np.array(self.sums, object)
        farthest = self.n * max(int(z.max()), -int(z.min())) + max(abs(s) for s in self.sums)
        if farthest**2 * self.size < 2**63:
            gaps = self.n * z - sums.astype(np.int64)
            return [int(x) for x in (gaps * gaps).sum(axis=1)]
        gaps = self.n * z.astype(object) - sums
        return [x if x < 2**63 else None for x in (gaps * gaps).sum(axis=1)]

    def whitened(self, z: np.ndarray) -> np.ndarray:
        # Centred by the mean's own fraction: z - S/n without losing what a large z would swallow.
        whole = np.array([s // self.n for s in self.sums], object).astype(np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return ((z - whole).astype(float) - part) @ self.vectors * self.scale


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Basis]:
    """A basis for each length of the usable vectors."""
    partial = usable(vectors, vector_col).select(F.col(vector_col)).mapInArrow(_scatter_of(vector_col), _SUMS)
    salted = partial.mapInArrow(_salt, _SUMS + ", salt int").repartition("size", "line", "salt")
    some = salted.drop("salt").mapInArrow(_added, _SUMS)
    lines = some.repartition("size", "line").mapInArrow(_added, _SUMS)
    found: dict[int, dict[int, list[int]]] = {}
    for row in lines.toLocalIterator():
        line = found.setdefault(row["size"], {}).setdefault(row["line"], [])
        part = np.frombuffer(bytes(row["sums"]), "<i8").astype(object) << (_LIMB * row["limb"])
        found[row["size"]][row["line"]] = list(part) if not line else [a + b for a, b in zip(line, part)]
    return {
        size: Basis(lines[size + 1][0], lines[size], [lines[i] for i in range(size)], components)
        for size, lines in found.items()
    }


_ROW = "id {id}, size int, n long, deviation long, whitened array<double>, explained array<double>"


def whiten_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: id, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``, and ``size``, the vector's length.

    A vector that is null or holds null, NaN or infinite entries is left out; one without entries has no
    component. Vectors of different lengths are different spaces, each fitted on its own. Repeated rows
    and ids, and null ids, stay as they are and count in the fit. Only the two named columns are read. An
    empty table gives no rows. A component along which nothing varies has ``whitened`` null and
    ``explained`` 0; it takes no part in ``identity_error``, which is computed from the whitened values of
    all rows. ``deviation`` is null where the exact number passes 64 bits. A vector shorter than
    ``components`` has as many components as entries.

    A task holds one matrix, 8 bytes x limbs (two or three) x dimensions squared; the driver their sum.
    """
    rows = usable(vectors, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = rows.schema["id"].dataType
    bases = fit(rows, "vector", components)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, matrix in _matrices(batch, "vector"):
                basis = bases[matrix.shape[1]]
                for at in range(0, len(matrix), CHUNK_ROWS):
                    z = integers(matrix[at : at + CHUNK_ROWS])
                    projected = basis.whitened(z)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "id": batch.column(0).take(pa.array(numbers[at : at + CHUNK_ROWS])),
                            "size": pa.array([basis.size] * len(z), pa.int32()),
                            "n": pa.array([basis.n] * len(z), pa.int64()),
                            "deviation": pa.array(basis.deviations(z), pa.int64()),
                            "whitened": pa.array([[None if math.isnan(x) else x for x in row] for row in projected.tolist()], pa.list_(pa.float64())),
                            "explained": pa.array([basis.explained.tolist()] * len(z), pa.list_(pa.float64())),
                        }
                    )

    projected = staged(rows.mapInArrow(task, _ROW.format(id=kind.simpleString())), "whitened")
    errors = identity_errors(projected, {size: len(b.values) for size, b in bases.items()})
    exploded = projected.select("id", "size", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part"))
    error = F.create_map(*[x for size, e in errors.items() for x in (F.lit(size), F.lit(e))])[F.col("size")] if errors else F.lit(None)
    return exploded.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        error.cast("double").alias("identity_error"),
        "size",
    )


def identity_errors(projected: DataFrame, components: dict[int, int]) -> dict[int, float]:
    """Largest entry of the whitened values' covariance minus the identity, by vector length."""
    most = max(components.values(), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    # covar_pop centres before it multiplies, and merges partial results the same way.
    entries = [F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]
    if not entries:
        return {}
    out = {}
    for row in projected.groupBy("size").agg(*entries).collect():
        gaps = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if row[f"c{i}_{j}"] is not None]
        out[row["size"]] = max(gaps, default=0.0)
    return out
