"""Bit-sliced scatter and whitening, against plain arithmetic."""

import math
import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from oreline.llm import whitening
from oreline.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.mark.parametrize("top", [3, 1 << 12, 1 << 40, whitening.LIMIT])
@pytest.mark.parametrize("rows", [1, 63, 64, 200])
def test_scatter_is_exact(top, rows):
    rng = random.Random(rows)
    z = np.array([[rng.randint(-top, top) for _ in range(5)] for _ in range(rows)], np.int64)
    sums, products = whitening.scatter(z)
    exact = z.astype(object)
    assert [int(x) for x in sums] == list(exact.sum(axis=0))
    assert [[int(x) for x in r] for r in products] == (exact.T @ exact).tolist()
    back = sum(part.astype(object) << (31 * k) for k, part in enumerate(whitening._limbs(products)))
    assert back.tolist() == (exact.T @ exact).tolist()


def by_hand(vectors):
    """The contract, row by row, with Python integers and numpy's eigenvectors."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(size)]
    deviations = [sum((n * r[i] - sums[i]) ** 2 for i in range(size)) for r in x]
    centred = np.array([[r[i] - sums[i] / n for i in range(size)] for r in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return deviations, values[order], centred @ axes[:, order] / np.sqrt(values[order]), values.sum()


@pytest.mark.parametrize("tasks", [1, 7])
def test_against_plain_arithmetic(spark, tasks):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(700, 12)) @ np.diag(np.linspace(1, 3, 12)) + 0.3).astype(np.float32).astype(float)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    found = whitening.whiten_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(tasks)).collect()
    deviations, values, white, trace = by_hand(vectors.tolist())
    assert len(found) == 700 * 8
    columns = np.zeros((700, 8))
    for r in found:
        assert r.n == 700 and r.deviation == deviations[r.vec_id] and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-9)
        columns[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((columns * white[:, :8]).sum(axis=0))
    assert np.abs(columns * signs - white[:, :8]).max() < 1e-7


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], "a", 1),
        (2, [2.0, 1.5], "a", 1),
        (2, [2.0, 1.5], "a", 1),
        (None, [0.0, -4.0], None, None),
        (3, None, "a", 1),
        (4, [nan, 1.0], "a", 1),
        (5, [inf, 1.0], "a", 1),
        (6, [None, 1.0], "a", 1),
        (7, [], "a", 1),
        (8, [1.0, 2.0, 3.0], "a", 1),
        (9, [3e38, -3e38, 1.0], "a", 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, component long")
    found = whitening.whiten_vectors(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "size"]
    counts = dict(rows_of(found.groupBy("vec_id").agg(F.count("*"))))
    assert counts == {1: 2, 2: 4, None: 2, 8: 3, 9: 3}
    flat = found.where("size = 2")
    assert {(r.n, r.identity_error < 1e-9) for r in flat.collect()} == {(4, True)}
    # Two vectors vary along one line only; the numbers of the far one pass 64 bits.
    wide = found.where("size = 3").orderBy("vec_id", "component").collect()
    assert [r.whitened is None for r in wide] == [False, True, True] * 2
    assert {r.deviation for r in wide} == {None} and all(abs(abs(r.whitened) - 1) < 1e-9 for r in (wide[0], wide[3]))
    assert whitening.whiten_vectors(df.limit(0)).count() == 0


def test_equal_vectors_have_nothing_to_whiten(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], "vec_id long, embedding array<double>")
    assert {(r.deviation, r.whitened, r.explained) for r in whitening.whiten_vectors(df).collect()} == {(0, None, 0.0)}
