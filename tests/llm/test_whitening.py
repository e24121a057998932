import math

import numpy as np
import pytest

from sensorloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component string, n int, whitened string"


def brute_force(rows: list[tuple], wanted: int) -> dict:
    able = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in able), default=0)
    ints = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] + [1000000] * (dims - len(v))) for i, v in able]
    distinct = sorted({tuple(x) for _, x in ints})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in distinct], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    found = {}
    for i, x in ints:
        scaled = [n * a - s for a, s in zip(x, sums)]
        z = np.array(scaled, float) / n @ vectors
        for j, value in enumerate(values):
            if value > 1e-12 * values[0]:
                found.setdefault((i, j + 1), []).append((n, sum(a * a for a in scaled), abs(z[j]) / math.sqrt(value), value))
    return found


def check(spark, rows: list[tuple], wanted: int = 16, tolerance: float = 1e-8) -> None:
    vectors = spark.createDataFrame([(i, v, "c", 1, "w") for i, v in rows], SCHEMA).repartition(3)
    want = brute_force(rows, wanted)
    got: dict = {}
    for r in whitening.whiten(vectors, wanted).collect():
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error <= 1e-10
    assert got.keys() == want.keys()
    for key, rows_of_key in want.items():
        for (n, deviation, z, value), (n2, deviation2, z2, _) in zip(sorted(rows_of_key), sorted(got[key]), strict=True):
            assert (n, deviation) == (n2, deviation2)
            assert z == pytest.approx(z2, rel=tolerance, abs=tolerance)


def sample(n: int, dims: int, seed: int) -> list[tuple]:
    pick = np.random.default_rng(seed)
    spread = np.geomspace(1, 0.2, dims)
    return [(i, [float(x) for x in v]) for i, v in enumerate(pick.normal(0.3, 1, (n, dims)) * spread)]


def test_as_an_eigenvalue_routine(spark):
    rows = sample(700, 70, 1)
    rows += [(800, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (801, None), (802, [float("nan")] * 70),
             (803, [None] + [1.0] * 69), (804, [float("inf")] * 70), (805, []), (806, [0.5, -0.5])]
    check(spark, rows)


def test_nearly_flat_spectrum(spark):
    pick = np.random.default_rng(2)
    check(spark, [(i, [float(x) for x in v]) for i, v in enumerate(pick.normal(0, 1, (3000, 64)))])


def test_strong_leading_directions(spark):
    pick = np.random.default_rng(3)
    base = pick.normal(0, 1, (1500, 64))
    base[:, :3] *= [300, 50, 10]
    # The routine itself knows the weak components less well here.
    check(spark, [(i, [float(x) for x in v]) for i, v in enumerate(base)], tolerance=1e-6)


def test_fewer_components_than_wanted(spark):
    check(spark, sample(40, 5, 4))
    flat = [(i, [float(i % 3), float(i % 2), 0.0, 1.0]) for i in range(30)]
    check(spark, flat)  # rank 2


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]):
        vectors = spark.createDataFrame([(i, v, "c", 1, "w") for i, v in rows], SCHEMA)
        assert whitening.whiten(vectors).collect() == []


def test_data_are_read_by_passes_and_certified(spark):
    rows = sample(2000, 96, 5)
    vectors = spark.createDataFrame([(i, v, "c", 1, "w") for i, v in rows], SCHEMA)
    data = whitening.fit_list(whitening.finite(vectors))
    pairs = whitening.leading(data)
    assert pairs.residual <= whitening.ROUNDING and pairs.passes < 80
    assert np.abs(pairs.vectors.T @ pairs.vectors - np.eye(16)).max() < 1e-13


def test_too_large_numbers_fail_clearly(spark):
    vectors = spark.createDataFrame([(1, [1e30], "c", 1, "w"), (2, [0.0], "c", 1, "w")], SCHEMA)
    with pytest.raises(Exception, match="too large to be exact"):
        whitening.whiten(vectors).collect()
