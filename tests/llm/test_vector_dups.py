import math

import numpy as np
import pytest

from sensorloom.llm import vector_dups
from tests.llm.samples import rows_of

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, cell int, links string"


def brute_force(rows: list[tuple]) -> list[tuple]:
    """Every pair of rows; a component is the smallest id reachable."""
    able = [i for i, (vec_id, v, label) in enumerate(rows)
            if vec_id is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dims = max((len(rows[i][1]) for i in able), default=1)
    units = np.zeros((len(rows), dims))
    for i in able:
        v = np.float32(rows[i][1]).astype(float)
        units[i, :len(v)] = v / np.linalg.norm(v)
    labels = np.array([-1 if r[2] is None else r[2] for r in rows])
    ok = np.zeros(len(rows), bool)
    ok[able] = True
    linked = (units @ units.T >= 0.93) & (labels[:, None] == labels[None, :]) & ok[:, None] & ok[None, :]
    np.fill_diagonal(linked, False)
    least = [r[0] for r in rows]
    moved = True
    while moved:
        moved = False
        for a, b in zip(*np.nonzero(linked), strict=True):
            if least[b] < least[a]:
                least[a], moved = least[b], True
    return sorted(((r[0], int(linked[i].sum()), least[i], r[0] is None or least[i] == r[0]) for i, r in enumerate(rows)), key=repr)


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, "n", 1, "l") for r in rows], SCHEMA)


def check(spark, rows: list[tuple]) -> int:
    want = brute_force(rows)
    assert rows_of(vector_dups.groups(frame(spark, rows))) == want
    return sum(r[1] for r in want) // 2


def near(pick, base: np.ndarray, cosine: float) -> np.ndarray:
    """A vector at the given cosine to ``base``."""
    base = base / np.linalg.norm(base)
    side = pick.normal(0, 1, len(base))
    side -= (side @ base) * base
    return cosine * base + math.sqrt(1 - cosine * cosine) * side / np.linalg.norm(side)


def sample(seed: int, n: int, dims: int) -> list[tuple]:
    pick = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = pick.normal(0, 1, dims)
        rows.append((i * 3, v.tolist(), i % 4 if i % 5 else 0))
        if i % 4 == 0:
            rows.append((i * 3 + 1, near(pick, v, pick.choice([0.92, 0.931, 0.94, 0.97, 0.999])).tolist(), rows[-1][2]))
    return rows


def test_as_all_pairs(spark):
    rows = sample(1, 400, 24)
    rows += [(9001, rows[3][1], rows[3][2]), (9001, rows[3][1], rows[3][2]), (9002, rows[3][1], 17), (9003, [2 * x for x in rows[3][1]], rows[3][2]),
             (9004, None, 1), (9005, [0.0] * 24, 1), (9006, [float("nan")] * 24, 1), (9007, [None] * 24, 1), (9008, [], 1),
             (9009, rows[3][1], None), (None, rows[3][1], rows[3][2]), (9010, [1.0, 0.0], 1), (9011, [5.0], 1), (-1, rows[8][1], rows[8][2])]
    assert check(spark, rows) > 60


@pytest.mark.parametrize("dims", [3, 16, 64])
def test_cells_and_blocks(spark, monkeypatch, dims):
    monkeypatch.setattr(vector_dups, "CELL_ROWS", 60)
    monkeypatch.setattr(vector_dups, "BLOCK_ROWS", 25)
    monkeypatch.setattr(vector_dups, "CHUNK_ROWS", 7)
    assert check(spark, sample(dims, 700, dims)) > 50


def test_large_group_of_near_copies_is_not_compared(spark, monkeypatch):
    monkeypatch.setattr(vector_dups, "CELL_ROWS", 300)
    pick = np.random.default_rng(8)
    base = pick.normal(0, 1, 32)
    rows = sample(9, 300, 32) + [(10_000 + i, near(pick, base, 0.995).tolist(), 2) for i in range(700)]
    rows += [(20_000 + i, near(pick, base, 0.95).tolist(), 2) for i in range(40)]
    rows += [(30_000 + i, rows[-1][1], 2) for i in range(200)]
    compared, whole = [], vector_dups._dealt

    def watched(*given):
        compared.append(whole(*given))
        return compared[-1]

    monkeypatch.setattr(vector_dups, "_dealt", watched)
    assert check(spark, rows) > 200_000
    assert compared[0].select("digest").distinct().count() < 700  # without the core


def test_exact_margin_in_few_dimensions():
    chord = math.sqrt(2 - 2 * 0.93)
    assert vector_dups._margin(3, 0.93) == vector_dups._margin(16, 0.93) == pytest.approx(chord / 2)


def test_recall_in_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(vector_dups, "CELL_ROWS", 100)
    pick = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        v = pick.normal(0, 1, 96)
        rows += [(2 * i, v.tolist(), 0), (2 * i + 1, near(pick, v, 0.9301).tolist(), 0)]
    found = {r.vec_id: r.n_links for r in vector_dups.groups(frame(spark, rows)).collect()}
    want = {r[0]: r[1] for r in brute_force(rows)}
    assert sum(found.values()) >= 0.995 * sum(want.values())


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(1, None, 1), (2, [0.0], 1)])
