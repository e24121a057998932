import numpy as np
import pytest

from sensorloom.llm import top_k
from tests.llm.samples import rows_of


def brute_force(rows: list[tuple], k: int) -> list[tuple]:
    able, queries = [], {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            able.append((i, [int(np.floor(1024 * float(x))) for x in v]))
    for i, ints in able:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, ints), ints)
    found = []
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in able if i != q)
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(found, key=repr)


def test_search_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 150)
    monkeypatch.setattr(top_k, "LEAST_ROWS", 40)
    pick = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in np.float32(v)]) for i, v in enumerate(pick.normal(0, 0.2, (900, 12)))]
    rows += [(i, rows[i - 2000][1]) for i in range(2000, 2050)]  # ties
    rows += [(300, rows[300][1]), (None, [1.0] * 12), (5000, None), (5100, [float("nan")] * 12), (5200, [None, 1.0]),
             (5300, []), (5400, [0.5, -0.5]), (5500, [float("inf")] * 12), (5600, [0.0] * 12), (-100, [-1.0] * 12)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS score", "2 AS shard")
    assert rows_of(top_k.by_id(vectors)) == brute_force(rows, 10)


def test_fewer_others_than_k_and_empty_tables(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert rows_of(top_k.by_id(vectors)) == [(0, 1, 1, 1024 * 2048)]
    assert rows_of(top_k.by_id(vectors.where("false"))) == []


def test_large_numbers_and_repeated_ids(spark):
    rows = [(0, [float(2**25), 1.0]), (1, [4.0, -1.0]), (2, [3.0, 1.0]), (2, [9.0, 1.0]), (2, [9.0, 1.0]), (0, [float(2**26), 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert rows_of(top_k.by_id(vectors)) == brute_force(rows, 10) and len(brute_force(rows, 10)) == 4
    wide = [(100, [2.0**20] * 4), (1, [2.0**20] * 4), (2, [-(2.0**20), 2.0**20, 0.0, 1.0])]
    assert rows_of(top_k.by_id(spark.createDataFrame(wide, "vec_id bigint, embedding array<double>"))) == brute_force(wide, 10)
    for big in (2.0**21, 2.0**60):
        beyond = spark.createDataFrame([(100, [big] * 64), (1, [big] * 64)], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="does not fit a long|too large for a long"):
            top_k.by_id(beyond).collect()


def test_shard_leaves_most_rows_out():
    pick = np.random.default_rng(3)
    matrix = np.zeros((2000, 64), np.int64)
    for row in matrix:
        row[pick.choice(64, 6, replace=False)] = pick.integers(-900, 900, 6)
    shard = top_k._Shard(np.arange(2000), matrix)
    for q in range(0, 2000, 100):
        ids, scores = shard.search(q, matrix[q], 10)
        want = sorted((-(matrix[i] @ matrix[q]), i) for i in range(2000) if i != q)[:10]
        assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
    assert shard.scored < 0.1 * 20 * 2000
