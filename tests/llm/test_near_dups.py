import random
import re

import numpy as np
import pyarrow as pa

from sensorloom.llm import near_dups
from sensorloom.llm.graph import components
from tests.llm.samples import frame, odd_rows, rows_of, sentence


def shingles(text: str | None) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_force(rows: list[tuple], percent: int) -> list[tuple]:
    sets = [(r[0], shingles(r[1])) for r in rows]
    ids = {i for i, s in sets if i is not None and s}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    able = [(i, s) for i, s in sets if i in parent and s]
    for x, (i, a) in enumerate(able):
        for j, b in able[:x]:
            if 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    found = []
    for i, s in sets:
        component = root(i) if i is not None and s else i
        found.append((i, len(s), component, i is None or i == component))
    return sorted(found, key=repr)


def edited(text: str, seed: int, changes: int) -> str:
    pick, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
    return " ".join(words)


def test_groups_as_brute_force(spark):
    rows = odd_rows()
    for base in range(6):
        text = sentence(500 + base, 80 + 40 * base)
        rows += [(1000 + 100 * base + k, edited(text, base * 50 + k, k % 5)) for k in range(14)]
    for percent in (80, 85):
        assert rows_of(near_dups.groups(frame(spark, rows), percent)) == brute_force(rows, percent)


def test_groups_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 400)
    text = sentence(7, 120)
    rows = [(k, edited(text, k, k % 4)) for k in range(60)]
    assert rows_of(near_dups.groups(frame(spark, rows), 85)) == brute_force(rows, 85)


def test_empty_table(spark):
    assert rows_of(near_dups.groups(frame(spark, []))) == []
    assert near_dups.keep_first(frame(spark, [])).count() == 0


def test_keep_first_keeps_columns_and_one_of_each_group(spark):
    documents = frame(spark, odd_rows())
    kept = near_dups.keep_first(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-5, 1, 3, 4, 5, 6, 8, 10, 11, 12, 50]
    assert ids.count(None) == 2


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    t, u, v = (sentence(i, 40) for i in (900, 901, 902))
    near_u = u + " end"
    rows = [(1, t), (5, t), (5, u), (5, v), (9, near_u), (9, v), (7, v + " more"), (5, u), (5, "A " + u), (5, None), (5, "")]
    kept = sorted((r.doc_id, r.text) for r in near_dups.keep_first(frame(spark, rows)).where("text <> ''").collect())
    assert (1, t) in kept and (5, v) in kept and len(kept) == 3
    assert sum(text in (u, "A " + u) for _, text in kept) == 1
    got = {(r.doc_id, r.component_id) for r in near_dups.groups(frame(spark, rows)).collect()}
    assert got == {(1, 1), (5, 1), (5, 5), (9, 5), (7, 5)}


def test_sketch_estimates_similarity_and_fills_every_bin():
    pick = np.random.default_rng(1)
    for size in (1, 2, 7, 300):
        a = pick.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[: size * 9 // 10], pick.integers(0, 2**63, size - size * 9 // 10, dtype=np.uint64)])
        sketch = near_dups.sketches([np.unique(a), np.unique(b)])
        assert (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sketch[0] == sketch[1]).mean() - similarity) < 0.1


def test_sketch_of_a_set_does_not_depend_on_its_batch():
    sets = near_dups.shingle_sets(pa.array([sentence(i, 3 + 9 * i) for i in range(9)]))
    together = near_dups.sketches(sets)
    for alone, row in zip(sets, together, strict=True):
        assert (near_dups.sketches([alone])[0] == row).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (5, 4), (9, 8), (8, 7), (7, 6), (6, 5), (20, 30), (None, 4), (30, 20)]
    found = rows_of(components(spark.createDataFrame(edges, "a bigint, b bigint")))
    assert found == sorted([(1, 1), (2, 1), (3, 1), *((i, 4) for i in range(4, 10)), (20, 20), (30, 20)], key=repr)
