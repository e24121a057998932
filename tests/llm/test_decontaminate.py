import random
import time

import numpy as np
import pyarrow as pa

from sensorloom.llm import decontaminate
from tests.llm.samples import frame, odd_rows, sentence


def naive_tiles(document: list, item: list, shortest: int) -> list[int]:
    """Greedy string tiling as it is defined, one comparison at a time; lengths of the tiles."""
    used_d, used_i, found = set(), set(), []
    while True:
        best, matches = shortest, []
        for d in range(len(document)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(document) and i + n < len(item) and document[d + n] == item[i + n]
                       and d + n not in used_d and i + n not in used_i):
                    n += 1
                if n > best:
                    best, matches = n, [(d, i)]
                elif n == best:
                    matches.append((d, i))
        added = False
        for d, i in matches:
            if not any(d + k in used_d or i + k in used_i for k in range(best)):
                used_d.update(range(d, d + best))
                used_i.update(range(i, i + best))
                found.append(best)
                added = True
        if not added:
            return found


def test_tiles_as_defined():
    pick = random.Random(4)
    for _ in range(60):
        document = [pick.randrange(4) for _ in range(pick.randrange(60))]
        item = [pick.randrange(4) for _ in range(pick.randrange(1, 25))]
        found = decontaminate.tiles(np.array(document, np.uint64), np.array(item, np.uint64), 3)
        assert [t[2] for t in found] == naive_tiles(document, item, 3)
        for d, i, n in found:
            assert document[d:d + n] == item[i:i + n]


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "q", 0) for r in rows], "item_id bigint, text string, words string, seed int")


ITEM = sentence(77, 40)


def leak_rows() -> tuple[list, list]:
    words = ITEM.split()
    reordered = " ".join([*words[30:], "filler", *words[20:30], *words[10:20], "x", *words[:10]])
    noisy = " ".join(w.upper() + "###" for w in words)
    documents = odd_rows() + [
        (1001, "before " + ITEM + " after"), (1002, reordered + " " + sentence(5, 100)), (1003, noisy),
        (1004, " ".join(words[:12])), (1005, " ".join(words[::-1])), (1006, sentence(6, 300)), (1007, ITEM), (1007, ITEM)]
    items = [(1, ITEM), (2, None), (3, ""), (4, "too few words"), (None, sentence(88, 20)), (1, ITEM), (5, sentence(89, 30))]
    return documents, items


def test_leaks_catch_reordered_passages_and_leave_the_rest(spark):
    documents, items = leak_rows()
    found = decontaminate.leaks(frame(spark, documents), benchmark(spark, items))
    assert found.columns == ["doc_id", "item_id", "n_tiles", "coverage"]
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, 1) for i in (1001, 1002, 1003, 1007, 1007)]


def test_leaks_as_brute_force(spark):
    pick, documents, items = random.Random(9), [], []
    for i in range(30):
        items.append((i, sentence(300 + i, pick.randrange(5, 40))))
    for d in range(60):
        text = sentence(600 + d, pick.randrange(40)).split()
        for i in pick.sample(range(30), 2):
            words = items[i][1].split()
            a = pick.randrange(len(words))
            text[len(text) // 2:len(text) // 2] = words[a:a + pick.randrange(5, 40)]
        documents.append((d, " ".join(text)))
    want = []
    hashed = {t: decontaminate._words(pa.array([t]))[0] for _, t in documents + items}
    for d, text in documents:
        for i, item in items:
            own = hashed[item]
            if len(own) >= 5:
                tiles = naive_tiles(hashed[text].tolist(), own.tolist(), 5)
                if sum(tiles) / len(own) >= 0.5:
                    want.append((d, i, len(tiles), round(sum(tiles) / len(own), 9)))
    found = decontaminate.leaks(frame(spark, documents), benchmark(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id, r.n_tiles, round(r.coverage, 9)) for r in found) == sorted(want)


def test_without_leaks(spark):
    documents, items = leak_rows()
    kept = decontaminate.without_leaks(frame(spark, documents), benchmark(spark, items))
    assert kept.columns == frame(spark, documents).columns
    assert kept.count() == len(documents) - 5
    assert decontaminate.without_leaks(frame(spark, documents), benchmark(spark, [])).count() == len(documents)
    assert decontaminate.leaks(frame(spark, []), benchmark(spark, items)).count() == 0


def test_tiles_of_repetitive_texts_take_no_time():
    item = np.array([7] * 200, np.uint64)
    start = time.perf_counter()
    assert decontaminate.tiles(np.array([7] * 20_000, np.uint64), item) == [(0, 0, 200)]
    two = np.array([1, 2] * 50_000 + [3] + [1, 2] * 60, np.uint64)
    found = decontaminate.tiles(two, np.array([1, 2] * 100 + [9] + [2, 1] * 30, np.uint64))
    assert sum(t[2] for t in found) == 260
    assert time.perf_counter() - start < 3


def test_short_items_and_scripts_without_spaces(spark):
    documents = [(1, "say Forty Two, please"), (2, "two forty"), (3, "前に新しい言語モデルの評価問題です後"), (4, "新しい問題"),
                 (5, "กขคงจฉชซ ฌญ"), (6, "forty"), (7, "42 forty two 43"), (8, None)]
    items = [(1, "forty two"), (2, "新しい言語モデルの評価問題です"), (3, "ขคงจฉชซ"), (4, "言語 前"), (5, None), (6, "... !"), (7, "FORTY")]
    found = decontaminate.leaks(frame(spark, documents), benchmark(spark, items))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (7, 1), (3, 2), (5, 3), (1, 7), (2, 7), (6, 7), (7, 7)}
