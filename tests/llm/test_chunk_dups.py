import random

import numpy as np

from sensorloom.llm import chunk_dups
from tests.llm.samples import frame, odd_rows, sentence


def data(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randrange(2, 9))) for _ in range(n))


def test_cuts_resist_insertions():
    text = prose(1, 2000)
    ends = set((len(text) - chunk_dups.cuts(data(text))).tolist())
    moved = set((len(text) + 7 - chunk_dups.cuts(data("shifted" + text))).tolist())
    assert len(ends & moved) > 0.95 * len(ends)
    sizes = np.diff(np.concatenate([[0], chunk_dups.cuts(data(text))]))
    assert sizes.sum() == len(text) and sizes.max() <= chunk_dups.LARGEST and sizes[:-1].min() >= chunk_dups.SMALLEST


def test_gear_is_the_rolling_hash_of_a_window():
    text = data(prose(2, 40))
    for i in (0, 5, 15, 16, 100):
        want = 0
        for b in text[max(0, i - chunk_dups.WINDOW + 1):i + 1]:
            want = ((want << 1) + int(chunk_dups._GEAR[b])) % 2**64
        assert int(chunk_dups.gear(text)[i]) == want


def test_passages_as_brute_force(spark):
    passages = [prose(10 + i, 60) for i in range(4)]
    rows = odd_rows()
    for d in range(40):
        text = prose(100 + d, 80)
        if d % 3 == 0:
            text = text[:200] + " " + passages[d % 4] + " " + text[200:]
        rows.append((1000 + d, text))
    chunks = {}
    for doc_id, text, *_ in rows:
        start = 0
        for at, end in enumerate(chunk_dups.cuts(data(text or "")).tolist()):
            chunks.setdefault((doc_id, text), []).append(((text or "").encode()[start:end], start, end))
            start = end
        chunks[doc_id, text] = chunks.get((doc_id, text), [])[:at + 1] if start else []
    holders = {}
    for key, own in chunks.items():
        for c in own:
            holders.setdefault(c[0], set()).add(key)
    want = []
    for (doc_id, text), own in chunks.items():
        run = None
        for c, start, end in [*own, (None, 0, 0)]:
            if c is not None and len(holders[c]) > 1:
                run = (run[0] if run else start, end)
            elif run:
                if run[1] - run[0] >= chunk_dups.PASSAGE:
                    want.append((doc_id, *run))
                run = None
    found = chunk_dups.passages(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.start, r.end) for r in found), key=repr) == sorted(want, key=repr)
    planted = {1000 + d for d in range(40) if d % 3 == 0}
    assert {r.doc_id for r in found if (r.doc_id or 0) >= 1000} == planted
    assert {r.doc_id for r in found if r.original and r.doc_id and r.doc_id >= 1000} == {1000, 1003, 1006, 1009}


def test_nothing_repeated_and_empty_table(spark):
    assert chunk_dups.passages(frame(spark, [(i, sentence(i, 3)) for i in range(5)])).count() == 0
    assert chunk_dups.passages(frame(spark, [])).count() == 0


def test_every_passage_of_51_words_is_found(spark):
    pick, rows = random.Random(3), []
    for i in range(1500):
        longest = 1 if i % 3 == 0 else 3 if i % 3 == 1 else 9
        words = ["".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(1, longest))) for _ in range(51)]
        for k in range(2):
            around = prose(10_000 + 2 * i + k, 60).split(" ")
            at = pick.randrange(61)
            rows.append((2 * i + k, " ".join([*around[:at], *words, *around[at:]])))
    found = {r.doc_id for r in chunk_dups.passages(frame(spark, rows)).select("doc_id").collect()}
    assert found == set(range(3000))


def test_passages_of_other_scripts(spark):
    pick, rows = random.Random(4), []
    for i in range(100):
        passage = "".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(51))
        for k in range(2):
            ahead, behind = ("".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(40)) for _ in range(2))
            rows.append((2 * i + k, ahead + passage + behind))
    assert {r.doc_id for r in chunk_dups.passages(frame(spark, rows)).collect()} == set(range(200))
    for _, text in rows[:20]:
        ends = [0, *chunk_dups.cuts(data(text)).tolist()]
        assert "".join(text.encode()[a:b].decode() for a, b in zip(ends, ends[1:])) == text


def test_each_repeated_chunk_survives_once(spark):
    quote, whole, other = prose(900, 70), prose(901, 120), prose(902, 90)
    copied = f"{whole} {quote} {other}"
    rows = [(3, f"{prose(903, 40)} {quote} {prose(904, 40)}"), (7, copied), (9, copied), (9, copied), (None, None),
            (11, f"é漢 {prose(905, 30)}\n{copied}"), (12, ""), (13, f"{prose(906, 40)} {other}")]
    chunks = lambda text: {text.encode()[a:b] for ends in [chunk_dups.cuts(data(text)).tolist()]
                           for a, b in zip([0, *ends], ends)}
    found = chunk_dups.passages(frame(spark, rows)).collect()
    first = {}
    for doc_id, text in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
        for c in chunks(text):
            first.setdefault(c, doc_id)
    for r in found:
        text = dict(rows)[r.doc_id].encode()
        at = [0, *chunk_dups.cuts(data(text.decode())).tolist()]
        for a, b in zip(at, at[1:]):
            if r.start <= a and b <= r.end:
                assert (first[text[a:b]] != r.doc_id) == any(x.start <= a and b <= x.end for x in r.repeats)
    assert all(r.original == (not r.repeats) for r in found)
    kept = chunk_dups.deduplicated(frame(spark, rows)).collect()
    texts = {r.doc_id: r.text for r in kept}
    assert len(kept) == 7 and texts[None] is None and texts[12] == "" and texts[3] == rows[0][1]
    assert texts[9] == "" and len(texts[7]) < len(whole) + len(other) + 80 and texts[11].startswith("é漢 ")
    for part in (quote, whole, other):
        middle = part[60:-60]
        assert sum((t or "").count(middle) for t in texts.values()) == 1
