import math
from collections import Counter

import pytest

from sensorloom.llm import kneser_ney
from sensorloom.llm.common import table
from tests.llm.samples import frame, odd_rows, sentence

ORDER = 3


class Plain:
    """The model by its definition, in dictionaries."""

    def __init__(self, texts: list[bytes]) -> None:
        self.counts = {ORDER: Counter()}
        for text in texts:
            self.counts[ORDER].update(self.grams(text))
        for level in range(ORDER - 1, 0, -1):
            self.counts[level] = Counter(g[1:] for g in self.counts[level + 1])
        self.discounts = {n: kneser_ney.discounts([sum(v == i for v in c.values()) for i in (1, 2, 3, 4)])
                          for n, c in self.counts.items()}

    @staticmethod
    def grams(text: bytes) -> list[bytes]:
        padded = b"\xff" * (ORDER - 1) + text + b"\xfe"
        return [padded[i:i + ORDER] for i in range(len(padded) - ORDER + 1)]

    def p(self, gram: bytes) -> float:
        if not gram:
            return 1 / kneser_ney.SYMBOLS
        counts, discounts = self.counts[len(gram)], self.discounts[len(gram)]
        after = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        if not after:
            return self.p(gram[1:])
        cut = sum(discounts[min(n, 3) - 1] for n in after)
        n = counts.get(gram, 0)
        return (max(n - discounts[min(n, 3) - 1], 0) if n else 0) / sum(after) + cut / sum(after) * self.p(gram[1:])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def case(spark):
    rows = [(i, sentence(i, 12)) for i in range(24)] + [(100 + i, f"###{i}!!{'xyz' * i}") for i in range(4)]
    rows += [(5000 + i, text) for i, text, *_ in odd_rows()[3:8]]
    marks = [(i, 1, 0) for i in range(24)] + [(0, None, 0), (1, 1, 1), (2, 0, 0), (100, 0, 0), (None, 1, 0), (999, 1, 0)]
    documents = frame(spark, rows)
    found = kneser_ney.classify(documents, labels(spark, marks), order=ORDER).collect()
    split = documents.select("doc_id", kneser_ney._is_held_out().alias("held")).distinct().collect()
    held = {r.doc_id for r in split if r.held}
    return rows, found, held


def test_scores_as_by_definition(case):
    rows, found, held = case
    trusted = set(range(3, 24))
    plain = Plain([t.encode() for i, t, *_ in rows if i in trusted - held])
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    assert len(found) == len(rows)
    for r in found:
        bits = -sum(math.log2(plain.p(g)) for g in plain.grams(texts[r.doc_id]))
        assert abs(r.score - 1000 * bits / max(1, len(texts[r.doc_id]))) <= 1.001
        assert r.n_bytes == len(texts[r.doc_id])


def test_probabilities_add_up_to_one(case):
    rows, _, held = case
    plain = Plain([t.encode() for i, t, *_ in rows[:24]])
    for context in (b"al", b"ph", b"zz", b"\xff\xff"):
        following = [bytes([b]) for b in range(256) if b not in (0xFF,)] + [b""]
        total = sum(plain.p(context + f) for f in following if f)
        assert abs(total + plain.p(context + b"\xff") - 1) < 0.02


def test_thresholds_are_quantiles_of_held_out_trusted_texts(case):
    _, found, held = case
    scores = sorted(r.score for r in found if r.doc_id in held & set(range(3, 24)))
    want = scores[math.ceil(kneser_ney.QUANTILE * len(scores)) - 1]
    for r in found:
        assert r.threshold == want and r.keep == (r.score <= want)
    assert not any(r.keep for r in found if r.doc_id in range(100, 104))


def test_no_trusted_text_and_empty_tables(spark):
    found = kneser_ney.classify(frame(spark, odd_rows()), labels(spark, [])).collect()
    assert len(found) == len(odd_rows()) and all(r.keep and r.threshold is None for r in found)
    assert kneser_ney.classify(frame(spark, []), labels(spark, [(1, 1, 0)])).count() == 0


def test_low_quality_goes_and_trusted_texts_stay(spark):
    marks = table(spark, "/root/testdata/sf0.01", "labels")
    found = kneser_ney.classify(table(spark, "/root/testdata/sf0.01", "documents"), marks)
    rows = found.join(marks, "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.keep for r in good) >= 0.97 * len(good)
    assert sum(not r.keep for r in bad) >= 0.85 * len(bad)
