import itertools
import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from sensorloom.llm import packing
from tests.llm.samples import frame, odd_rows, sentence

PATH = public_tokenizers.path("byte_bpe_50k.json")


def padding(histogram: dict, bounds) -> int:
    return sum(n * (min(b for b in bounds if b >= size) - size) for size, n in histogram.items())


def test_boundaries_need_the_least_padding():
    pick = random.Random(2)
    for _ in range(40):
        histogram = {pick.randrange(1, 60): pick.randrange(1, 30) for _ in range(pick.randrange(1, 9))}
        for buckets in (1, 2, 3, 12):
            found = packing.boundaries(histogram, buckets)
            assert len(found) <= buckets and found[-1] == max(histogram)
            inner = sorted(histogram)[:-1]
            best = min(padding(histogram, [*cut, max(histogram)])
                       for k in range(min(buckets, len(histogram))) for cut in itertools.combinations(inner, k))
            assert padding(histogram, found) == best
    assert packing.boundaries({}) == []


def test_pack_holds_every_sequence_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_BATCHES", 2)
    rows = odd_rows() + [(3000 + i, sentence(i, 5 + i % 40)) for i in range(300)]
    documents = frame(spark, rows)
    found = packing.pack(documents, PATH, length=64, buckets=4, batch_tokens=256).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in rows:
        n, piece = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1, 0
        while n > 0:
            want[doc_id, piece, min(n, 64)] += 1
            n, piece = n - 64, piece + 1
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in found) == want
    bounds = packing.boundaries(Counter(r.n_tokens for r in found), 4)
    batches = {}
    for r in found:
        assert r.bucket == min(b for b in bounds if b >= r.n_tokens)
        batches.setdefault((r.bucket, r.shard, r.batch), []).append(r.slot)
    for (bucket, shard, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        last = (bucket, shard, batch + 1) not in batches
        assert len(slots) == 256 // bucket or last and len(slots) < 256 // bucket


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
