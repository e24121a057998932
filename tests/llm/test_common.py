import numpy as np
import pyarrow as pa

from sensorloom.llm import common
from tests.llm.samples import rows_of


def test_word_hashes_do_not_depend_on_the_segment():
    pick = np.random.default_rng(1)
    data = pick.integers(97, 123, 3_000_000).astype(np.uint8)
    data[pick.random(len(data)) < 0.15] = 32
    data[1_000_000:2_200_000] = 98  # a word longer than a segment
    starts, ends = common.runs(data != 32, np.array([0, len(data)]))
    hashes = common.word_hashes(data, starts, ends)
    longest = int(np.argmax(ends - starts))
    assert ends[longest] - starts[longest] > common.SEGMENT_BYTES
    for i in (0, 7, 1000, longest, len(starts) - 1):
        word = data[starts[i]:ends[i]]
        assert common.word_hashes(word, np.array([0]), np.array([len(word)]))[0] == hashes[i]
    words = {data[a:b].tobytes() for a, b in zip(starts[:50_000], ends[:50_000])}
    assert len(set(hashes[:50_000].tolist())) == len(words)


def test_slices_are_bounded_by_bytes():
    texts = ["x" * 700_000, None, "é" * 300_000, "", "z" * 3_000_000, "q"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(common.slices([batch, batch.slice(0, 0), batch.slice(3, 1)]))
    assert [p.num_rows for p in parts] == [2, 2, 1, 1, 1]
    assert [t for p in parts[:4] for t in p.column("text").to_pylist()] == texts


def test_text_bytes_of_a_slice_and_of_nulls():
    column = pa.array(["ab", None, "é", "", "xyz"])
    data, offsets = common.text_bytes(column.slice(1, 3))
    assert data.tobytes().decode() == "é" and offsets.tolist() == [0, 0, 2, 2]
    data, offsets = common.text_bytes(pa.array([None, None], pa.string()))
    assert len(data) == 0 and offsets.tolist() == [0, 0, 0]


def test_bit_filter_never_misses(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 12345678901234, None]
    bits = common.bit_filter(spark.createDataFrame([(k,) for k in keys], "key bigint"), "key")
    held = common.may_hold(bits, np.array(keys[:-1], np.int64).view(np.uint64))
    assert held.all()
    others = np.random.default_rng(2).integers(0, 2**63, 10_000, dtype=np.uint64)
    assert common.may_hold(bits, others).mean() < 0.001
    assert not common.may_hold(common.bit_filter(spark.createDataFrame([], "key bigint"), "key"), others).any()


def test_free_name_and_staged(spark):
    frame = spark.createDataFrame([(1, "a")], "Tie int, tie_ string")
    assert common.free_name(frame, "tie") == "tie__"
    assert rows_of(common.staged(frame, "t")) == [(1, "a")]
