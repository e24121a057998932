import public_tokenizers
import pytest

import corpus_pipeline
from sensorloom.llm import decontaminate, near_dups, secret_scan
from sensorloom.llm.common import table
from tests.llm.samples import frame, odd_rows, sentence
from tests.llm.test_near_dups import brute_force
from tests.llm.test_secret_scan import brute_force as spans

DIR = "/root/testdata/sf0.001"


def test_stages_return_the_columns_of_documents(spark):
    for rows in ([], odd_rows() + [(1000 + i, sentence(i, 30)) for i in range(20)]):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, DIR)
            assert found.columns == docs.columns, name
            assert found.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DIR).count() >= len(rows)


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = table(spark, DIR, "documents").cache(), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR).cache()
        found.append(docs.collect())
    return found


def test_each_stage_does_its_work(spark, stages):
    raw = table(spark, DIR, "documents").collect()
    identified, unique, clean, masked, packed = stages
    assert {r.doc_id for r in identified} == {r.doc_id for r in raw if any(c.isalpha() for c in r.text)}
    kept = [r[0] for r in brute_force([(r.doc_id, r.text) for r in identified], 80) if r[3]]
    assert sorted(r.doc_id for r in unique) == sorted(kept)
    assert {r.doc_id for r in clean} <= {r.doc_id for r in unique} and len(clean) >= 0.9 * len(unique)
    assert [r.doc_id for r in sorted(masked)] == [r.doc_id for r in sorted(clean)]
    after = {r.doc_id: r.text for r in masked}
    assert all((secret_scan.PLACEHOLDER in after[r.doc_id]) == bool(spans(r.text)[1]) for r in clean)
    assert {r.doc_id for r in packed} == {r.doc_id for r in masked}


def test_run_gives_the_rows_of_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect())) == sorted(map(tuple, stages[-1]))


def test_constants_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    assert near_dups.SHINGLE == decontaminate.SEED == 5
    assert public_tokenizers.path("byte_bpe_50k.json")
