import re
import textwrap

import pytest

from sensorloom.llm import licences
from sensorloom.llm.common import table
from tests.llm.samples import frame, odd_rows, sentence

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(table(spark, DIR, "documents"), negatives=800)


def test_every_template_is_found_in_its_paragraph(spark, model):
    rows, want = odd_rows(), {}
    for i, (family, sentences) in enumerate(licences.TEMPLATES.items()):
        for k, text in enumerate(sentences):
            rows.append((1000 + 100 * i + k, f"{sentence(i, 30)}\n{text.upper() if k % 2 else text}\n{sentence(k, 20)}"))
            want[1000 + 100 * i + k] = family
    found = [r for r in licences.scan(frame(spark, rows), model).collect() if r.family != licences.UNKNOWN]
    assert {r.doc_id: r.family for r in found} == want
    assert all(r.paragraph == 1 and r.probability >= 0.5 and r.similarity >= licences.CONFIRM for r in found)


def test_other_texts_are_unknown(spark, model):
    texts = [*licences.OTHERS, "the license", "MIT", "apache license version", "Apache stable version of the MIT work"]
    found = licences.scan(frame(spark, list(enumerate(texts))), model).collect()
    assert found and all(r.family == licences.UNKNOWN for r in found)


def test_whole_table_against_plain_patterns(spark, model):
    documents = table(spark, DIR, "documents")
    found = {(r.doc_id, r.family) for r in licences.scan(documents, model).collect() if r.family != licences.UNKNOWN}
    want = set()
    for r in documents.collect():
        for phrase, family in (("Apache License, Version 2.0", "Apache-2.0"), ("the MIT License", "MIT"),
                               ("GNU General Public License, version 3", "GPL-3.0"), ("CC BY-NC 4.0", "CC-BY-NC-4.0")):
            if phrase in r.text:
                want.add((r.doc_id, family))
    assert found == want


def test_no_python_in_the_plan(spark, model):
    plan = licences.scan(table(spark, DIR, "documents"), model)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_empty_table(spark):
    empty = frame(spark, [])
    assert licences.scan(empty, licences.train(empty)).count() == 0


def test_a_notice_in_a_third_of_the_documents(spark):
    rows = [(i, f"{sentence(i, 30)}\nThis library is licensed under the GNU Lesser General Public License, version 3.\n" * (i % 3 == 0) + sentence(5000 + i, 30)) for i in range(900)]
    documents = frame(spark, rows)
    found = licences.scan(documents, licences.train(documents)).where("family = 'LGPL-3.0'").select("doc_id", "paragraph").collect()
    assert sorted(map(tuple, found)) == [(i, 1) for i in range(0, 900, 3)]


def test_wrapped_notices(spark, model):
    rows, want = odd_rows(), set()
    long = [(f, t) for f, sentences in licences.TEMPLATES.items() for t in sentences if len(t.split()) >= 18]
    for i, (family, text) in enumerate(long):
        for k, width in enumerate((30, 45, 70)):
            lines = textwrap.wrap(text, width)
            rows.append((1000 + 10 * i + k, "\n".join([sentence(i, 30), "", *(f" * {x}" for x in lines), "", sentence(k, 20)])))
            want.add((1000 + 10 * i + k, family))
    rows.append((2000, "Redistribution and use in source and binary forms, with or without\n"
                       "modification, are permitted provided that the following conditions are met:"))
    rows.append((2001, "    This program is free software: you can redistribute it and/or modify\n"
                       "    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation."))
    rows.append((2002, "Released under the\n\nMIT License."))
    found = [r for r in licences.scan(frame(spark, rows), model).collect() if r.family != licences.UNKNOWN]
    assert {(r.doc_id, r.family) for r in found} == want | {(2000, "BSD-3-Clause"), (2001, "GPL-3.0")}
    assert all(r.lines >= 1 and r.similarity >= licences.CONFIRM for r in found)


def test_a_notice_of_many_short_lines(spark, model):
    family, text = max(((f, t) for f, ts in licences.TEMPLATES.items() for t in ts), key=lambda x: len(x[1].split()))
    words = text.split()
    pieces = [" ".join(words[i:i + 2]) for i in range(0, len(words), 2)]
    rows = [(1, "\n".join(["before", "", *pieces, "", "after"])), (2, "\n\n".join(pieces)), (3, "\n".join(pieces[::-1]))]
    found = [r for r in licences.scan(frame(spark, rows), model).collect() if r.family != licences.UNKNOWN]
    assert [(r.doc_id, r.paragraph, r.family) for r in found] == [(1, 2, family)] and found[0].lines >= len(pieces) - 1


def plain_trigrams(text):
    tokens = re.findall(licences.WORD, text.lower())
    return {" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)}


def test_similarity_and_runs_as_by_hand(spark, model):
    """All rows of the result against plain loops over lines."""
    rows = [(i, t) for i, t, *_ in odd_rows() if i is not None and t] + [
        (3000, "x\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\ny"), (3001, "\n".join(licences.OTHERS)), (3002, "Licensed under the Apache License, Version 2.0")]
    rows = list(dict(rows).items())
    templates = {f: [plain_trigrams(t) for t in ts] for f, ts in licences.TEMPLATES.items()}
    known = set().union(*(t for ts in templates.values() for t in ts))
    want = {}
    for doc_id, text in rows:
        lines = text.split("\n")
        spans = [(i, 1) for i in range(len(lines)) if set(re.findall("[a-z0-9]+(?:[.][a-z0-9]+)*", lines[i].lower())) & set(model.words)]
        i = 0
        while i < len(lines):
            j = i
            while j + 1 < len(lines):
                a, b = (re.findall(licences.WORD, lines[k].lower()) for k in (j, j + 1))
                if not (a and b and plain_trigrams(" ".join(a[-2:] + b[:2])) & known):
                    break
                j += 1
            if j > i:
                spans.append((i, j - i + 1))
            i = j + 1
        for at, n in spans:
            found = plain_trigrams("\n".join(lines[at:at + n]))
            want[(doc_id, at, n)] = {f: max(len(t & found) / len(t) for t in ts) for f, ts in templates.items()}
    got = licences.scan(frame(spark, rows), model).collect()
    assert {(r.doc_id, r.paragraph, 1) for r in got if r.lines == 1} == {k for k in want if k[2] == 1}
    for r in got:
        shares = want[(r.doc_id, r.paragraph, r.lines)]
        assert r.similarity == pytest.approx(shares.get(r.predicted, 0.0))
        assert (r.family == r.predicted and r.family != licences.UNKNOWN) == (
            r.predicted != licences.UNKNOWN and r.probability >= 0.5 and r.similarity >= licences.CONFIRM)
    assert (3000, 1, 2) in {(r.doc_id, r.paragraph, r.lines) for r in got if r.family == "BSD-3-Clause"}
