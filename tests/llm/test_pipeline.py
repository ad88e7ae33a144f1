"""The pipeline's stages against plain versions, each on its own input."""

import collections

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from jobloom.llm import packing, quality_rules
from jobloom.llm.queries import ORACLES, QUERIES, word_tokenizer
from tests.compare import connect, difference
from tests.llm.brute import cut, groups, targets, words

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input, and what each stage but the last made of it."""
    docs, base = spark.read.parquet(f"{FOLDER}/documents.parquet"), tmp_path_factory.mktemp("stages")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, out[-1], FOLDER).write.parquet(str(base / name))
        out.append(spark.read.parquet(str(base / name)))
        assert out[-1].columns == COLUMNS
    return [df.collect() for df in out], out


def test_quality(steps):
    before, after = steps[0][0], steps[0][1]
    kept = {r["doc_id"] for r in quality_rules.judge(steps[1][0]).where("kept").collect()}
    assert sorted(r.doc_id for r in after) == sorted(kept) and {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_one_of_each_group_stays(steps):
    before, after = steps[0][1], steps[0][2]
    label, _ = groups([r.text for r in before])
    first = {}
    for place, r in enumerate(before):
        first[label[place]] = min(first.get(label[place], r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())


def test_repeated_passages_go(steps):
    before, after = steps[0][2], steps[0][3]
    texts = {}
    for r, (w, gone) in zip(before, cut([r.text for r in before], 35), strict=True):
        texts[r.doc_id] = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode() if any(gone) else r.text
    assert {r.doc_id: r.text for r in after} == texts
    assert all(r.n_chars == len(r.text) for r in after)


def test_sources_meet_their_targets(steps):
    before, after = steps[0][3], steps[0][4]
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in before:
        n = len(words(r.text))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in after:
        taken[r.source] += len(words(r.text))
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_packed(spark, steps):
    rows = packing.pack(steps[1][-1], word_tokenizer()).collect()
    tokenizer = Tokenizer.from_file(word_tokenizer())
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[0][-1])
    assert sum(r["length"] for r in rows) == total
    assert sum(r["length"] for r in corpus_pipeline.run(spark, FOLDER).collect()) == total


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, docs, FOLDER)
            assert frame.columns == docs.columns
            frame.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, FOLDER).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    problem = difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    assert problem is None, problem
