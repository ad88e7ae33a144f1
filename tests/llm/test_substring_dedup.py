import collections
import random

import pytest

from jobloom.llm import substring_dedup
from tests.llm.brute import cut


def check(frame, docs, window):
    """docs: (id, text); kept text and spans against brute force."""
    want = collections.Counter()
    for (doc, _), (w, gone) in zip(docs, cut([t for _, t in docs], window), strict=True):
        spans, at = [], 0
        while at < len(w):
            end = at
            while end < len(w) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = end + 1 if end == at else end
        want[doc, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode(), tuple(spans)] += 1
    got = collections.Counter(
        (r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"], tuple((s["start"], s["end"]) for s in r["spans"])) for r in frame.collect()
    )
    assert got == want


@pytest.mark.parametrize(("window", "seed"), [(1, 1), (2, 2), (5, 3), (6, 4), (7, 5)])
def test_random_texts(spark, window, seed):
    draw = random.Random(seed)
    letters = "abcdefghijklmnop"[: 3 * window]
    docs = [(i, " ".join(draw.choices(letters, k=draw.randint(0, 40)))) for i in range(60)]
    docs += [(60 + i, " ".join([docs[i][1], docs[2 * i][1], docs[i][1]])) for i in range(10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(substring_dedup.cut_repeats(frame, window=window), docs, window)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(substring_dedup.cut_repeats(docs), [(d.doc_id, d.text) for d in docs.collect()], 35)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(substring_dedup.cut_repeats(odd_docs, carry=tuple(odd_docs.columns)), [(r[0], r[1]) for r in odd_rows], 35)
    assert substring_dedup.cut_repeats(no_docs).collect() == []
