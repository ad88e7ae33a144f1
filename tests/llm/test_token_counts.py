import collections

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from jobloom.llm import token_counts
from jobloom.llm.textkit import Words
from tests.llm.brute import greedy, words


@settings(max_examples=150, deadline=None)
@given(
    pieces=st.sets(st.text("abc", min_size=1, max_size=6).map(str.encode), max_size=12),
    text=st.lists(st.text("abcd", min_size=1, max_size=90), max_size=8),
    mark=st.sampled_from([b"", b"_", b"a"]),
)
def test_automaton_counts_like_greedy_matching(pieces, text, mark):
    automaton = token_counts.LongestMatch(pieces, mark)
    found = Words(pa.array([" ".join(text)]))
    counts = automaton.counts(found, np.arange(len(found)))
    assert counts.tolist() == [greedy(mark + w.encode(), pieces, 6) for w in text]


def pieces():
    import public_tokenizers

    return token_counts.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def expected(rows, vocabulary):
    memory, longest = {}, max(map(len, vocabulary))
    out = collections.Counter()
    for doc, text in rows:
        n = 0
        for word in words(text):
            if word not in memory:
                memory[word] = greedy(token_counts.WORD_START + word, vocabulary, longest)
            n += memory[word]
        out[doc, len(words(text)), n] += 1
    return out


def test_whole_table_and_odd_rows(spark, odd_docs, odd_rows, no_docs):
    vocabulary = pieces()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(docs, vocabulary).collect())
    assert got == expected([(d.doc_id, d.text) for d in docs.collect()], set(vocabulary))
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(odd_docs, vocabulary).collect())
    assert got == expected([(r[0], r[1]) for r in odd_rows], set(vocabulary))
    assert token_counts.count_tokens(no_docs, vocabulary).collect() == []
