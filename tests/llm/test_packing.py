import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from jobloom.llm import packing
from jobloom.llm.queries import word_tokenizer
from jobloom.llm.tokens import Encoder

ODD = [
    "", None, "it's 'tis don'T I'LL", "a1b22 $$$x### <|endoftext|> x<|startoftext|>y < | <|end", "naïve ÀÉÎ ×÷ ß µ ª º", "ΑΣ Σ σς İ ı",
    "日本語 テキスト mixed漢字abc", "é x　y ", "a\x00b\x1cc\x85d", "😀😀 a😀b", "x" * 5000, "ﬁ ǅ Ⅷ ²", "­​ zero", " \t\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_tokenizer())


@pytest.fixture(scope="module")
def encoder():
    with open(word_tokenizer()) as file:
        return Encoder(file.read())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer(tokenizer):
    with open(word_tokenizer()) as file:
        encoder = Encoder(file.read(), kept=3)  # forgets all the time
    for _ in range(2):
        ids, bounds = encoder.encode(pa.array(ODD))
        for i, text in enumerate(ODD):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(tokenizer, text), text


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(codec="utf-8"), max_size=30), st.text("aZ '9.#é\n", max_size=30)), max_size=6))
def test_encoder_on_any_text(tokenizer, encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids_of(tokenizer, t) for t in texts]


@given(sizes=st.lists(st.integers(1, 63), max_size=40))
def test_places_fill_sequences(sizes):
    placed = packing.place(np.array(sizes, np.int64), 64, 1.0, 0.01)
    filled, parts = collections.Counter(), collections.defaultdict(list)
    for at, item, start, size in placed:
        filled[at] += size
        parts[item].append((start, size))
    assert all(n <= 64 for n in filled.values()) and len(filled) <= -(-sum(sizes) // 64)
    for item, size in enumerate(sizes):
        ends = 0
        for start, n in sorted(parts[item]):
            assert start == ends
            ends += n
        assert ends == size


def check(rows, texts, tokenizer):
    """Pieces rebuild every document's ids, sequences are gapless and full but for one a task."""
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        docs[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    want, got = collections.Counter(), collections.Counter()
    for doc, text in texts:
        ids = [*ids_of(tokenizer, text), 1]
        want.update((doc, i, token, len(ids)) for i, token in enumerate(ids))
    for doc, parts in docs.items():
        got.update((doc, start + i, token, n) for start, ids, n in parts for i, token in enumerate(ids))
    assert got == want
    return sum(packing.CAPACITY - sum(n for _, n in parts) for parts in sequences.values())


def test_round_trip_of_a_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, word_tokenizer(), keep_ids=True).collect()
    assert check(rows, [(d.doc_id, d.text) for d in docs.collect()], tokenizer) < packing.CAPACITY


def test_odd_rows(odd_docs, odd_rows, no_docs, tokenizer):
    rows = packing.pack(odd_docs, word_tokenizer(), keep_ids=True, window=2).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows], tokenizer)
    assert packing.pack(no_docs, word_tokenizer()).collect() == []
