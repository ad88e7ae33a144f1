import collections
import math
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import katz
from tests.llm.brute import words


class Brute:
    def __init__(self, docs, order, cutoff=katz.CUTOFF):
        """docs: (text, whether to learn from it)."""
        self.order, self.counts = order, [collections.Counter() for _ in range(order + 1)]
        self.after = collections.defaultdict(set)
        for text, train in docs:
            if train:
                tokens = self.tokens(text)
                self.counts[0][()] += 1
                for i in range(order - 1, len(tokens)):
                    for level in range(1, order + 1):
                        gram = tokens[i - level + 1 : i + 1]
                        self.counts[level][gram] += 1
                        self.after[gram[:-1]].add(gram[-1])
        self.levels, seen = [None], None
        for level in range(1, order + 1):
            times = collections.Counter(self.counts[level].values())
            seen = [times[r] for r in range(1, cutoff + 2)]
            self.levels.append(katz.Level.of(sum(self.counts[level].values()), len(self.counts[level]), seen, cutoff, katz.REST))
            if level == 1:
                self.unknown = katz.unknown_mass(self.levels[1], seen)
        self.weight = cache(self._weight)

    def tokens(self, text):
        return (None,) * (self.order - 1) + tuple(w.lower() for w in words(text)) + ("end",)

    def worth(self, gram):
        return float(self.levels[len(gram)].worth(np.array([self.counts[len(gram)][gram]]))[0])

    def context(self, c):
        if not c:
            return self.levels[1].total
        if c == (None,) * len(c):
            return self.counts[0][()]
        return self.counts[len(c)][c]

    def _weight(self, c):
        seen = self.after[c]
        return (1 - sum(self.worth((*c, w)) for w in seen) / self.context(c)) / (1 - sum(self.chance(c[1:], w) for w in seen))

    def chance(self, c, w):
        if self.counts[len(c) + 1][(*c, w)]:
            return self.worth((*c, w)) / self.context(c)
        if not c:
            return self.unknown
        return (self.weight(c) if self.context(c) else 1.0) * self.chance(c[1:], w)

    def row(self, text):
        tokens, n = self.tokens(text), self.order - 1
        one, level = self.counts[1], self.levels[1]
        plain = tokens[n:]
        return (
            len(plain), sum(1 for w in plain if one[(w,)]), level.total,
            sum(math.log10((one[(w,)] + 1) / (level.total + level.kinds + 1)) for w in plain),
            sum(math.log10(self.chance(tokens[i - n : i], tokens[i])) for i in range(n, len(tokens))),
        )


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def trained():
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


NAMES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def check(rows, docs, model):
    want = collections.defaultdict(list)
    for doc, text in docs:
        want[doc].append(model.row(text))
    assert len(rows) == len(docs)
    for r in rows:
        got = tuple(r[n] for n in NAMES)
        near = [w for w in want[r["row"]["doc_id"]] if w[:3] == got[:3] and w[3:] == pytest.approx(got[3:], rel=1e-9)]
        assert near, (r, want[r["row"]["doc_id"]])
        assert r["train"] != held(r["row"]["doc_id"])


@pytest.mark.parametrize("order", [1, 2, 3])
def test_whole_table(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(d.doc_id, d.text) for d in docs.collect()]
    model = Brute([(t, not held(d)) for d, t in pairs], order)
    rows = katz.score(docs, trained(), order=order).collect()
    check(rows, pairs, model)
    unseen = [r for r in rows if not r["train"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    texts = ["a b c a b d a b c end", "b c a a a c", "d", "", "a b a b a b c d"] * 2 + ["c d a"]
    model = Brute([(t, True) for t in texts], order)
    known = [g[0] for g in model.counts[1]]
    contexts = {c for c in model.after if len(c) == order - 1} | {("nowhere",) * (order - 1), ("nowhere", "a")[-(order - 1) :]}
    for c in contexts:
        assert sum(model.chance(c, w) for w in known) + model.chance(c, "unknown word") == pytest.approx(1)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, tmp_path):
    pairs = [(r[0], r[1]) for r in odd_rows]
    model = Brute([(t, not held(d)) for d, t in pairs], 2)
    rows = katz.score(odd_docs, trained(), carry=tuple(odd_docs.columns), folder=str(tmp_path / "model"), all_contexts=True).collect()
    check(rows, pairs, model)
    assert spark.read.parquet(str(tmp_path / "model/ngrams")).where("part = 'counts'").count() > 0
    assert katz.score(no_docs, trained()).collect() == []
    nothing = katz.score(odd_docs, F.lit(False)).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in nothing)
