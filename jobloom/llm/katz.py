"""Katz backoff language model over the corpus, and the score of every text under it (operator 2).

Tokens are a text's words in lower case (A-Z) and one end. The count of an n-gram seen r times is
discounted: up to `cutoff` by Good-Turing from the (log-linearly smoothed) counts of counts,
above it by the constant `rest`, so every context leaves some mass. That mass goes, in proportion to the
next shorter context's probabilities, to the words not seen after the context; the backoff weight makes the
sum over all words exactly 1. The shortest level leaves its mass to one class of unknown words.

    P(w | c) = discounted(count(c w)) / count(c)   if the training texts hold c w
             = weight(c) P(w | c without its first word)   if they hold c but not c w
             = P(w | c without its first word)   else

Three steps, each stored as a table partitioned by part, with rows per bucket of n-gram hashes:
counts (`counts`: n-gram hashes and counts per level and bucket); discounted mass per context
(`backoff`); scores. A unit of documents sends each n-gram once per step, with its count, so a frequent
one is no hot key; buckets answer every unit what it needs for its own texts.

N-grams are compared by 64-bit hashes. Backoff weights are stored for the contexts that the scored texts
need; `all_contexts` stores all.

Defined cases: null and empty texts are the end alone; without training texts every token is unknown with
probability 1; repeated rows are learnt and scored each; an empty table gives no rows; a null id is scored and
learnt as `trained` says; carried columns lie in a struct, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm import units as u
from jobloom.llm.textkit import Words, mix, mixed, slices
from jobloom.sources.storage import shared_folder

ORDER, CUTOFF, REST = 2, 5, 0.05
UNIT_BYTES = 8 << 20  # of text: a task holds a unit's n-grams of all lengths
_END = np.uint64(mixed(1))
_STEP = np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Level:
    """Totals of one n-gram length and its discounts."""

    total: int  # occurrences
    kinds: int  # different n-grams
    discounted: tuple[float, ...]  # what counts 0..cutoff are worth
    rest: float

    @classmethod
    def of(cls, total: int, kinds: int, seen: list[int], cutoff: int, rest: float) -> Level:
        """`seen[r - 1]`: n-grams seen r times, up to cutoff + 1."""
        worth = [0.0]
        if min(seen) > 0:  # a straight line through their logarithms evens out the counts of counts
            r = np.log(np.arange(1, cutoff + 2))
            slope = np.polyfit(r, np.log(seen), 1)[0]
            even = np.exp(slope * r)
        else:
            even = np.ones(cutoff + 1)
        tail = (cutoff + 1) * even[cutoff] / even[0]
        for r in range(1, cutoff + 1):
            ratio = ((r + 1) * even[r] / (r * even[r - 1]) - tail) / (1 - tail) if tail < 1 else 0.0
            # Counts of counts that do not fall as Good-Turing expects: half a count goes.
            worth.append(float(r * ratio) if 0 < ratio < 1 else r - 0.5)
        return cls(total, kinds, tuple(worth), rest)

    def worth(self, counts: np.ndarray) -> np.ndarray:
        small = np.minimum(counts, len(self.discounted) - 1).astype(np.int64)
        return np.where(counts < len(self.discounted), np.array(self.discounted)[small], counts - self.rest)


def unknown_mass(level: Level, seen: list[int]) -> float:
    """What the words of the training texts leave to unknown ones."""
    if not level.total:
        return 1.0
    gone = sum(n * (r - level.discounted[r]) for r, n in enumerate(seen[: len(level.discounted) - 1], 1))
    return (gone + level.rest * (level.kinds - sum(seen[: len(level.discounted) - 1]))) / level.total


class _Tokens:
    """Tokens of a unit's texts: per level the n-gram that ends at each token, and its context."""

    def __init__(self, rows: pa.Table, order: int):
        tokens, sizes, train = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for part in slices(rows):
            words = Words(part["text"])
            counts = words.counts()
            out = np.full(len(words) + len(counts), _END, np.uint64)
            out[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words.hashes(lower=True)
            tokens.append(out)
            sizes.append(counts + 1)
            train.append(np.array(part["train"]))
        self.sizes = np.concatenate(sizes)
        self.train_docs = np.concatenate(train).astype(bool)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(self.train_docs, self.sizes)
        self.last = np.zeros(int(self.sizes.sum()), bool)
        self.last[self.start + self.sizes - 1] = True
        self.first = np.zeros(len(self.last), bool)
        self.first[self.start] = True
        self.grams, self.contexts = [np.concatenate(tokens)], [None]
        for level in range(2, order + 1):
            context = np.empty_like(self.grams[-1])
            context[1:] = self.grams[-1][:-1]
            context[self.start] = np.uint64(mixed(100 + level))
            self.contexts.append(context)
            self.grams.append(mix(context * _STEP + self.grams[0]))


def _rows(level: int, unit: int, hashes: np.ndarray, values: list[np.ndarray], buckets: int, flags: int = 0) -> Iterator[dict]:
    edges = u.by_bucket(hashes, buckets)
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[bucket], edges[bucket + 1]
        yield {
            "bucket": bucket, "unit": unit, "level": level, "flags": flags, "hashes": u.packed(hashes[a:b]),
            "values": b"".join(u.packed(v[a:b]) for v in values),
        }


_SENT = pa.schema([(n, pa.int32()) for n in ("bucket", "unit", "level", "flags")] + [("hashes", pa.binary()), ("values", pa.binary())])
_STORED = pa.schema(
    [("part", pa.string())] + [(n, pa.int32()) for n in ("unit", "level", "bucket")]
    + [("hashes", pa.binary()), ("values", pa.binary()), ("seen", pa.list_(pa.int64()))]
)
SENT = "bucket int, unit int, level int, flags int, hashes binary, values binary"
STORED = "part string, unit int, level int, bucket int, hashes binary, values binary, seen array<long>"


def _count(order: int, buckets: int):
    """A unit's n-grams with their counts in training texts, and whether a text to score has them as a context."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        unit, tokens, out = key[0].as_py(), _Tokens(rows, order), []
        docs = np.array([2 * tokens.train_docs.sum()], np.uint64)
        out += _rows(0, unit, np.zeros(1, np.uint64), [docs], buckets)
        asking = ~tokens.train & ~tokens.last
        for level, grams in enumerate(tokens.grams, 1):
            found, which = np.unique(grams, return_inverse=True)
            counts = np.bincount(which, tokens.train, len(found)).astype(np.uint64)
            asked = np.bincount(which, asking, len(found)) > 0
            out += _rows(level, unit, found, [2 * counts + asked], buckets)
        return pa.Table.from_pylist(out, _SENT)

    return run


def _totals(cutoff: int):
    """A bucket's totals: stored as the table of counts, and told to every unit in the order it asked."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bucket, out = key[0].as_py(), []
        for level in np.unique(rows["level"].to_numpy()).tolist():
            own = rows.filter(pc.equal(rows["level"], level)).to_pylist()
            hashes = np.concatenate([u.unpacked(r["hashes"]) for r in own])
            values = np.concatenate([u.unpacked(r["values"]) for r in own])
            order = np.argsort(hashes, kind="stable")
            hashes, counts, asked = hashes[order], values[order] >> np.uint64(1), values[order] & np.uint64(1)
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            size = np.diff(np.append(first, len(hashes)))
            total = np.add.reduceat(counts, first)
            group = np.repeat(np.arange(len(first)), size)
            owner = np.zeros(len(hashes), np.uint64)
            learnt = np.flatnonzero(counts)
            owner[learnt[np.unique(group[learnt], return_index=True)[1]]] = 1
            told = np.empty(len(hashes), np.uint64)
            told[order] = total[group] * np.uint64(4) + owner * np.uint64(2) + np.bitwise_or.reduceat(asked, first)[group]
            at = 0
            for r in own:
                n = len(r["hashes"]) // 8
                out.append({"part": "answers", "unit": r["unit"], "level": level, "bucket": bucket, "values": u.packed(told[at : at + n])})
                at += n
            known = total > 0
            seen = np.bincount(np.minimum(total[known], cutoff + 2).astype(np.int64), minlength=cutoff + 3)[1 : cutoff + 2]
            out.append({"part": "sums", "unit": -1, "level": level, "bucket": bucket, "seen": [int(total.sum()), int(known.sum()), *seen.tolist()]})
            if level:
                out.append({"part": "counts", "unit": -1, "level": level, "bucket": bucket, "hashes": u.packed(hashes[first][known]), "values": u.packed(total[known])})
        return pa.Table.from_pylist(out, _STORED)

    return run


class _Told:
    """What a unit was told: per level its n-grams with total, ownership and whether any unit asks for the context."""

    def __init__(self, tokens: _Tokens, replies: list[dict]):
        self.found, self.at, self.which, self.total, self.owned, self.asked = [], [], [], [], [], []
        for level, grams in enumerate(tokens.grams, 1):
            found, at, which = np.unique(grams, return_index=True, return_inverse=True)
            own = sorted((r for r in replies if r["level"] == level and r["part"] == "answers"), key=lambda r: r["bucket"])
            told = np.concatenate([u.unpacked(r["values"]) for r in own]) if own else np.zeros(0, np.uint64)
            if len(told) != len(found):
                raise RuntimeError("the documents changed between two steps of the model")
            for held, value in zip(
                (self.found, self.at, self.which, self.total, self.owned, self.asked),
                (found, at, which, (told >> np.uint64(2)).astype(np.int64), told >> np.uint64(1) & np.uint64(1) > 0, told & np.uint64(1) > 0),
                strict=True,
            ):
                held.append(value)

    def totals(self, level: int) -> np.ndarray:
        """Training count of the n-gram that ends at each token."""
        return self.total[level - 1][self.which[level - 1]]

    def context_totals(self, tokens: _Tokens, level: int, levels: list[Level]) -> np.ndarray:
        """Training count of each token's context; all training tokens for the empty one."""
        if level == 1:
            return np.full(len(tokens.first), levels[1].total)
        shorter = self.totals(level - 1)
        out = np.append(0, shorter)[:-1]
        out[tokens.first] = levels[0].total
        return out


def _spread(order: int, levels: list[Level], buckets: int, all_contexts: bool):
    """Per context the discounted counts after it and the shorter contexts' probabilities of the same words."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, replies: pa.Table) -> pa.Table:
        unit, tokens = key[0].as_py(), _Tokens(rows, order)
        told, out = _Told(tokens, replies.to_pylist()), []
        for level in range(2, order + 1):
            context, above = tokens.contexts[level - 1], told.context_totals(tokens, level, levels)
            wanted = np.append(False, told.asked[level - 2][told.which[level - 2]])[:-1] | tokens.first | all_contexts
            at = told.at[level - 1]
            own = told.owned[level - 1] & wanted[at]
            at, total = at[own], told.total[level - 1][own]
            shorter = levels[level - 1].worth(told.totals(level - 1)[at]) / np.maximum(told.context_totals(tokens, level - 1, levels)[at], 1)
            names, which = np.unique(context[at], return_inverse=True)
            mass = np.bincount(which, levels[level].worth(total), len(names))
            lower = np.bincount(which, shorter, len(names))
            out += _rows(level, unit, names, [mass, lower], buckets)
            unseen = ~tokens.train & (told.totals(level) == 0) & (above > 0)
            out += _rows(level, unit, np.unique(context[unseen]), [], buckets, flags=1)
        return pa.Table.from_pylist(out, _SENT)

    return run


def _weigh(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A bucket's contexts: their masses, stored, and told to the units that ask."""
    bucket, out, all_rows = key[0].as_py(), [], rows.to_pylist()
    for level in sorted({r["level"] for r in all_rows}):
        given = [r for r in all_rows if r["level"] == level and not r["flags"]]
        if not given:
            continue
        halves = [u.unpacked(r["values"][: len(r["values"]) // 2], np.float64) for r in given], [u.unpacked(r["values"][len(r["values"]) // 2 :], np.float64) for r in given]
        names, which = np.unique(np.concatenate([u.unpacked(r["hashes"]) for r in given]), return_inverse=True)
        mass, lower = (np.bincount(which, np.concatenate(half), len(names)) for half in halves)
        out.append({"part": "backoff", "unit": -1, "level": level, "bucket": bucket, "hashes": u.packed(names), "values": u.packed(mass) + u.packed(lower)})
        for r in all_rows:
            if r["level"] == level and r["flags"]:
                asked = u.unpacked(r["hashes"])
                asked = asked[u.among(asked, names)]
                at = np.searchsorted(names, asked)
                out.append({
                    "part": "weights", "unit": r["unit"], "level": level, "bucket": bucket, "hashes": u.packed(asked),
                    "values": u.packed(mass[at]) + u.packed(lower[at]),
                })
    return pa.Table.from_pylist(out, _STORED)


def _score(order: int, levels: list[Level], unknown: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, replies: pa.Table) -> pa.Table:
        all_replies = replies.to_pylist()
        tokens = _Tokens(rows, order)
        told = _Told(tokens, all_replies)
        count, n = told.totals(1), levels[1].total
        base = np.log10((count + 1) / (n + levels[1].kinds + 1))
        value = np.where(count > 0, levels[1].worth(count) / max(n, 1), unknown)
        for level in range(2, order + 1):
            context, above, count = tokens.contexts[level - 1], told.context_totals(tokens, level, levels), told.totals(level)
            own = sorted((r for r in all_replies if r["level"] == level and r["part"] == "weights"), key=lambda r: r["bucket"])
            names = np.concatenate([u.unpacked(r["hashes"]) for r in own]) if own else np.zeros(0, np.uint64)
            halves = [[u.unpacked(v, np.float64) for v in (r["values"][: len(r["values"]) // 2], r["values"][len(r["values"]) // 2 :])] for r in own]
            mass, lower = (np.concatenate([h[i] for h in halves]) if own else np.zeros(0) for i in (0, 1))
            unseen = (count == 0) & (above > 0)
            weight = np.ones(len(value))
            if unseen.any():
                at = np.searchsorted(names, context[unseen])
                if not u.among(context[unseen], names).all():
                    raise RuntimeError("a context without its backoff weight")
                weight[unseen] = (1 - mass[at] / above[unseen]) / (1 - lower[at])
            value = np.where(count > 0, levels[level].worth(count) / np.maximum(above, 1), weight * value)
        total = lambda x: np.add.reduceat(x, tokens.start) if len(tokens.start) else x[:0]
        return pa.table({
            "row": rows["row"], "train": rows["train"], "n_tokens": tokens.sizes, "n_known": total((told.totals(1) > 0).astype(np.int64)),
            "train_tokens": np.full(len(tokens.sizes), n), "base_score": total(base), "score": total(np.log10(value)),
        })

    return run


def score(
    docs: DataFrame, trained: Column, order: int = ORDER, cutoff: int = CUTOFF, rest: float = REST, text: str = "text",
    key: str = "doc_id", carry: tuple[str, ...] = (), all_contexts: bool = False, folder: str | None = None,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """row (the id and the carried columns), train, n_tokens, n_known, train_tokens, base_score, score.

    The model stays in `folder` (a new one below the shared folder if none is named). `unit_bytes` of
    text make a unit: larger units send fewer repeats of an n-gram and take more memory.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "katz")
    n = u.number_of_units(docs, text, unit_bytes)
    dealt = u.dealt(docs, n, text, key, carry, {"train": F.coalesce(trained, F.lit(False))})
    shape = dealt.schema["row"].dataType.simpleString()

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.partitionBy("part").parquet(f"{folder}/{name}")
        return spark.read.schema(STORED).parquet(f"{folder}/{name}")

    with u.tidy(spark):
        counted = stored(
            dealt.groupBy("unit").applyInArrow(_count(order, n), SENT).groupBy("bucket").applyInArrow(_totals(cutoff), STORED), "ngrams"
        )
        sums = counted.where("part = 'sums'").groupBy("level").agg(*[F.sum(F.get("seen", F.lit(i))) for i in range(cutoff + 3)]).collect()
        sums = {row["level"]: [int(x) for x in row[1:]] for row in sums}
        none = [0] * (cutoff + 3)
        levels = [Level.of(a, b, seen, cutoff, rest) for a, b, *seen in (sums.get(level, none) for level in range(order + 1))]
        unknown = unknown_mass(levels[1], sums.get(1, none)[2:])
        answers = counted.where("part = 'answers'").select("part", "unit", "level", "bucket", "hashes", "values")
        weights = stored(
            dealt.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_spread(order, levels, n, all_contexts), SENT)
            .groupBy("bucket").applyInArrow(_weigh, STORED),
            "contexts",
        )
    replies = answers.unionByName(weights.where("part = 'weights'").select("part", "unit", "level", "bucket", "hashes", "values"))
    return dealt.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(
        _score(order, levels, unknown),
        f"row {shape}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
