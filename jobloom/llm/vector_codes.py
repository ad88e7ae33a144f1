"""Compression of vectors to codes: four codebooks, nearest entries found in a GNAT (operator 11).

A vector's components become whole numbers; the vector is cut into equal parts, and each
part is coded by the number of its nearest codebook entry. Rounds of assigning all parts and
replacing each entry by the floored mean of its parts improve the codebooks.

The nearest entry is found in a geometric near-neighbour access tree over the entries: every
node holds split points and, for each split point and each child, the range of distances
between them. A part's distances to the split points rule out whole children: those whose
range lies wholly beyond the best distance found. Distances are roots of exact whole numbers,
rounded against the exclusion; a child goes only if it is strictly farther, so entries that
tie are always met, and whole numbers decide between them (the lowest index wins).

A round is one pass without a shuffle of vectors: tasks send sums and counts per entry. The
codebooks, bounded by entries and vector length, are all that the driver holds.

Defined cases: vectors that are null or hold a null or a non-finite component are dropped;
repeated rows and ids count each; ids that tie for the first entries are ordered by vector, null
ids come last; null labels are one label; fewer rows than entries make a smaller codebook;
a length that the parts do not divide gives the first parts one component more; vectors
of each length have codebooks of their own, empty vectors have none and are dropped; an empty table
gives no rows; further columns are ignored. Components have any size; a result that does not fit a long is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.exact import EXACT, by_length, finite_vectors, floored, json_row, partial_sums, stored, totals

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SPLITS = 8
LEAF = 64
_BLOCK = 32  # entries whose sums travel in one row
_CHUNK = 16_384
_SLACK = 1e-12


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows: both are whole doubles with room to spare, or Python's numbers."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64).astype(a.dtype)
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a.dot(b.T)


_ISQRT = np.frompyfunc(math.isqrt, 1, 1)


def _below(squares: np.ndarray) -> np.ndarray:
    """Roots, none above the true one."""
    return _ISQRT(squares) if squares.dtype == object else np.sqrt(squares) * (1 - _SLACK)


def _above(squares: np.ndarray) -> np.ndarray:
    return _ISQRT(squares) + 1 if squares.dtype == object else np.sqrt(squares) * (1 + _SLACK)


class Gnat:
    """A tree over rows of a matrix; `places` are their indexes, ascending."""

    def __init__(self, entries: np.ndarray, places: np.ndarray | None = None, splits: int = SPLITS, leaf: int = LEAF):
        places = np.arange(len(entries)) if places is None else places
        self.places, self.entries, self.children = places, entries[places], []
        if len(places) <= max(leaf, splits):
            return
        # Split points far from each other: each is the entry farthest from those chosen so far.
        chosen, near = [0], _squared(self.entries, self.entries[:1])[:, 0]
        while len(chosen) < splits and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, _squared(self.entries, self.entries[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return  # all entries are equal
        chosen.sort()
        distances = _squared(self.entries, self.entries[chosen])
        home = distances.argmin(1)
        home[chosen] = -1
        self.splits, self.split_places = self.entries[chosen], places[chosen]
        self.low = np.zeros((len(chosen), len(chosen)), distances.dtype)
        self.high = self.low.copy()
        for child in range(len(chosen)):
            own = np.flatnonzero(home == child)
            self.children.append(Gnat(entries, places[own], splits, leaf) if len(own) else None)
            if len(own):
                self.low[:, child], self.high[:, child] = distances[own].min(0), distances[own].max(0)
        self.low, self.high = _below(self.low), _above(self.high)

    def nearest(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, the lowest of those that tie; squared distance) of each row."""
        if not len(asked):
            return np.zeros(0, np.int64), np.zeros(0, asked.dtype)
        index = np.zeros(len(asked), np.int64)
        best = _squared(asked, self.entries[:1])[:, 0]
        index[:] = self.places[0]
        self._visit(asked, np.arange(len(asked)), index, best)
        return index, best

    @staticmethod
    def _better(rows: np.ndarray, squares: np.ndarray, places: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        first = squares.argmin(1)  # places ascend, so the first of equal ones is the lowest
        found, at = squares[np.arange(len(rows)), first], places[first]
        wins = (found < best[rows]) | ((found == best[rows]) & (at < index[rows]))
        best[rows[wins]], index[rows[wins]] = found[wins], at[wins]

    def _visit(self, asked: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        if not self.children:
            self._better(rows, _squared(asked[rows], self.entries), self.places, index, best)
            return
        squares = _squared(asked[rows], self.splits)
        self._better(rows, squares, self.split_places, index, best)
        below, above, order = _below(squares), _above(squares), squares.argsort(1, kind="stable")
        for turn in range(order.shape[1]):  # the child of the nearest split point first
            for number in np.unique(order[:, turn]).tolist():
                child = self.children[number]
                if child is None:
                    continue
                own = np.flatnonzero(order[:, turn] == number)
                reach = _above(best[rows[own]])[:, None]
                out = (below[own] > reach + self.high[:, number]) | (above[own] + reach < self.low[:, number])
                left = own[~out.any(1).astype(bool)]
                if len(left):
                    child._visit(asked, rows[left], index, best)


def _cuts(length: int, parts: int) -> list[int]:
    size, more = divmod(length, parts)
    return np.cumsum([0] + [size + (i < more) for i in range(parts)]).tolist()


class _Coder:
    """Codebooks of all parts (lists of whole numbers), with a tree for each kind of arithmetic."""

    def __init__(self, books: list[list[list[int]]], length: int):
        self.books, self.cuts = books, _cuts(length, len(books))
        self.largest = max((abs(x) for book in books for entry in book for x in entry), default=0)
        self._trees: dict[bool, list[Gnat]] = {}

    def _kind(self, vectors: np.ndarray) -> np.ndarray:
        """The vectors as doubles where all squared distances are exact."""
        if vectors.dtype == object:
            return vectors
        reach = max(float(np.abs(vectors).max(initial=0)), float(min(self.largest, 1 << 60)))
        return vectors if 4 * reach * reach * max(vectors.shape[1], 1) < EXACT else _whole(vectors)

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part: its rows, the nearest entries and the squared distances."""
        vectors = self._kind(vectors)
        exact = vectors.dtype == object
        if exact not in self._trees:
            shape = lambda book: np.array(book, object if exact else np.float64).reshape(len(book), -1)
            self._trees[exact] = [Gnat(shape(book)) for book in self.books]
        for number, tree in enumerate(self._trees[exact]):
            part = np.ascontiguousarray(vectors[:, self.cuts[number] : self.cuts[number + 1]])
            yield part, *tree.nearest(part)


def _whole(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.frompyfunc(int, 1, 1)(x).astype(object).reshape(x.shape)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), _CHUNK):
        yield batch.slice(at, _CHUNK)


def _sums_of(coder: _Coder, length: int, scale: int):
    """Counts and sums of the parts assigned to each entry, a JSON row per block of entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
        sums = [np.zeros((len(book), 1 + coder.cuts[i + 1] - coder.cuts[i]), object) for i, book in enumerate(coder.books)]
        for batch in batches:
            for chunk in _chunks(batch):
                for number, (part, index, _) in enumerate(coder.assign(floored(chunk["v"], length, scale))):
                    order = np.argsort(index, kind="stable")
                    found, first = np.unique(index[order], return_index=True)
                    counted = np.diff(np.append(first, len(order)))
                    sums[number][found, 0] += counted.astype(object)
                    if part.shape[1]:
                        sums[number][found, 1:] += _whole(np.add.reduceat(part[order], first, axis=0))
        for number, own in enumerate(sums):
            for block in range(0, len(own), _BLOCK):
                yield json_row(number << 16 | block, own[block : block + _BLOCK].ravel().tolist())

    return run


def _improved(coder: _Coder, sums: dict[int, list[int]]) -> list[list[list[int]]]:
    books = []
    for number, book in enumerate(coder.books):
        wide, fresh = 1 + coder.cuts[number + 1] - coder.cuts[number], []
        for place, entry in enumerate(book):
            own = sums.get(number << 16 | place - place % _BLOCK, [])
            own = own[place % _BLOCK * wide : (place % _BLOCK + 1) * wide]
            fresh.append([total // own[0] for total in own[1:]] if own and own[0] else entry)
        books.append(fresh)
    return books


def learn(rows: DataFrame, length: int, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """The codebooks of (vec_id, v) rows of one length: by part, entry and component."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    whole = floored(pa.array([row["v"] for row in first], pa.list_(pa.float64())), length, scale)
    cuts = _cuts(length, parts)
    books = [[[int(x) for x in entry[a:b]] for entry in whole] for a, b in zip(cuts, cuts[1:], strict=False)]
    keys = parts * -(-entries // _BLOCK)
    for _ in range(rounds):
        coder = _Coder(books, length)
        books = _improved(coder, totals(partial_sums(rows.select("v"), _sums_of(coder, length, scale)), keys))
    return books


def _encode(coder: _Coder, length: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                codes = np.zeros((len(chunk), len(coder.books)), np.uint8)
                error = np.zeros(len(chunk), object)
                for number, (_, index, squares) in enumerate(coder.assign(floored(chunk["v"], length, scale))):
                    codes[:, number] = index
                    error = error + _whole(squares)
                text = codes.tobytes().hex()
                wide = 2 * codes.shape[1]
                code = [text[at : at + wide] for at in range(0, len(text), wide)]
                yield pa.RecordBatch.from_arrays(
                    [chunk["vec_id"], chunk["label"], pa.array(code, pa.string()), pa.array([int(e) for e in error], pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", scale: int = SCALE,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that takes part.

    `scale` is a power of two, `entries` at most 256.
    """
    if entries > 256 or scale < 1 or scale & (scale - 1):
        raise ValueError("a code has one byte per part, and the scale is a power of two")
    given = stored(finite_vectors(vectors, vector, vec_id=key, label=label), "vectors")
    kinds = {field.name: field.dataType.simpleString() for field in given.schema}
    shape = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    coded = given.sparkSession.createDataFrame([], f"{shape}, codebooks_sha256 string")
    for length, rows in by_length(given).items():
        books = learn(rows, length, scale, parts, entries, rounds)
        own = rows.mapInArrow(_encode(_Coder(books, length), length, scale), shape)
        coded = coded.unionByName(own.withColumn("codebooks_sha256", F.lit(digest(books))))
    coded = stored(coded, "codes")
    # One row per label and task travels; the sums meet the codes without a hint, as labels may be many.
    by_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels").withColumnRenamed("label", "_label")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256"
    )
