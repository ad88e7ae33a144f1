"""Substring deduplication with fixed-block anchors (operator 1).

A run of `window` words that occurs at two places holds, at each of them, one whole
block of (window + 1) // 2 words that starts at a multiple of that length in its text.
So only those non-overlapping blocks are indexed, and every rolling window of a block's length is
a probe. A probe that meets an indexed block at another place is an anchor. Around the
anchors the hits are extended: every full window that holds an anchor is looked up
again among all such windows, and neighbouring windows found again join to maximal
exact repeats. Their words are removed at all places.

Blocks and windows are compared by 64-bit hashes, first of the block, then of the window.

Defined cases: null and empty texts have no words; texts shorter than the window are
never touched; a repeated row repeats all its windows; runs never cross texts; an empty table
gives no rows; carried columns lie in a struct, so their names clash with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm import units as u
from jobloom.llm.textkit import Words, slices, windows

WINDOW = 35


def _unit(key) -> int:
    return key[0].as_py()


def _probe(block: int, buckets: int):
    """A unit's rolling windows of a block's length; flags: 1 it is indexed, 2 it occurs twice here."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        probes, indexed = [], []
        for part in slices(rows):
            words = Words(part["text"])
            first, hashes = windows(words.hashes(), words.bounds, block)
            start = np.repeat(words.bounds[:-1], np.maximum(words.counts() - block + 1, 0))
            probes.append(hashes)
            indexed.append(hashes[(first - start) % block == 0])
        found, times = np.unique(np.concatenate(probes), return_counts=True)
        flags = u.among(found, np.unique(np.concatenate(indexed))) + 2 * (times > 1)
        return u.sent(_unit(key), {f: found[flags == f] for f in range(4)}, buckets)

    return run


def _meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Anchors of a bucket: indexed somewhere, and at two places at least."""
    hashes, units, flags, first = u.gathered(rows)
    size = np.diff(np.append(first, len(hashes)))
    any_flags = np.bitwise_or.reduceat(flags, first)
    hit = np.repeat(((any_flags & 1) > 0) & ((size > 1) | ((any_flags & 2) > 0)), size)
    return u.answers(units[hit], hashes[hit])


def _anchored(words: Words, anchors: np.ndarray, block: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the full windows that hold an anchor."""
    hashes = words.hashes()
    first, blocks = windows(hashes, words.bounds, block)
    seen = np.zeros(len(words) + 1, np.int64)
    seen[first[u.among(blocks, anchors)] + 1] = 1
    if not seen.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    np.cumsum(seen, out=seen)
    first, whole = windows(hashes, words.bounds, window)
    chosen = seen[first + window - block + 1] > seen[first]
    return first[chosen], whole[chosen]


def _extend(block: int, window: int, buckets: int):
    """A unit's full windows around anchors; flag 2: it occurs twice here."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, replies: pa.Table) -> pa.Table:
        anchors, found = u.told(replies), [np.zeros(0, np.uint64)]
        if len(rows) and len(anchors):
            found += [_anchored(Words(part["text"]), anchors, block, window)[1] for part in slices(rows)]
        hashes, times = np.unique(np.concatenate(found), return_counts=True)
        return u.sent(_unit(key), {0: hashes[times == 1], 2: hashes[times > 1]}, buckets)

    return run


def _repeat(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    hashes, units, flags, first = u.gathered(rows)
    size = np.diff(np.append(first, len(hashes)))
    hit = np.repeat((size > 1) | ((np.bitwise_or.reduceat(flags, first) & 2) > 0), size)
    return u.answers(units[hit], hashes[hit])


def _cut(window: int):
    """Kept text and removed spans of each document of a unit."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, replies: pa.Table) -> pa.Table:
        repeats, out = u.told(replies), []
        for part in slices(rows):
            words = Words(part["text"])
            change = np.zeros(len(words) + 1, np.int64)
            if len(repeats):
                first, whole = windows(words.hashes(), words.bounds, window)
                hit = first[u.among(whole, repeats)]
                np.add.at(change, hit, 1)
                np.add.at(change, hit + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            begins, ends = edge[::2], edge[1::2]
            # A span that runs over the border of two texts is one span in each.
            inner = words.bounds[1:-1]
            inner = np.unique(inner[(inner > 0) & (inner < len(words))])
            inner = inner[gone[inner - 1] & gone[inner]] if len(inner) else inner
            begins, ends = np.sort(np.append(begins, inner)), np.sort(np.append(ends, inner))
            removed = np.diff(np.append(0, np.cumsum(gone))[words.bounds])
            kept, spans = [], []
            for i, (low, high) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                chosen = np.arange(low, high)
                kept.append(words.joined(chosen[~gone[low:high]] if removed[i] else chosen).decode())
                here = slice(*np.searchsorted(begins, [low, high]))
                spans.append([{"start": int(b - low), "end": int(e - low)} for b, e in zip(begins[here], ends[here], strict=True)] if removed[i] else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            out.append(pa.table({
                "row": part["row"], "text": part["text"], "n_words": words.counts(), "n_removed": removed, "kept": kept,
                "spans": pa.array(spans, kind),
            }))
        return pa.concat_tables(out) if out else _NOTHING

    return run


_NOTHING = pa.table({"row": []})


def cut_repeats(
    docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = (),
    unit_bytes: int = u.UNIT_BYTES,
) -> DataFrame:
    """row (the id and the carried columns), text, n_words, n_removed, kept, spans [start, end) of removed words.

    `unit_bytes` of text make a unit: larger units send fewer repeats and fewer, longer
    rows, and take more memory.
    """
    block = (window + 1) // 2
    n = u.number_of_units(docs, text, unit_bytes)
    dealt = u.dealt(docs, n, text, key, carry)
    shape = dealt.schema["row"].dataType.simpleString()
    anchors = dealt.groupBy("unit").applyInArrow(_probe(block, n), u.SENT).groupBy("bucket").applyInArrow(_meet, u.ANSWERS)
    around = dealt.groupBy("unit").cogroup(anchors.groupBy("unit")).applyInArrow(_extend(block, window, n), u.SENT)
    repeats = around.groupBy("bucket").applyInArrow(_repeat, u.ANSWERS)
    return dealt.groupBy("unit").cogroup(repeats.groupBy("unit")).applyInArrow(
        _cut(window),
        f"row {shape}, text string, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>",
    )
