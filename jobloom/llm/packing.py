"""Cost-balanced packing of token sequences (operator 7).

A task walks its documents once. It gathers the ids of as many documents as make
`window` sequences, then packs them: parts of `capacity` ids fill a sequence each,
and what is left of the documents is placed, costliest first, into the sequence with
the lowest cost among those with room, where a part of n ids costs
linear * n + quadratic * n**2. Parts that fit nowhere are cut over the room that is
left. A window so leaves less than one sequence of padding. Nothing is shuffled,
and no task holds more than one window and one batch of texts.

Defined cases: a null or empty text has the end id alone; a text of any length is
cut into full sequences; repeated rows and repeated or null ids are packed as rows of
their own; an empty table gives no rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.textkit import slices

CAPACITY = 2048
WINDOW = 256
END_ID = 1
SLICE_BYTES = 4 << 20


def place(sizes: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(sequence, item, first id of the item, ids) for items of at most `capacity` ids, in order of placing."""
    count = -(-int(sizes.sum()) // capacity)
    room, cost = np.full(count, capacity, np.int64), np.zeros(count)
    placed, left = [], []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        able = np.where(room >= size, cost, np.inf)
        at = int(able.argmin())
        if able[at] == np.inf:
            left.append(item)
            continue
        placed.append((at, item, 0, size))
        room[at] -= size
        cost[at] += linear * size + quadratic * size * size
    for item in left:
        done, size = 0, int(sizes[item])
        while done < size:
            at = int(np.where(room > 0, cost, np.inf).argmin())
            part = min(int(room[at]), size - done)
            placed.append((at, item, done, part))
            room[at] -= part
            cost[at] += linear * part + quadratic * part * part
            done += part
    return placed


class _Window:
    """Documents of one task that wait to be packed; `number` counts the sequences made."""

    def __init__(self, first: int, capacity: int, linear: float, quadratic: float, keep_ids: bool):
        self.number, self.capacity, self.costs, self.keep_ids = first, capacity, (linear, quadratic), keep_ids
        self.keys: list = []
        self.ids: list[np.ndarray] = []
        self.tokens = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.ids.append(ids)
        self.tokens += len(ids)

    def pack(self, schema: pa.Schema) -> pa.RecordBatch:
        capacity, rows = self.capacity, []
        sizes = np.array([len(ids) for ids in self.ids], np.int64)
        for doc, size in enumerate(sizes.tolist()):
            for start in range(0, size - capacity + 1, capacity):
                rows.append((doc, start, capacity, self.number, 0))
                self.number += 1
        rest = sizes % capacity
        docs = np.flatnonzero(rest)
        filled: dict[int, int] = {}
        for at, item, start, size in place(rest[docs], capacity, *self.costs):
            doc = int(docs[item])
            rows.append((doc, int(sizes[doc] - rest[doc]) + start, size, self.number + at, filled.get(at, 0)))
            filled[at] = filled.get(at, 0) + size
        self.number += len(filled)
        parts = [self.ids[doc][start : start + size] for doc, start, size, _, _ in rows]
        doc, start, size, sequence, offset = zip(*rows, strict=True) if rows else ((),) * 5
        columns = {
            "doc_id": pa.array([self.keys[d] for d in doc], schema.field("doc_id").type),
            "start": start, "length": size, "ids_crc32": [zlib.crc32(part) for part in parts],
            "doc_tokens": sizes[list(doc)] if doc else [], "sequence_id": sequence, "offset": offset,
        }
        if self.keep_ids:
            columns["ids"] = [part.astype("<i4") for part in parts]
        self.keys, self.ids, self.tokens = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
    window: int = WINDOW, linear: float = 1.0, quadratic: float = 1.0 / 1024, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences; with `keep_ids` also the ids.

    `tokenizer` is a file that the driver reads; its content is of fixed size and sent to the tasks.
    """
    from jobloom.llm.tokens import Encoder

    content = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    shape = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + (", ids array<int>" if keep_ids else "")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, schema = Encoder(content.value), None, None
        for batch in batches:
            if schema is None:
                whole = pa.int64()
                schema = pa.schema(
                    [("doc_id", batch.schema.field("doc_id").type)]
                    + [(n, whole) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
                    + ([("ids", pa.list_(pa.int32()))] if keep_ids else [])
                )
                held = _Window(TaskContext.get().partitionId() << 33, capacity, linear, quadratic, keep_ids)
            for part in slices(batch, most=SLICE_BYTES):
                ids, bounds = encoder.encode(part["text"])
                for i, name in enumerate(part["doc_id"].to_pylist()):
                    own = np.empty(bounds[i + 1] - bounds[i] + 1, "<u4")
                    own[:-1], own[-1] = ids[bounds[i] : bounds[i + 1]], end_id
                    held.add(name, own)
                    if held.tokens >= window * capacity:
                        yield held.pack(schema)
        if held is not None and held.keys:
            yield held.pack(schema)

    return narrow.mapInArrow(run, shape)
