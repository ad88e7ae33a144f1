"""Vectors as whole numbers, and sums of whole numbers of any size over all tasks.

A task adds up what it sees and sends one row per key: a JSON list of whole numbers. The
rows of a key meet in one task, which adds them as they stream by, so neither the number
of tasks nor the size of a sum is limited, and what travels is bounded by the width of
the vectors, not by their number.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.sources.storage import shared_folder

PARTIAL = "key int, sums string"
EXACT = float(1 << 53)  # whole doubles below are exact, and so are their sums


def stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def finite_vectors(vectors: DataFrame, vector: str, **carry: str) -> DataFrame:
    """(carried columns, v): vectors as doubles, without null ones and those that hold a null, NaN or infinity."""
    given = F.transform(F.col(vector), lambda x: x.cast("double"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    rows = vectors.select(*[F.col(name).alias(alias) for alias, name in carry.items()], given.alias("v"))
    return rows.where(F.col("v").isNotNull() & ~F.coalesce(broken, F.lit(False)))


def by_length(rows: DataFrame) -> dict[int, DataFrame]:
    """The rows of each vector length; a table of embeddings has one or few."""
    lengths = [row["length"] for row in rows.select(F.size("v").alias("length")).distinct().collect()]
    return {length: rows.where(F.size("v") == length) for length in sorted(lengths) if length}


def floored(column: pa.Array, length: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component as a matrix: of doubles where those are exact, else of Python's whole numbers.

    `scale` is a power of two, so the product of a double below 2**53 is exact.
    """
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), length)
    if not x.size or np.abs(x).max() * scale < EXACT:
        return np.floor(x * scale)
    # math.floor of a double is exact at any size; the fraction matters only below 2**53.
    whole = lambda c: math.floor(c * scale) if abs(c) * scale < EXACT else int(c) * scale + math.floor((c - int(c)) * scale)
    return np.frompyfunc(whole, 1, 1)(x).astype(object)


def json_row(key: int, sums: list) -> tuple[int, str]:
    return key, json.dumps([int(x) for x in sums])


def partial_sums(rows: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, str]]]) -> DataFrame:
    """One row per task and key; `of_task` gives (key, JSON list) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = [], []
        for key, text in of_task(batches):
            keys.append(key)
            sums.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(sums, pa.string())], ["key", "sums"])

    return rows.mapInArrow(run, PARTIAL)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[int]] = {}
    for batch in batches:
        for key, text in zip(batch["key"].to_pylist(), batch["sums"].to_pylist(), strict=True):
            sums = json.loads(text)
            total[key] = [a + b for a, b in zip(total[key], sums, strict=True)] if key in total else sums
    keys = list(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array([json.dumps(total[key]) for key in keys], pa.string())], ["key", "sums"]
    )


def totals(partials: DataFrame, keys: int) -> dict[int, list[int]]:
    """The sums of each key over all tasks: as many numbers as the vectors' width asks for, whatever the rows."""
    parts = min(keys, int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    added = partials.repartition(max(parts, 1), "key").mapInArrow(_added, PARTIAL)
    return {row["key"]: json.loads(row["sums"]) for row in added.collect()}
