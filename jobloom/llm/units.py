"""Documents dealt into units, and hashes dealt into buckets, of bounded size.

Corpus-wide questions about runs of words go in two steps. A unit (some documents)
sends each different hash once to the bucket its value belongs to; a bucket sees a hash
from all units and answers the units that sent it. However often a run of words occurs, a
unit sends it once, so no bucket gets a hot key. The documents are shuffled once; the
plans that read them again share that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UNIT_BYTES = 16 << 20
LEAST_UNITS = 64


def number_of_units(docs: DataFrame, text: str = "text", unit_bytes: int = UNIT_BYTES) -> int:
    """Units (and buckets) for the documents: about `unit_bytes` of text each."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long")).alias("bytes")).first()["bytes"] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-total // unit_bytes), LEAST_UNITS, partitions)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dealt(
    docs: DataFrame, units: int, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = (), more: dict[str, Column] | None = None
) -> DataFrame:
    """(unit, row, text, more...): documents by a hash of id and text, so that reruns deal alike."""
    rows = docs.select(
        *[column.alias(name) for name, column in (more or {}).items()],
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(units)).cast("int").alias("unit"),
        F.struct(F.col(key).alias("doc_id"), *[F.col(name) for name in carry if name not in (key, text)]).alias("row"),
        F.col(text).alias("text"),
    )
    return rows.repartition(units, "unit")


def packed(values: np.ndarray) -> bytes:
    """Eight-byte values plane by plane: of sorted hashes and small numbers, the upper planes compress away."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(payload: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(payload, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def by_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes: bucket b holds the values from b/buckets of the range on."""
    edges = [(b << 64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(hashes, np.array(edges, np.uint64)), len(hashes))


def sent(unit: int, groups: dict[int, np.ndarray], buckets: int) -> pa.Table:
    """Rows (bucket, unit, flags, payload) for sorted hashes grouped by their flags."""
    rows: dict[str, list] = {"bucket": [], "unit": [], "flags": [], "payload": []}
    for flags, hashes in groups.items():
        edges = by_bucket(hashes, buckets)
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            rows["bucket"].append(bucket)
            rows["payload"].append(packed(hashes[edges[bucket] : edges[bucket + 1]]))
        rows["flags"] += [flags] * (len(rows["bucket"]) - len(rows["flags"]))
    rows["unit"] = [unit] * len(rows["bucket"])
    return pa.table({n: pa.array(v, pa.binary() if n == "payload" else pa.int32()) for n, v in rows.items()})


SENT = "bucket int, unit int, flags int, payload binary"


def gathered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's hashes sorted, with their units and flags, and where each different hash begins."""
    parts = [unpacked(p) for p in rows["payload"].to_pylist()]
    sizes = [len(p) for p in parts]
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    units = np.repeat(rows["unit"].to_numpy().astype(np.int32), sizes)[order]
    flags = np.repeat(rows["flags"].to_numpy().astype(np.uint8), sizes)[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes, units, flags, first


def answers(units: np.ndarray, hashes: np.ndarray) -> pa.Table:
    """Rows (unit, payload): the hashes to tell each unit."""
    order = np.argsort(units, kind="stable")
    units, hashes = units[order], hashes[order]
    names, first = np.unique(units, return_index=True)
    ends = np.append(first, len(units))[1:]
    payload = [packed(hashes[a:b]) for a, b in zip(first, ends, strict=True)]
    return pa.table({"unit": pa.array(names, pa.int32()), "payload": pa.array(payload, pa.binary())})


ANSWERS = "unit int, payload binary"


def told(rows: pa.Table) -> np.ndarray:
    """All hashes of a unit's answers, sorted."""
    parts = [unpacked(p) for p in rows["payload"].to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted known ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values
