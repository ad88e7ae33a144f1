"""Hilbert-curve sharding (operator 6): runs of a space-filling order over metadata.

Every dimension is quantised into 2**bits cells between its own approximate
quantiles, the cells give a place on a Hilbert curve, and the rows in curve order are cut
into runs whose row counts differ by one at most. Rows that are close in all
dimensions lie in the same run, so the files of a run span small ranges and are
pruned by filters on any of the dimensions.

Exact ranks need no single sorted task: the rows are range-partitioned and sorted,
written with their place inside the partition, and a table with one row per partition
gives the offsets. The order ends with the text's checksum and the row's number, so a
curve place that holds a third of all rows is split like any other.

Defined cases: null and empty texts have no bytes and checksum 0; null dimensions come
first; repeated rows take places of their own; an empty table gives no rows; columns are
carried in a struct, so their names clash with nothing.
"""

from __future__ import annotations

from collections import Counter
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from jobloom.sources.storage import shared_folder

DIMENSIONS = ("lang", "source", "size")
SHARDS = 40
_PLACE_BITS = 33  # of monotonically_increasing_id: the partition is above


def curve_places(dimensions: int, bits: int) -> list[int]:
    """The place on the Hilbert curve of every cell, cells in row-major order."""

    def place(cell: tuple[int, ...]) -> int:
        x, top = list(cell), 1 << (bits - 1)
        q = top
        while q > 1:  # undo the turns of each level
            for i in range(dimensions):
                if x[i] & q:
                    x[0] ^= q - 1
                else:
                    swap = (x[0] ^ x[i]) & (q - 1)
                    x[0] ^= swap
                    x[i] ^= swap
            q >>= 1
        for i in range(1, dimensions):
            x[i] ^= x[i - 1]
        turn, q = 0, top
        while q > 1:
            if x[-1] & q:
                turn ^= q - 1
            q >>= 1
        x = [value ^ turn for value in x]
        out = 0
        for level in reversed(range(bits)):
            for value in x:
                out = out << 1 | value >> level & 1
        return out

    return [place(cell) for cell in product(range(1 << bits), repeat=dimensions)]


def _codes(rows: DataFrame, columns: dict[str, Column]) -> dict[str, Column]:
    """Numbers in the order of each column; text by six bytes behind what all values start with."""
    kinds = rows.select(*[c.alias(name) for name, c in columns.items()]).schema
    text = [name for name in columns if isinstance(kinds[name].dataType, StringType)]
    ends = rows.agg(*[f(columns[name]).alias(f"{f.__name__}_{name}") for name in text for f in (F.min, F.max)]).first() if text else None
    codes = {name: column.cast("double") for name, column in columns.items() if name not in text}
    for name in text:
        low, high = ((ends[f"{f}_{name}"] or "").encode() for f in ("min", "max"))
        shared = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        tail = F.substring(F.encode(columns[name], "UTF-8"), shared + 1, 6)
        codes[name] = F.conv(F.rpad(F.hex(tail), 12, "0"), 16, 10).cast("double")
    return {name: F.coalesce(code, F.lit(-1.0)) for name, code in codes.items()}


def curve_index(rows: DataFrame, columns: dict[str, Column], bits: int) -> Column:
    """The curve place of each row; the quantile bounds (2**bits per dimension) come to the driver."""
    codes = _codes(rows, columns)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(code, shares).alias(name) for name, code in codes.items()]).first()
    cell = F.lit(0)
    for name, code in codes.items():
        # A value that fills several quantiles takes as many cells: the next one lies that far away.
        times = Counter(found[name] or [])
        above = [(code > F.lit(bound)).cast("int") * n for bound, n in sorted(times.items())]
        cell = cell * (1 << bits) + sum(above, F.lit(0))
    places = F.expr(f"array({','.join(map(str, curve_places(len(columns), bits)))})")
    return F.element_at(places, cell + 1)


def hilbert_shards(
    docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, bits: int = 4,
    text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = (), partitions: int | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard, slot and a struct `row` of the carried columns.

    `size` as a dimension is the text's bytes plus 16. dimensions * bits is at most 15.
    """
    if len(dimensions) * bits > 15:
        raise ValueError("the curve has too many cells for its table")
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(F.col(key).alias("doc_id"), *[F.col(name) for name in carry if name != key]).alias("row"),
        F.struct(*[F.col(name) for name in dimensions if name != "size"], F.lit(0).alias("_")).alias("at"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.monotonically_increasing_id().alias("number"),
    )
    columns = {f"d{i}": F.col("size") if name == "size" else F.col("at")[name] for i, name in enumerate(dimensions)}
    order = ("curve", "text_crc32", "number")
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = shared_folder(spark, "shards")
    (
        rows.withColumn("curve", curve_index(rows, columns, bits))
        .select("row", "size", *order)
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .drop("number")
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path).withColumn("part", F.shiftright("place", _PLACE_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(everything).alias("total")
    )
    rank = F.col("offset") + F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    shard = F.expr(f"rank * {shards} div total")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        ranged.join(offsets, "part")
        .withColumn("rank", rank)
        .withColumn("shard", shard.cast("int"))
        .select(
            F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "curve", "shard",
            (F.col("rank") - start).alias("slot"), "row",
        )
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """All columns of the documents, one folder per shard, in curve order of the files."""
    sharded = hilbert_shards(docs, carry=tuple(docs.columns), **options)
    sharded.select("row.*", "shard").write.partitionBy("shard").parquet(path)
