"""Exact top-k search by inner product with a vector-approximation file (operator 3).

Every dimension has cells of its own: equal ones between its outer quantiles, and beyond them cells
that double in width, so that a few wild values widen no cell that ordinary ones lie in. The cell
numbers (a byte per component) are the approximation file. A scan of the cells gives bounds for the score of a
query and a vector: the score with the cell centres, plus or minus the halves of the cells
weighed by the query's absolute components. Vectors whose upper bound is below the k-th best lower bound are
out. Of the rest the exact vectors are read in order of their bound: first the best few, then only
those whose bound still reaches the k-th exact score. The result is exact.

Queries and cells meet in blocks of bounded size. Equal vectors are one class with its k + 1
smallest ids, which is all a result can need, so any number of copies costs one scan. Scores are
compared per class; ids are put in, and a query's own row dropped, at the end.

Scores are exact: in longs where the largest components allow, else in whole numbers of any size.
Components are stored as whole doubles, so their size has no limit; where even the bounds do not fit
a double, the pair counts as open. Only a result row whose score does not fit a long is an error.

Defined cases: vectors that are null or hold a null or a non-finite component take no part; vectors
of unlike lengths never meet; a null id is no query and comes last among ties; a repeated row is a candidate for its twin; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from jobloom.sources.storage import shared_folder

CELLS = 64
OUTER = 40  # cells beyond each quantile; the last one reaches to the end
TAIL = 0.005  # share of the values beyond either quantile
CELL_BLOCK = 16_384
QUERY_BLOCK = 2_048
LEAST_BLOCKS = 64
SURE = float(1 << 62)  # sums of products below fit a long, whatever the rounding of the bound
_CHUNK = 2_048


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def quantised(vectors: DataFrame, scale: float, vector: str, key: str) -> DataFrame:
    """(vec_id, v): floor(scale * component) as whole doubles, vectors of finite components only."""
    given = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    rows = vectors.select(F.col(key).alias("vec_id"), given.alias("v")).where(F.col("v").isNotNull())

    def whole(x: Column) -> Column:
        # From 2**53 on every double is whole; floor() gives longs.
        near = F.abs(x) < float(1 << 53)
        lost = F.raise_error(F.lit("a component does not fit a double after scaling"))
        return F.when(near, F.floor(x).cast("double")).when(F.abs(x) == math.inf, lost).otherwise(x)

    return rows.where(F.coalesce(usable, F.lit(False))).withColumn("v", F.transform("v", lambda x: whole(x * scale)))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(class, v, ids): equal vectors and their k + 1 smallest ids, limited before the shuffle."""
    first = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id"))).alias("ids"))
    return _written(grouped.select(F.monotonically_increasing_id().alias("class"), "v", F.col("ids.vec_id").alias("ids")), "classes")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


class Grid:
    """The cells of every dimension: `low` and `width` of the equal ones, `least` and `greatest` value of all."""

    def __init__(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, greatest: np.ndarray, cells: int):
        self.cells, self.low, self.least, self.greatest = cells, low, least, greatest
        self.width = np.maximum(np.ceil((high - low) / cells), 1.0)

    def code(self, v: Column) -> Column:
        """The cells of a vector as bytes; JVM arithmetic, repeated by no one else."""
        low, width = (F.array(*[F.lit(float(x)) for x in values]) for values in (self.low, self.width))
        reach = float(self.cells)

        def cell(x: Column, i: Column) -> Column:
            place = (x - F.get(low, i)) / F.get(width, i)
            doubled = lambda away: F.least(F.floor(F.log2(away / reach + 1)), F.lit(OUTER - 1))
            return (
                F.when(place < 0, self.cells + doubled(-place))
                .when(place >= reach, self.cells + OUTER + doubled(place - reach))
                .otherwise(F.floor(place))
            )

        return F.unhex(F.array_join(F.transform(v, lambda x, i: F.lpad(F.hex(cell(x, i).cast("long")), 2, "0")), ""))

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Centre and half width of each cell, per dimension; a little wide, as places are rounded."""
        low, width = self.low[:, None], self.width[:, None]
        inner = np.arange(self.cells + 1)[None, :] * width + low
        span = (2.0 ** np.arange(OUTER + 1) - 1)[None, :] * self.cells * width
        below, above = low - span, inner[:, -1:] + span
        below[:, -1], above[:, -1] = np.minimum(below[:, -1], self.least), np.maximum(above[:, -1], self.greatest)
        start = np.concatenate([inner[:, :-1], below[:, 1:], above[:, :-1]], 1)
        end = np.concatenate([inner[:, 1:], below[:, :-1], above[:, 1:]], 1)
        half = (end - start) / 2
        return start + half, half * (1 + 1e-9) + 1e-9 * (np.abs(start) + np.abs(end)) + 1e-9


def _scan(grids: dict[int, Grid], wanted: int):
    """Bounds of a block of queries against a block of cells: per query the classes that may count."""

    def run(queries: pa.Table, cells: pa.Table) -> pa.Table:
        out = {"query": [], "class": [], "upper": [], "lower": []}
        if len(queries) and len(cells):
            q, names = _matrix(queries["v"]), queries["class"].to_numpy()
            ids = cells["class"].to_numpy()
            codes = np.frombuffer(b"".join(cells["codes"].to_pylist()), np.uint8).reshape(len(ids), q.shape[1])
            kept: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))] * len(q)
            with np.errstate(over="ignore", invalid="ignore"):
                # Vectors without components score nothing with each other.
                centre, half = grids[q.shape[1]].bounds() if q.shape[1] else (np.zeros((0, 1)), np.zeros((0, 1)))
                places = np.arange(q.shape[1])
                for at in range(0, len(ids), _CHUNK):
                    own = codes[at : at + _CHUNK]
                    middle = q @ centre[places, own].T
                    slack = np.abs(q) @ (half[places, own] + 1e-12 * np.abs(centre[places, own])).T
                    upper, lower = middle + slack, middle - slack
                    known = np.isfinite(upper) & np.isfinite(lower)  # of other pairs nothing is known
                    upper[~known], lower[~known] = np.inf, -np.inf
                    cut = np.full(len(q), -np.inf)
                    if lower.shape[1] >= wanted:
                        cut = np.partition(lower, -wanted, axis=1)[:, -wanted]
                    rows, near = np.nonzero(upper >= cut[:, None])
                    ends = np.searchsorted(rows, np.arange(len(q) + 1))
                    for i in range(len(q)):
                        some = near[ends[i] : ends[i + 1]]
                        found = (ids[at + some], upper[i, some], lower[i, some])
                        kept[i] = tuple(np.concatenate(pair) for pair in zip(kept[i], found, strict=True))
            for i, (found, upper, lower) in enumerate(kept):
                if len(found) > wanted:
                    near = upper >= np.partition(lower, -wanted)[-wanted]
                    found, upper, lower = found[near], upper[near], lower[near]
                out["query"].append(np.full(len(found), names[i]))
                out["class"].append(found)
                out["upper"].append(upper)
                out["lower"].append(lower)
        joined = {n: np.concatenate(x) if x else np.zeros(0, np.int64 if n in ("query", "class") else np.float64) for n, x in out.items()}
        return pa.table(joined)

    return run


def _grids(classes: DataFrame, cells: int) -> dict[int, Grid]:
    """A grid per vector length, from quantiles and ends of each dimension: rows of vectors by place, combined before their shuffle."""
    each = classes.select(F.size("v").alias("length"), F.posexplode("v").alias("place", "x"))
    found = each.groupBy("length", "place").agg(
        F.percentile_approx("x", [TAIL, 1 - TAIL], 1000).alias("q"), F.min("x").alias("least"), F.max("x").alias("greatest")
    )
    rows: dict[int, dict[int, tuple]] = {}
    for row in found.collect():
        rows.setdefault(row["length"], {})[row["place"]] = (*row["q"], row["least"], row["greatest"])
    return {n: Grid(*np.array([own[i] for i in range(n)]).T, cells) for n, own in rows.items()}


@F.udf(ArrayType(LongType()))
def _any_size(q, v):
    """The exact score and 0; or, beyond a long, 0 and the side on which it lies."""
    if q is None:
        return None
    score = sum(int(a) * int(b) for a, b in zip(q, v, strict=True))
    return [score, 0] if -(1 << 63) <= score < 1 << 63 else [0, 1 if score > 0 else -1]


def _scored(pairs: DataFrame, queries: DataFrame, classes: DataFrame, sure: bool) -> DataFrame:
    """Exact integer scores of (query, class) pairs, and `beyond`: -1 or 1 for those below or above a long.

    `sure`: every score fits a long, and no Python is needed.
    """
    asked = queries.select(F.col("class").alias("query"), F.col("v").alias("q"))
    read = pairs.join(classes.select("class", "v"), "class").join(asked, "query")
    product = F.zip_with("q", "v", lambda a, b: a.cast("long") * b.cast("long"))
    score = F.aggregate(product, F.lit(0).cast("long"), lambda s, x: s + x)
    if sure:
        return read.select(*pairs.columns, score.alias("score"), F.lit(0).cast("long").alias("beyond"))
    most = lambda name: F.coalesce(F.array_max(F.transform(name, F.abs)), F.lit(0.0))
    read = read.withColumn("fits", (most("q") < SURE) & (most("v") < SURE) & (most("q") * most("v") * F.size("v") < SURE))
    large = read.withColumn("large", _any_size(F.when(~F.col("fits"), F.col("q")), F.when(~F.col("fits"), F.col("v"))))
    return large.select(
        *pairs.columns, F.when(F.col("fits"), score).otherwise(F.col("large")[0]).alias("score"),
        F.when(F.col("fits"), F.lit(0).cast("long")).otherwise(F.col("large")[1]).alias("beyond"),
    )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vector: str = "embedding", key: str = "vec_id",
    cells: int = CELLS, cell_block: int = CELL_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of every query row; `is_query` speaks of vec_id."""
    wanted = k + 1  # classes: the query's own row is dropped at the end
    rows = _written(quantised(vectors, scale, vector, key), "vectors")
    classes = _classes(rows, k)
    asking = _written(rows.where(is_query).join(classes.select("class", "v"), "v").select("class", F.col("vec_id").alias("query_id")), "asking")
    queries = _written(asking.select("class").distinct().join(classes.select("class", "v"), "class"), "queries")
    bounds = classes.agg(F.count("*").alias("n"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.max(F.size("v")).alias("length")).first()
    n_queries = queries.count()
    low, high = int(bounds["low"] or 0), int(bounds["high"] or 0)
    sure = max(abs(low), abs(high)) ** 2 * (bounds["length"] or 0) < SURE
    grids = _grids(classes, min(cells, 256 - 2 * OUTER))
    blocks = max(-(-bounds["n"] // cell_block), LEAST_BLOCKS)
    query_blocks = max(-(-n_queries // query_block), 1)

    place = F.struct(F.size("v").alias("length"), F.col("q"), F.col("c")).alias("at")
    codes = F.lit(b"")
    for length, grid in grids.items():
        codes = F.when(F.size("v") == length, grid.code(F.col("v"))).otherwise(codes)
    left = (
        queries.withColumn("q", F.pmod(F.xxhash64("class"), F.lit(query_blocks)).cast("int"))
        .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select(place, "class", "v")
    )
    right = (
        classes.withColumn("c", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        .select(place, "class", codes.alias("codes"))
    )
    near = left.groupBy("at").cogroup(right.groupBy("at")).applyInArrow(
        _scan(grids, wanted), "query long, class long, upper double, lower double"
    )
    near = _written(near, "near")
    by_lower = Window.partitionBy("query").orderBy(F.desc("lower"))
    certain = near.withColumn("n", F.row_number().over(by_lower)).where(F.col("n") <= wanted)
    certain = certain.groupBy("query").agg(F.when(F.count("*") == wanted, F.min("lower")).alias("certain"))
    open_ = near.join(certain, "query").where(F.col("certain").isNull() | (F.col("upper") >= F.col("certain")))
    in_order = Window.partitionBy("query").orderBy(F.desc("upper"), "class")
    open_ = _written(open_.withColumn("n", F.row_number().over(in_order)).select("query", "class", "upper", "n"), "open")
    first = _written(_scored(open_.where(F.col("n") <= wanted), queries, classes, sure), "first")
    # Not above the true score: one above a long counts as the largest long, nothing is known of one below.
    known = F.when(F.col("beyond") == 0, F.col("score").cast("double")).when(F.col("beyond") > 0, float(1 << 63)).otherwise(-math.inf)
    least = first.groupBy("query").agg(F.when(F.count("*") == wanted, F.min(known)).alias("least"))
    later = open_.where(F.col("n") > wanted).join(least, "query").where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    scored = first.select("query", "class", "score", "beyond").unionByName(
        _scored(later.select("query", "class"), queries, classes, sure).select("query", "class", "score", "beyond")
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("beyond"), F.desc("score"), F.col("vec_id").asc_nulls_last())
    best = (
        scored.join(classes.select("class", "ids"), "class")
        .select("query", "score", "beyond", F.explode("ids").alias("vec_id"))
        .withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= wanted)
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score", "beyond"))).alias("best"))
    )
    own = F.array_position(F.transform("best", lambda b: F.coalesce(b["vec_id"] == F.col("query_id"), F.lit(False))), True).cast("int")
    others = F.slice(F.filter("best", lambda b, i: F.col("own") != i + 1), 1, k)
    lost = F.raise_error(F.lit("a score does not fit a long"))
    return (
        asking.join(best, asking["class"] == best["query"])
        .withColumn("own", own)
        .select("query_id", F.posexplode(others).alias("place", "b"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.when(F.col("b.beyond") != 0, lost).otherwise(F.col("b.score")).alias("score"))
    )
