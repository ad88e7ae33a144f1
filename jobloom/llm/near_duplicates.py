"""N-gram Jaccard join by a forest of MinHash prefix tries with exact verification (operator 9).

A text is the set of its runs of five words; a text of one to four words is one run. Texts
with equal sets are one class, and one of them stands for all.

Every class has `trees` signatures of min-hashes, compared from their first hash on. In a forest of
tries, prefixes are shortened from `longest` hashes until a text has met enough others. Here every
link counts, so no class may stop early: the length at which a pair at the threshold meets in
some tree with the target recall is the same for all classes and follows from the threshold (5 hashes
for 0.8 and 24 trees). So the tries are not walked down: classes meet where they share the whole prefix of
that length, and only its hash is kept. Classes that meet, directly or through others, are a candidate
group. Within it all pairs are verified on the shingle sets themselves, so what comes out is exact,
and a pair that met nowhere may still be found.

No pairs are listed. Large groups are cut into blocks, every two blocks are compared in a task of
bounded size by counting common shingles in matrices, and a class gets its number of links and
one edge to the least class it hangs together with. The edges give the near-duplicate groups.

Defined cases: null and empty texts have no shingles and are alone; equal short texts are
copies; repeated rows are copies; null ids come last when a group is named; an empty table
gives no rows; carried columns lie in a struct, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.components import connected
from jobloom.llm.textkit import Words, mix, mixed, ragged, slices, windows
from jobloom.llm.units import tidy
from jobloom.sources.storage import shared_folder

SHINGLE = 5
THRESHOLD = (4, 5)
BLOCK_SHINGLES = 1 << 20
BLOCK_CLASSES = 1_500
_COLUMNS = 4_096


@dataclass(frozen=True)
class Forest:
    trees: int = 24
    longest: int = 8
    target: float = 0.9999

    def recall(self, length: int, similarity: float) -> float:
        return 1 - (1 - similarity**length) ** self.trees

    def length(self, similarity: float) -> int:
        """The longest prefix that reaches the target recall at this similarity."""
        length = self.longest
        while length > 1 and self.recall(length, similarity) < self.target:
            length -= 1
        return length


def _shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and where each text's begin."""
    words = Words(texts)
    hashes, counts = words.hashes(), words.counts()
    _, found = windows(hashes, words.bounds, size)
    each = np.maximum(counts - size + 1, 0)
    bounds = np.append(0, np.cumsum(each))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):  # one run of all words, told apart from longer runs by its length
        alone = []
        for i in short.tolist():
            low, n = words.bounds[i], int(counts[i])
            alone.append(windows(hashes[low : low + n], np.array([0, n]), n)[1][0] ^ np.uint64(mixed(n)))
        found = np.insert(found, bounds[short], np.array(alone, np.uint64))
        each[short] = 1
        bounds = np.append(0, np.cumsum(each))
    return found, bounds


def _distinct(found: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _set_hash(shingles: np.ndarray) -> np.int64:
    return (mix(shingles).sum(dtype=np.uint64) ^ np.uint64(mixed(len(shingles)))).view(np.int64)


def _signed(docs: DataFrame, size: int, trees: int, length: int) -> DataFrame:
    """row, number, class (hash of the shingle set), shingles (their count) and the prefix of each tree."""
    factors = mix(np.arange(1, 2 * trees * length + 1, dtype=np.uint64)).reshape(2, -1) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, bounds = _shingles(part["text"], size)
                full = np.flatnonzero(np.diff(bounds))
                prefixes = np.zeros((trees, len(full)), np.uint64)
                for tree in range(trees if len(full) else 0):
                    for place in range(tree * length, (tree + 1) * length):
                        least = np.minimum.reduceat((found ^ factors[0, place]) * factors[1, place], bounds[full])
                        prefixes[tree] = mix(prefixes[tree] * np.uint64(0x9E3779B97F4A7C15) + least)
                sets = _distinct(found, bounds)
                lists = np.zeros(len(part) + 1, np.int32)
                lists[full + 1] = trees
                yield pa.RecordBatch.from_arrays(
                    [
                        part["row"], part["number"],
                        pa.array([_set_hash(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(lists, dtype=np.int32)), pa.array(prefixes.T.ravel().view(np.int64))),
                    ],
                    names=["row", "number", "class", "shingles", "prefixes"],
                )

    shape = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(run, f"row {shape}, number long, class long, shingles long, prefixes array<long>")


def _with_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(class, set): the sorted shingles of texts, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = _distinct(*_shingles(part["text"], size))
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_hash(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["class", "set"],
                )

    return texts.select("text").mapInArrow(run, "class long, set binary")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles every left set shares with every right set."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    flat = np.concatenate(left + right)
    names, which, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # a column for each shingle of two sets or more
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    kept = times[which] > 1
    row, column = row[kept], shared[which[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(shared[-1]) + 1, _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        cells = np.zeros((len(left) + len(right), _COLUMNS), np.float32)
        cells[row[a:b], column[a:b] - at] = 1
        out += cells[: len(left)] @ cells[len(left) :].T
    return out.round().astype(np.int64)


def _hang(links: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The least name each row hangs together with."""
    label = names.copy()
    while True:
        new = np.minimum(label, np.where(links, label[None, :], np.iinfo(np.int64).max).min(1))
        if (new == label).all():
            return label
        label = new


def _verify(threshold: tuple[int, int]):
    """Links of the classes in one task: whole groups, or two blocks of a group."""
    part, whole = threshold

    def compare(sets, names, copies, side, cross) -> list[tuple[int, int, int]]:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == int(cross))
        if not len(left) or not len(right):
            return []
        common = _common([sets[i] for i in left], [sets[i] for i in right])
        size = np.array([len(s) for s in sets])
        # common / (a + b - common) >= part / whole, in whole numbers
        alike = (whole + part) * common >= part * (size[left][:, None] + size[right][None, :])
        links = np.zeros((len(sets), len(sets)), bool)
        links[np.ix_(left, right)] = alike
        links |= links.T
        np.fill_diagonal(links, False)
        linked = np.flatnonzero(links.any(1))
        if not len(linked):
            return []
        links = links[np.ix_(linked, linked)]
        least = _hang(links, names[linked])
        return list(zip(names[linked].tolist(), (links @ copies[linked]).tolist(), least.tolist(), strict=True))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        task, group = key[0].as_py(), rows["group"].to_numpy()
        cross = task["j"] >= 0 and task["i"] != task["j"]
        order = np.argsort(group, kind="stable")
        names, copies, side = (rows[n].to_numpy()[order] for n in ("class", "copies", "side"))
        payload = rows["set"].to_pylist()
        ends = np.flatnonzero(np.append(np.diff(group[order]) != 0, True)) + 1
        out, at = [], 0
        for end in ends.tolist():
            sets = [np.frombuffer(payload[i], np.uint64) for i in order[at:end]]
            out += compare(sets, names[at:end], copies[at:end], side[at:end], cross)
            at = end
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("class", "links", "least"), columns, strict=True)})

    return run


def join(
    docs: DataFrame, size: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, forest: Forest = Forest(),
    text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: doc_id, class_id (least id of its near-duplicate group), copy_of (least id with
    an equal shingle set), n_links (other documents at or above the threshold), first (whether it is
    the group's one to keep), and a struct `row` of the carried columns."""
    spark = docs.sparkSession

    def written(df: DataFrame, purpose: str) -> DataFrame:
        path = shared_folder(spark, purpose)
        with tidy(spark):
            df.write.parquet(path)
        return spark.read.parquet(path)

    rows = docs.select(
        F.struct(F.col(key).alias("doc_id"), *[F.col(name) for name in carry if name != key]).alias("row"),
        F.monotonically_increasing_id().alias("number"), F.col(text).alias("text"),
    )
    length = forest.length(threshold[0] / threshold[1])
    signed = written(_signed(rows, size, forest.trees, length), "signatures")
    id_ = F.col("row.doc_id")
    name = F.struct(id_.isNull().alias("none"), id_.alias("doc_id"), "number")  # least first, null ids last
    classes = written(
        signed.where("class is not null").groupBy("class")
        .agg(F.min(name).alias("name"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("prefixes").alias("prefixes")),
        "classes",
    )
    # Where classes meet in a tree, each gets an edge to the least of them.
    spots = classes.select("class", F.posexplode("prefixes").alias("tree", "prefix"))
    meetings = spots.groupBy("tree", "prefix").agg(F.min("class").alias("least"), F.max("class").alias("greatest")).where("least < greatest")
    edges = spots.join(meetings.select("tree", "prefix", "least"), ["tree", "prefix"]).select(F.col("class").alias("a"), F.col("least").alias("b"))
    candidates = written(
        connected(edges).join(classes, F.col("vertex") == F.col("class")).select("class", F.col("component").alias("group"), "copies", "shingles", F.col("name.doc_id").alias("id")),
        "candidates",
    )
    # Groups of bounded size share tasks; larger ones are cut into blocks that meet two by two.
    sizes = candidates.groupBy("group").agg(F.count("*").alias("n"), F.sum("shingles").alias("s"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("s") / BLOCK_SHINGLES), F.ceil(F.col("n") / BLOCK_CLASSES)).cast("int"))
    total = sizes.where("blocks = 1").agg(F.sum("s")).first()[0] or 0
    shared = F.pmod(F.xxhash64("group"), F.lit(max(-(-total // BLOCK_SHINGLES), int(spark.conf.get("spark.sql.shuffle.partitions"))))).cast("int")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    at = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = (
        candidates.join(sizes.select("group", "blocks"), "group")
        .withColumn("own", own).withColumn("other", at)
        .select(
            "class", "group", "copies",
            F.when(F.col("blocks") == 1, F.struct(F.lit(None).cast("long").alias("group"), shared.alias("i"), F.lit(-1).alias("j")))
            .otherwise(F.struct(F.col("group"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))).alias("task"),
            F.when((F.col("blocks") > 1) & (F.col("own") > F.col("other")), 1).otherwise(0).cast("int").alias("side"),
        )
    )
    chosen = candidates.select("id", F.lit(True).alias("wanted"))
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(chosen, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = _with_shingles(texts, size).groupBy("class").agg(F.first("set").alias("set"))
    verified = placed.join(sets, "class").groupBy("task").applyInArrow(_verify(threshold), "class long, links long, least long")
    links = written(verified, "links")
    groups = connected(links.select(F.col("class").alias("a"), F.col("least").alias("b")))
    counted = links.groupBy("class").agg(F.sum("links").alias("links"))
    grouped = (
        classes.select("class", "name", "copies").join(counted, "class", "left")
        .join(groups.withColumnRenamed("vertex", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    heads = grouped.groupBy("component").agg(F.min("name").alias("head"))
    known = grouped.join(heads, "component").select(
        "class", "head", "name", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    )
    return signed.drop("prefixes").join(known, "class", "left").select(
        id_.alias("doc_id"),
        F.when(F.col("head").isNull(), id_).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.when(F.col("head").isNull(), id_).otherwise(F.col("name.doc_id")).alias("copy_of"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("head").isNull() | (F.col("head.number") == F.col("number"))).alias("first"),
        "row",
    )
