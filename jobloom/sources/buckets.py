"""Keyed Parquet tables in buckets: a write costs what its keys touch, not what is stored.

A row lies in the bucket that the hash of its key names. A write gives the touched buckets a new
generation in folders of their own (dynamic partition overwrite, so that a repeated write of a generation
replaces only itself) and then appends one row to the log. Until that row is there, readers
see the table as before; whoever opened an earlier generation goes on reading its files, which stay as they
are until `forget` removes what no kept generation needs. One writer at a time; a second one is
usually noticed.

Beside each bucket lies a Bloom filter of its keys. `unknown` asks it first, so that a batch of
mostly new keys reads next to nothing of the stored table; whatever it cannot rule out is
compared with the stored keys themselves, so no key is ever taken for a known one by chance.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom.operators.keyed import content_order
from jobloom.sources.storage import exists, shared_folder

BUCKETS = 64
_WORDS, _WORD_BITS = 4, 6  # of a block: four longs; 6 bits of a hash name one bit of a long
_KEYS_PER_BLOCK = 16  # 16 bits a key


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class BucketedTable:
    """`key` may repeat (links of a posting) or not (postings); null is a key like any other.

    `buckets` and `filters` (whether to keep Bloom filters, for tables that `unknown` is asked of) hold for
    a table when it is first written; later they are read from the log.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int = BUCKETS, filters: bool = True):
        self._spark, self._base, self.key = spark, base.rstrip("/"), key
        self._buckets, self._filtered, self._known = buckets, filters, False

    # ---- the log: a row per generation ----

    _LOG = "generation int, buckets int, filled array<int>, emptied array<int>, filtered boolean, schema string"

    def _log(self, at: int | None = None) -> list:
        """Rows up to a generation; a write and its buckets are one row, however large the table is."""
        path = f"{self._base}/log"
        found = self._spark.read.schema(self._LOG).parquet(path).collect() if exists(self._spark, path) else []
        rows = sorted(found, key=lambda row: row["generation"])
        if rows:
            self._buckets, self._filtered = rows[-1]["buckets"], rows[-1]["filtered"]
        self._known = True
        if at is not None and at not in {row["generation"] for row in rows}:
            raise ValueError(f"{self._base} has no generation {at}")
        return [row for row in rows if at is None or row["generation"] <= at]

    def generation(self) -> int | None:
        log = self._log()
        return log[-1]["generation"] if log else None

    @staticmethod
    def _current(log: list) -> dict[int, int]:
        """The generation of every bucket that holds rows."""
        current: dict[int, int] = {}
        for row in log:
            current |= dict.fromkeys(row["filled"], row["generation"])
            for bucket in row["emptied"]:
                current.pop(bucket, None)
        return current

    def _number(self) -> int:
        if not self._known:
            self._log()
        return self._buckets

    def bucket(self, key: str | Column | None = None) -> Column:
        """The bucket of a key: by its text, so that 7 as an int and as a long are one key."""
        value = F.col(self.key) if key is None else F.col(key) if isinstance(key, str) else key
        return F.pmod(F.xxhash64(value.cast("string")), F.lit(self._number())).cast("int")

    # ---- reading ----

    def read(self, buckets: list[int] | None = None, at: int | None = None) -> DataFrame | None:
        """The table, or some of its buckets, as of a generation (the last); None before the first write."""
        log = self._log(at)
        if not log:
            return None
        schema = T.StructType.fromJson(json.loads(log[-1]["schema"]))
        current = self._current(log)
        wanted = sorted(current) if buckets is None else sorted(set(buckets) & set(current))
        paths = [f"{self._base}/data/generation={current[b]}/bucket={b}" for b in wanted]
        return self._spark.read.schema(schema).parquet(*paths) if paths else self._spark.createDataFrame([], schema)

    def touched(self, rows: DataFrame, key: str | Column | None = None) -> list[int]:
        """The buckets that the keys of some rows lie in; at most as many as the table has."""
        return sorted(row["bucket"] for row in rows.select(self.bucket(key).alias("bucket")).distinct().collect())

    # ---- writing ----

    def _dealt(self, rows: DataFrame, distinct: bool) -> DataFrame:
        """`rows` with `bucket`, each bucket in as many pieces as there are shuffle partitions for it."""
        pieces = -(-int(self._spark.conf.get("spark.sql.shuffle.partitions")) // self._number())
        placed, by = rows.withColumn("bucket", self.bucket()), ["bucket"]
        if pieces > 1:
            placed, by = placed.withColumn("_piece", F.pmod(content_order(rows), F.lit(pieces))), ["bucket", "_piece"]
        dealt = placed.repartition(*by)
        return (dealt.distinct() if distinct else dealt).drop("_piece")

    def replace(self, rows: DataFrame, buckets: list[int] | None = None, distinct: bool = False) -> int:
        """Store `rows` as the whole content of the given buckets (all of them); the new generation.

        `rows` may read the table. All its keys lie in these buckets. With more shuffle partitions than
        buckets, a bucket is dealt over several tasks by its rows' content, so neither the number of
        buckets nor a key of many rows decides what one task sorts. `distinct`: equal rows, which lie in
        one piece, are stored once, without a shuffle of their own.
        """
        log = self._log()
        number, generation = self._number(), log[-1]["generation"] + 1 if log else 1
        placed = self._dealt(rows, distinct).withColumn("generation", F.lit(generation))
        writer = placed.write.partitionBy("generation", "bucket").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self._base}/data")
        path = f"{self._base}/data/generation={generation}"
        fresh = self._spark.read.schema(rows.schema).parquet(path) if exists(self._spark, path) else None
        touched = set(range(number) if buckets is None else buckets)
        sizes = {} if fresh is None else {row["bucket"]: row["count"] for row in fresh.groupBy("bucket").count().collect()}
        filled = set(sizes)
        if filled - touched:
            raise ValueError(f"rows of buckets that were not to be replaced: {sorted(filled - touched)}")
        if filled and self._filtered:
            self._write_filter(fresh, generation, max(sizes.values()))
        if (self.generation() or 0) != generation - 1:
            raise RuntimeError(f"another writer changed {self._base} meanwhile")
        numbers = lambda values: F.array(*[F.lit(v) for v in sorted(values)]).cast("array<int>")
        entry = self._spark.range(0, 1, 1, 1).select(
            F.lit(generation).alias("generation"), F.lit(number).alias("buckets"), numbers(filled).alias("filled"),
            numbers(touched - filled).alias("emptied"), F.lit(self._filtered).alias("filtered"),
            F.lit(rows.schema.json()).alias("schema"),
        )
        entry.write.mode("append").parquet(f"{self._base}/log")
        return generation

    def forget(self, keep: int = 1) -> int:
        """Remove bucket folders that none of the last `keep` generations reads; their number.

        Earlier generations cannot be read any more. Call it when no reader of those is at work.
        """
        log = self._log()
        needed = {(g, b) for last in log[-keep:] for b, g in self._current([r for r in log if r["generation"] <= last["generation"]]).items()}
        gone = [(row["generation"], b) for row in log for b in row["filled"] if (row["generation"], b) not in needed]
        paths = self._spark.sparkContext._jvm.org.apache.hadoop.fs
        removed = 0
        for generation, bucket in gone:
            for part in ("data", "filters"):
                path = paths.Path(f"{self._base}/{part}/generation={generation}/bucket={bucket}")
                there = path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
                removed += bool(there and part == "data")
        return removed

    # ---- what lies between two generations ----

    def changes(self, since: int | None, until: int | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
        """(key, change) of keys that were inserted, changed or deleted between two generations; keys are unique.

        Only buckets written in between are read. Columns in `ignore` make no change; a column that one
        generation lacks is null there.
        """
        until = self.generation() if until is None else until
        log = self._log(until)
        before = {} if since is None else self._current(self._log(since))
        after = self._current(log)
        moved = [b for b in sorted(set(before) | set(after)) if before.get(b) != after.get(b)]
        new = self.read(moved, until)
        old = new.limit(0) if since is None else self.read(moved, since)
        columns = [c for c in dict.fromkeys(new.columns + old.columns) if c not in (self.key, *ignore)]

        def row(df: DataFrame, name: str) -> DataFrame:
            cells = [(F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in columns]
            return df.select(F.col(self.key).alias(f"{name}_key"), F.struct(F.lit(1).alias("is"), *cells).alias(name))

        joined = row(old, "old").join(row(new, "new"), F.col("old_key").eqNullSafe(F.col("new_key")), "full_outer")
        change = (
            F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted")
            .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
        )
        key = F.when(F.col("new").isNull(), F.col("old_key")).otherwise(F.col("new_key"))
        return joined.select(key.alias(self.key), change.alias("change")).where(F.col("change").isNotNull())

    # ---- Bloom filters ----

    @staticmethod
    def _probes(key: Column) -> list[Column]:
        """The bits of a key: two in each word of its block."""
        hashed = F.xxhash64(key.cast("string"), F.lit("bits"))
        place = lambda n: F.shiftright(hashed, n * _WORD_BITS).bitwiseAND((1 << _WORD_BITS) - 1).cast("int")
        bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), place(n))
        return [bit(2 * word).bitwiseOR(bit(2 * word + 1)) for word in range(_WORDS)]

    @staticmethod
    def _block(key: Column, blocks: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string"), F.lit("block")), blocks)

    def _bits(self, fresh: DataFrame, largest: int) -> DataFrame:
        """Bits of the keys of some rows (with `bucket`), in blocks of a few words; as many as the largest bucket asks for.

        Each key is one row of an aggregate that is combined before its shuffle: a task holds a block per 16 keys.
        """
        key, blocks = F.col(self.key), F.lit(-(-largest // _KEYS_PER_BLOCK)).cast("long")
        words = [word.alias(f"word_{n}") for n, word in enumerate(self._probes(key))]
        keyed = fresh.select("bucket", self._block(key, blocks).alias("block"), *words)
        bits = keyed.groupBy("bucket", "block").agg(*[F.bit_or(f"word_{n}").alias(f"word_{n}") for n in range(_WORDS)])
        return bits.withColumn("blocks", blocks)

    def _write_filter(self, fresh: DataFrame, generation: int, largest: int) -> None:
        bits = self._bits(fresh, largest).withColumn("generation", F.lit(generation))
        writer = bits.repartition("bucket").write.partitionBy("generation", "bucket").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self._base}/filters")

    def _filters(self, log: list) -> DataFrame:
        paths = [f"{self._base}/filters/generation={g}/bucket={b}" for b, g in sorted(self._current(log).items())]
        words = "".join(f"word_{n} long, " for n in range(_WORDS))
        schema = f"block long, {words}blocks long, generation int, bucket int"
        return self._spark.read.schema(schema).option("basePath", f"{self._base}/filters").parquet(*paths).drop("generation")

    def possibly_known(self, rows: DataFrame) -> DataFrame:
        """`rows` with `_maybe`: false only where the key is surely not stored."""
        log = self._log()
        if not self._current(log):
            return rows.withColumn("_maybe", F.lit(False))
        if not self._filtered:
            return rows.withColumn("_maybe", F.lit(True))
        filters = self._filters(log)
        sizes = filters.groupBy("bucket").agg(F.max("blocks").alias("_blocks")).withColumnRenamed("bucket", "_bucket")
        asked = rows.withColumn("_bucket", self.bucket()).join(sizes, "_bucket", "left")
        asked = asked.withColumn("_block", self._block(F.col(self.key), F.col("_blocks")))
        words = [f"word_{n}" for n in range(_WORDS)]
        held = filters.select(F.col("bucket").alias("_bucket"), F.col("block").alias("_block"), F.struct(*words).alias("_words"))
        has = [F.col("_words")[name].bitwiseAND(bits) == bits for name, bits in zip(words, self._probes(F.col(self.key)), strict=True)]
        # Blocks that an earlier form of the filter stored have no words: they rule out nothing.
        maybe = F.col("_words").isNotNull() & F.coalesce(reduce(Column.__and__, has), F.lit(True))
        return asked.join(held, ["_bucket", "_block"], "left").withColumn("_maybe", maybe).drop("_bucket", "_block", "_blocks", "_words")

    def unknown(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored, exact.

        The rows are written once. Stored keys are read only in the buckets of rows that the
        filters cannot rule out, and only the matching ones go on.
        """
        judged = _stored(self.possibly_known(rows), "judged")
        doubtful = _stored(judged.where("_maybe").select(F.col(self.key).alias("_doubtful")).distinct(), "doubtful")
        stored = self.read(self.touched(doubtful, "_doubtful"))
        new = judged.where(~F.col("_maybe")).drop("_maybe")
        if stored is None:
            return new
        keys = stored.select(F.col(self.key).alias("_stored"))
        known = keys.join(doubtful, F.col("_stored").eqNullSafe(F.col("_doubtful")), "left_semi").distinct()
        rest = judged.where("_maybe").drop("_maybe").join(known, F.col(self.key).eqNullSafe(F.col("_stored")), "left_anti")
        return reduce(DataFrame.unionByName, [new, rest])
