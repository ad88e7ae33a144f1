"""Mixing sources to target weights by weighted sampling without replacement (operator 5).

Each source gets a target of words: its share by weight of all words, at most `epochs`
times its own words, the excess going to the others by weight. As many complete passes over
the source as fit are taken first. The rest is an Efraimidis-Spirakis sample: every
document draws an exponential key divided by its quality weight, the documents of a source
are ordered by key, and the first ones are taken until their words reach the budget;
the document at the edge is taken if that comes nearer to it.

No source is sorted as a whole, and none meets its target in one task. Keys fall into ordered buckets, the words per source and
bucket are summed, and only the bucket in which the budget ends is ordered by row. The
text is read once: what later steps need is written to the shared folder.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a
source of its own and comes last; repeated rows are counted and taken each; rows whose
keys tie are ordered by their number; an empty table gives no rows; carried columns lie in a struct, so
their names clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from jobloom.llm.textkit import WORD
from jobloom.sources.storage import shared_folder

WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 3
BUCKETS = 1024
SALTS = 64


def text_quality(text: Column) -> Column:
    """From 0.1 to 1: the share of the text's characters that are no digits, symbols or capitals, squared."""
    plain = F.length(F.regexp_replace(text, r"[0-9#*$%&|<>=_/\\{}\[\]A-Z]+", ""))
    share = F.when(F.length(text) > 0, plain / F.length(text)).otherwise(1.0)
    return F.greatest(F.lit(0.1), share * share)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target): one row per source in, windows over that small table only.

    Sources in order of limit over weight reach their limit first, so the level at which
    the words left meet the weights left is found with running sums.
    """
    whole = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    cycle = F.array(*[F.lit(w) for w in weights])
    named = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    return (
        named.withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("all", F.sum("source_size").over(whole))
        .withColumn("capped", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.col("capped")) / F.col("open"))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
        .withColumn("final", F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("weight"), "place", "level"))).over(whole)["level"])
        .select("source", "source_size", F.least(F.col("most"), F.col("final") * F.col("weight")).alias("target"))
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS, quality: Column | None = None,
    seed: int = 0, buckets: int = BUCKETS, text: str = "text", key: str = "doc_id", source: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies and a struct `row` of the carried columns."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    draw = F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(content))
    uniform = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    path = shared_folder(spark, "mix")
    docs.select(
        F.struct(F.col(key).alias("doc_id"), *[F.col(name) for name in carry if name != key]).alias("row"),
        F.col(source).alias("source"),
        F.regexp_count(content, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform) / (text_quality(content) if quality is None else quality)).alias("key"),
        F.monotonically_increasing_id().alias("number"),
    ).withColumn(
        "bucket", F.least(F.lit(buckets - 1), F.floor(buckets * (1 - F.exp(-F.col("key"))))).cast("int")
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goal = (
        source_targets(per_bucket.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    up_to = Window.partitionBy("source").orderBy("bucket")
    edge = (
        per_bucket.withColumn("upto", F.sum("words").over(up_to))
        .alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
        .where((F.col("budget") > 0) & (F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("words") < F.col("budget")))
        .select(F.col("b.source").alias("source"), "bucket", (F.col("budget") - F.col("upto") + F.col("words")).alias("left"))
    )
    in_order = Window.partitionBy("source").orderBy("key", "number").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        rows.select("source", "bucket", "size", "key", "number").alias("r")
        .join(edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.bucket") == F.col("e.bucket")))
        .select(F.col("r.source").alias("source"), F.col("r.bucket").alias("bucket"), "size", "key", "number", "left")
        .withColumn("before", F.coalesce(F.sum("size").over(in_order), F.lit(0)))
        .groupBy("source", "bucket")
        .agg(F.max(F.when(F.col("before") + F.col("size") / 2 <= F.col("left"), F.struct("key", "number"))).alias("cut"))
    )
    decided = (
        goal.alias("g").join(last.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")), "left")
        .select(F.col("g.source").alias("of"), "source_size", "target", "passes", F.col("bucket").alias("edge"), "cut")
    )
    # One source may hold a third of all rows: its rows meet copies of its one decision.
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    decided = decided.withColumn("for_salt", F.explode(salts))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int"))
    once_more = (F.col("bucket") < F.col("edge")) | (
        (F.col("bucket") == F.col("edge")) & (F.struct("key", "number") <= F.col("cut"))
    )
    copies = F.when(F.col("size") > 0, F.col("passes") + F.coalesce(once_more, F.lit(False)).cast("long")).otherwise(0)
    return (
        rows.join(decided, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("for_salt")))
        .withColumn("copies", copies.cast("long"))
        .select(
            F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target",
            (F.col("size") * F.col("copies")).alias("taken"), "copies", "row",
        )
    )
