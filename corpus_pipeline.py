"""From raw documents to packed training sequences: five operators in a row.

Each stage gets its predecessor's rows, read again from Parquet. All but the last return
the columns of documents.

1. Documents that the quality rules reject go.
2. Of each group of near duplicates one document stays, the one with the least id.
3. Words in passages that still occur more than once go; untouched texts keep their form.
4. Sources are mixed to their target weights: a document appears as often as the mix takes it.
5. The texts are packed into sequences.

Defined cases: documents with a null or empty text fail the base rules and go; null languages and sources
are groups of their own; repeated rows and rows that repeat an id are copies, of which one stays; a null id is
an id like any other; texts may be of any length; stages that leave no document give an empty table to the
next one; columns beyond those of documents are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.llm import mixing, near_duplicates, packing, quality_rules, substring_dedup
from jobloom.llm.queries import word_tokenizer
from jobloom.sources.storage import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.join(docs, carry=tuple(docs.columns)).where("first").select("row.*").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(docs, carry=tuple(docs.columns))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs, carry=tuple(docs.columns)).where("copies > 0")
    each = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("row.*").select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicate),
    ("substring_dedup", repeated_passages),
    ("source_mix", source_mix),
    ("packing", sequences),
]

# Robust covariances, hash-drawn samples and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
