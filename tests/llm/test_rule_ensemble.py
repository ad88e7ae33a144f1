import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import rule_ensemble as re


def held(name="doc_id"):
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 3 == 1, F.lit(False))


def test_rules_find_an_interaction():
    random = np.random.default_rng(0)
    x = random.random((3000, len(re.STATISTICS)))
    y = ((x[:, 1] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    y[:30] = 1 - y[:30]
    model = re.fit(x[:2000], y[:2000])
    margin = model.base + sum(w * re._held(r, x) for r, w in zip(model.rules, model.weights, strict=True))
    assert ((margin[2000:] > 0) == y[2000:]).mean() > 0.95
    assert any(len(r) > 1 for r in model.rules)


def test_expression_equals_the_model(spark):
    random = np.random.default_rng(1)
    x = random.random((200, len(re.STATISTICS)))
    model = re.fit(x, (x[:, 0] > x[:, 2]).astype(float))
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in re.STATISTICS))
    got = [r[0] for r in rows.select(model.score()).collect()]
    margin = model.base + sum(w * re._held(r, x) for r, w in zip(model.rules, model.weights, strict=True))
    assert got == pytest.approx(list(1 / (1 + np.exp(-margin))))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = re.classify(docs, labels, ~held()).join(labels, "doc_id").where(held()).collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    # Labels of held-out rows make no difference.
    turned = labels.withColumn("quality", F.when(held(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {(r.doc_id, r.score) for r in re.classify(docs, turned, ~held()).select("doc_id", "score").collect()}
    assert {(r.doc_id, r.score) for r in rows} <= again


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, None), (4, 7, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("quality = 1"), labels.limit(0)):
        rows = re.classify(odd_docs, some, ~held()).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert re.classify(no_docs, labels, ~held()).collect() == []
