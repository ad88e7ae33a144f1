import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import quality_rules
from tests.llm.brute import words


def base(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    marks = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times, covered = collections.Counter(marks), set()
    for i, mark in enumerate(marks):
        if times[mark] > 1:
            covered |= set(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def counted(rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return collections.Counter((r["doc_id"], *[r[n] for n in names]) for r in rows)


def test_chi_square():
    assert quality_rules.chi_square_quantile(0.95, 3) == pytest.approx(7.814728, abs=1e-5)
    assert quality_rules.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2))


def test_estimate_ignores_a_minority(spark):
    random = np.random.default_rng(3)
    good = random.multivariate_normal([1, 2, 3], [[1, 0.5, 0], [0.5, 2, 0], [0, 0, 0.5]], 4000)
    bad = random.normal(9, 0.3, (200, 3))
    data = [("g", *map(float, x)) for x in np.concatenate([good, bad])]
    frame = spark.createDataFrame(data, "group string, length double, symbols double, capitals double").repartition(4)
    row = quality_rules.estimate(frame, steps=5).first()
    assert [row[f"m{i}"] for i in range(3)] == pytest.approx([1, 2, 3], abs=0.12)
    inverse = np.array([[row[f"v{min(i, j)}{max(i, j)}"] for j in range(3)] for i in range(3)])
    assert np.linalg.inv(inverse) == pytest.approx(np.array([[1, 0.5, 0], [0.5, 2, 0], [0, 0, 0.5]]), abs=0.35)


def test_whole_table_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = quality_rules.judge(docs).collect()
    assert counted(rows) == collections.Counter((d.doc_id, *base(d.text)) for d in docs.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    good, poor = [k for q, k in judged if q], [k for q, k in judged if not q]
    assert all(good) and sum(poor) < 0.2 * len(poor)


def test_plan_has_no_python(spark, odd_docs):
    frame = quality_rules.judge(odd_docs)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = quality_rules.judge(odd_docs, carry=tuple(odd_docs.columns)).collect()
    assert counted(rows) == collections.Counter((r[0], *base(r[1])) for r in odd_rows)
    assert all(r["kept"] in (True, False) and not (r["kept"] and r["base_failed"]) for r in rows)
    same = collections.defaultdict(set)
    for r in rows:
        same[r["doc_id"], r["row"]["text"]].add(r["kept"])
    assert all(len(k) == 1 for k in same.values())
    assert quality_rules.judge(no_docs).collect() == []
    pooled = quality_rules.judge(odd_docs.withColumn("source", F.col("doc_id").cast("string")), least_rows=3)
    assert pooled.count() == len(odd_rows)


@pytest.mark.parametrize("share", [0.3, 0.4])
@pytest.mark.parametrize("far", [1.0, 3.0])
def test_many_outliers_in_one_source(spark, share, far):
    draw = np.random.default_rng(11)
    n, p = 2000, len(quality_rules.VECTOR)
    off = np.arange(n) < share * n
    values = draw.normal(0, 0.05, (n, p)) + np.where(off, far, 0.0)[:, None] * np.eye(p)[1]
    data = [("hot", bool(o), *map(float, x)) for o, x in zip(off, values, strict=True)]
    data += [("calm", False, *map(float, x)) for x in draw.normal(0, 0.05, (500, p))]
    frame = spark.createDataFrame(data, "group string, off boolean, " + ", ".join(f"{name} double" for name in quality_rules.VECTOR))
    found = {row["group"]: row for row in quality_rules.estimate(frame.drop("off").repartition(4)).collect()}
    limit = quality_rules.chi_square_quantile(1 - quality_rules.TAIL, p)
    for group, outlier, *x in data:
        row = found[group]
        d = np.array(x) - [row[f"m{i}"] for i in range(p)]
        inverse = np.array([[row[f"v{min(i, j)}{max(i, j)}"] for j in range(p)] for i in range(p)])
        assert (d @ inverse @ d > limit) == outlier


def test_repeats_below_the_base_rule(spark):
    draw = random.Random(4)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]
    line = lambda n: " ".join(draw.choices(vocabulary, k=n))
    clean = ["\n".join(line(draw.randint(6, 9)) for _ in range(draw.randint(20, 60))) for _ in range(150)]
    short, twice = line(3), line(80)
    lines = "\n".join(f"{short}\n{line(draw.randint(6, 9))}" for _ in range(40))
    words = f"{line(300)} {twice} {line(300)} {twice}"
    rows = [(i, text, "en", "a", 5) for i, text in enumerate([*clean, lines, words])]
    judged = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not any(r["base_failed"] for r in judged.values())
    assert judged[150]["n_dup_lines"] == 39 and judged[151]["n_repeat_words"] == 160
    assert [i for i, r in judged.items() if not r["kept"]] in ([150, 151], [151, 150])
