"""Robust multivariate outliers among document statistics (operator 10), DataFrame functions only.

Per language and source the centre and scatter of a transformed statistic vector (word
length, symbols, capitals, repeated lines, repeated words) are estimated by minimum covariance determinant: from three robust scatters around the
coordinate-wise medians, concentration steps keep the half of the rows nearest to the last
estimate and take their mean and covariance again, until the determinant falls no more. The
start with the least determinant counts; its estimate is taken once more from all rows
within the 0.975 quantile. Rows whose squared Mahalanobis distance exceeds a chi-square
quantile are rejected, after the base rules (too short, too repetitive) have rejected theirs.

The texts are read once; statistics go to the shared folder, and every step is one
or two pre-aggregated passes over those narrow rows. A group holds per start one small row of
sums and one quantile sketch, however many rows it has, so a source with a third of all rows is
no hot spot. Groups below `least_rows` are estimated together per language, and
what is still too small, together. Variances have a floor per statistic: where nearly
all rows agree (no symbols at all), a small deviation does not make an outlier.

Defined cases: null and empty texts have no words and fail the base rules; null languages and
sources are groups of their own; repeated rows are judged each; ties in distance are judged alike; an
empty table gives no rows; carried columns lie in a struct, so their names clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.textkit import WORD
from jobloom.sources.storage import shared_folder

LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
KEPT_SHARE = 0.5  # of a group's rows that a concentration step keeps: nearly half may be off
LEAST_FALL = 1e-6  # of a determinant's logarithm; below, it has settled
TRUSTED = 0.975  # share of Gaussian rows that the last estimate takes in
TAIL = 1e-7  # chance that a Gaussian row is rejected
LEAST_ROWS = 60
FLOORS = {"length": 0.04, "symbols": 0.05, "capitals": 0.04, "same_lines": 0.03, "same_words": 0.014}  # least standard deviations
VECTOR = tuple(FLOORS)


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function."""
    term = total = 1.0 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a))) if x > 0 else 0.0


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _gamma_share(freedom / 2, middle / 2) < share else (low, middle)
    return high


def _repeat_words(rows: DataFrame, window: int) -> DataFrame:
    """Adds n_repeat_words: words in windows that the text holds twice or more, the first included."""
    spots = F.sequence(F.lit(1), F.size("words") - (window - 1))
    marks = F.when(F.size("words") >= window, F.transform(spots, lambda i: F.xxhash64(F.slice("words", i, window))))
    rows = rows.withColumn("marks", marks)
    repeats = F.size(F.array_distinct("marks")) < F.size("marks")
    placed = F.array_sort(F.transform("marks", lambda mark, i: F.struct(mark.alias("mark"), i.alias("at"))))
    rows = rows.withColumn("placed", F.when(repeats, placed)).withColumn("n_marks", F.size("marks"))

    def again(spot: Column, j: Column) -> Column:
        before, after = F.get("placed", j - 1)["mark"], F.get("placed", j + 1)["mark"]
        return F.coalesce(before == spot["mark"], F.lit(False)) | F.coalesce(after == spot["mark"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("placed", again), lambda spot: spot["at"]))

    def cover(so_far: Column, at: Column) -> Column:
        end = at + window
        return F.struct((so_far["words"] + end - F.greatest(at, so_far["end"])).alias("words"), end.alias("end"))

    covered = F.aggregate(starts, F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")), cover, lambda last: last["words"])
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def statistics(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row the counted statistics, base_failed and the transformed vector."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(F.col(key).alias("doc_id"), *[F.col(name) for name in carry if name != key]).alias("row"),
        F.col(lang).alias("lang"), F.col(source).alias("source"), content.alias("content"), F.xxhash64(F.col(text)).alias("mark"),
    ).withColumn("words", F.regexp_extract_all("content", F.lit(f"({WORD})"), F.lit(1)))
    lines = F.filter(F.split("content", "\n"), lambda line: line.rlike(WORD))
    rows = rows.select(
        "row", "lang", "source", "mark", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("content", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("content", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("content", r"[^A-Z!]+", "")).alias("n_capitals"),
        lines.alias("lines"),
    )
    rows = _repeat_words(rows, REPEAT_WINDOW)
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    # Short texts scatter more: their deviation from a common middle counts less.
    trust = F.sqrt(words / (words + 60.0))
    return rows.select(
        "row", "lang", "source", "mark", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        (trust * F.log(chars / words / 5.0)).alias("length"),
        (trust * F.log1p(F.col("n_symbols") / words)).alias("symbols"),
        (trust * F.log1p(4.0 * F.col("n_capitals") / chars)).alias("capitals"),
        # One line said twice in a short text is usual; the added lines and words make its share small.
        (trust * F.log1p(F.col("n_dup_lines") / (F.size("lines") + 8.0))).alias("same_lines"),
        (trust * F.log1p(F.col("n_repeat_words") / (words + 200.0))).alias("same_words"),
    )


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.group").eqNullSafe(F.col(f"{right}.group"))


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """Adds `group`: language and source, or the language, or nothing, whichever has rows enough."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = F.col("n") >= least
    pooled = sizes.where(~own).groupBy("lang").agg(F.sum("n").alias("m"))
    named = (
        sizes.alias("s").join(pooled.alias("p"), F.col("s.lang").eqNullSafe(F.col("p.lang")), "left")
        .select(
            F.col("s.lang").alias("of_lang"), F.col("s.source").alias("of_source"),
            F.when(own, F.struct(F.lit(2).alias("level"), F.col("s.lang").alias("lang"), F.col("s.source").alias("source")))
            .when(F.col("m") >= least, F.struct(F.lit(1).alias("level"), F.col("s.lang").alias("lang"), F.lit(None).cast("string").alias("source")))
            .otherwise(F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")))
            .alias("group"),
        )
    )
    match = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    return rows.join(named, match).drop("of_lang", "of_source").withColumn("group", F.to_json("group"))


def _held(rows: DataFrame) -> list[str]:
    """The statistics among the columns, in the order of m0.., v00.. ."""
    return [name for name in FLOORS if name in rows.columns]


def _pairs(size: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(size), 2))


def _inverse(moments: DataFrame, keys: list[str], names: list[str], scale: float) -> DataFrame:
    """From mean m0.. and covariance c00..: the inverse v00.. of the floored, scaled covariance, and log_det of the latter.

    By Cholesky factor l and its inverse w, a column of the matrix per projection.
    """
    size = range(len(names))
    least = [FLOORS[name] ** 2 for name in names]
    rows = moments
    for j in size:
        # With the floors added, no pivot is below its floor but for rounding.
        pivot = F.col(f"c{j}{j}") * scale + least[j] - sum((F.pow(F.col(f"l{j}{k}"), 2) for k in range(j)), F.lit(0.0))
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(pivot, F.lit(least[j]))))
        below = {
            f"l{i}{j}": (F.col(f"c{j}{i}") * scale - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
            for i in size if i > j
        }
        rows = rows.withColumns(below) if below else rows
    for i in size:
        row = {f"w{i}{j}": -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}") for j in range(i)}
        rows = rows.withColumns(row | {f"w{i}{i}": 1.0 / F.col(f"l{i}{i}")})
    inverse = [sum((F.col(f"w{k}{i}") * F.col(f"w{k}{j}") for k in size if k >= j), F.lit(0.0)).alias(f"v{i}{j}") for i, j in _pairs(len(names))]
    log_det = sum((2 * F.log(F.col(f"l{j}{j}")) for j in size), F.lit(0.0)).alias("log_det")
    return rows.select(*keys, *[f"m{i}" for i in size], *inverse, log_det)


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance under the joined estimate."""
    d = [F.col(name) - F.col(f"m{i}") for i, name in enumerate(names)]
    return sum((F.col(f"v{i}{j}") * d[i] * d[j] * (1 if i == j else 2) for i, j in _pairs(len(names))), F.lit(0.0))


def _measured(rows: DataFrame, estimate: DataFrame, names: list[str], *more: str) -> DataFrame:
    return rows.alias("r").join(estimate.alias("e"), _same("r", "e")).select("r.*", *more, _distance(names).alias("distance"))


def _moments(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    columns = [F.avg(name).alias(f"m{i}") for i, name in enumerate(names)]
    columns += [F.covar_pop(names[i], names[j]).alias(f"c{i}{j}") for i, j in _pairs(len(names))]
    return rows.groupBy(*keys).agg(*columns)


def _written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "mcd")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _scale(share: float, freedom: int) -> float:
    """Of a Gaussian's covariance among the nearest `share` of its rows to the whole one."""
    return share / _gamma_share((freedom + 2) / 2, chi_square_quantile(share, freedom) / 2)


def _starts(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per group three robust estimates around the coordinate-wise medians, scaled by the median deviations:
    without correlation (0), with that of the scaled deviations' tanh (1), with that of their directions (2)."""
    size, pairs = range(len(names)), _pairs(len(names))
    middles = _written(rows.groupBy("group").agg(*[F.percentile_approx(name, 0.5).alias(f"m{i}") for i, name in enumerate(names)]))
    spreads = (
        rows.alias("r").join(middles.alias("e"), _same("r", "e"))
        .groupBy(F.col("r.group").alias("group"))
        .agg(
            *[F.first(f"m{i}").alias(f"m{i}") for i in size],
            *[(1.4826 * F.percentile_approx(F.abs(F.col(name) - F.col(f"m{i}")), 0.5)).alias(f"s{i}") for i, name in enumerate(names)],
        )
    )
    spreads = _written(spreads)
    z = [(F.col(name) - F.col(f"m{i}")) / F.sqrt(F.pow(F.col(f"s{i}"), 2) + FLOORS[name] ** 2) for i, name in enumerate(names)]
    scaled = rows.alias("r").join(spreads.alias("e"), _same("r", "e")).select(F.col("r.group").alias("group"), *[x.alias(f"z{i}") for i, x in enumerate(z)])
    norm = F.greatest(sum((F.pow(F.col(f"z{i}"), 2) for i in size), F.lit(0.0)), F.lit(1e-12))
    products = scaled.groupBy("group").agg(
        *[F.avg(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"t{i}{j}") for i, j in pairs],
        *[F.avg(F.col(f"z{i}") * F.col(f"z{j}") / norm).alias(f"d{i}{j}") for i, j in pairs],
    )

    def correlation(kind: str, i: int, j: int) -> Column:
        both = F.sqrt(F.col(f"{kind}{i}{i}") * F.col(f"{kind}{j}{j}"))
        return F.when(both > 0, F.col(f"{kind}{i}{j}") / both).otherwise(0.0)

    def start(number: int, of: Callable[[int, int], Column]) -> Column:
        scatter = [(F.col(f"s{i}") * F.col(f"s{j}") * (1.0 if i == j else of(i, j))).alias(f"c{i}{j}") for i, j in pairs]
        return F.struct(F.lit(number).alias("start"), *[F.col(f"m{i}") for i in size], *scatter)

    each = [start(0, lambda i, j: F.lit(0.0)), start(1, lambda i, j: correlation("t", i, j)), start(2, lambda i, j: correlation("d", i, j))]
    return products.join(spreads, "group").select("group", F.explode(F.array(*each)).alias("at")).select("group", "at.*")


def estimate(rows: DataFrame, steps: int | None = None, share: float = KEPT_SHARE) -> DataFrame:
    """Per group the robust centre m0.. and inverse scatter v00.., from rows with `group` and statistics.

    From each start, concentration steps go on until the determinant falls no more (or for `steps`
    of them); the least determinant of a group is kept and reweighted once. Every step's
    estimates, a row per group and start, are written to the shared folder; a pass joins
    only those that still fall.
    """
    names = _held(rows)
    keys, found = ["group", "start"], [f"m{i}" for i in range(len(names))] + [f"v{i}{j}" for i, j in _pairs(len(names))] + ["log_det"]
    now = _inverse(_starts(rows, names), keys, names, 1.0)
    now = _written(now.withColumns({"log_det": F.lit(math.inf), "falls": F.lit(True)}))
    done = 0
    while (steps is None or done < steps) and not now.where("falls").isEmpty():
        falling = now.where("falls")
        limits = _measured(rows, falling, names, "start").groupBy(*keys).agg(F.percentile_approx("distance", share).alias("limit"))
        limits = _written(falling.join(limits, keys))
        near = _measured(rows, limits, names, "start", "limit").where(F.col("distance") <= F.col("limit"))
        then = _inverse(_moments(near, keys, names), keys, names, _scale(share, len(names)))
        pair = now.alias("now").join(then.alias("then"), keys, "left")
        fell = F.coalesce(F.col("then.log_det") < F.col("now.log_det") - LEAST_FALL, F.lit(False))
        now = _written(pair.select(*keys, *[F.when(fell, F.col(f"then.{x}")).otherwise(F.col(f"now.{x}")).alias(x) for x in found], fell.alias("falls")))
        done += 1
    best = now.groupBy("group").agg(F.min_by(F.struct(*found), F.struct("log_det", "start")).alias("best")).select("group", "best.*")
    trusted = _measured(rows, _written(best), names).where(F.col("distance") <= chi_square_quantile(TRUSTED, len(names)))
    return _written(_inverse(_moments(trusted, ["group"], names), ["group"], names, _scale(TRUSTED, len(names))))


def judge(docs: DataFrame, tail: float = TAIL, least_rows: int = LEAST_ROWS, carry: tuple[str, ...] = (), **columns: str) -> DataFrame:
    """doc_id, the statistics, base_failed, distance, kept, and a struct `row` of the carried columns."""
    spark = docs.sparkSession
    path = shared_folder(spark, "statistics")
    statistics(docs, carry=carry, **columns).write.parquet(path)
    rows = _groups(spark.read.parquet(path), least_rows)
    sound = _written(rows.where(~F.col("base_failed")).select("group", *VECTOR))
    found = estimate(sound)
    limit = chi_square_quantile(1 - tail, len(VECTOR))
    judged = rows.alias("r").join(found.alias("e"), _same("r", "e"), "left")
    return judged.withColumn("distance", _distance(list(VECTOR))).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= limit)).alias("kept"), "row",
        "lang", "source", "mark",
    )


def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The documents that the rules keep, with all their columns as they are.

    The verdict depends on a document's text, language and source alone, so the rejected ones
    are taken out by these; no text is stored on the way.
    """
    rejected = (
        judge(docs, text=text, lang=lang, source=source, key=key, **options)
        .where(~F.col("kept")).select("doc_id", "lang", "source", "mark").distinct()
    )
    whole = docs.select(F.struct("*").alias("whole"), F.xxhash64(F.col(text)).alias("own_mark"))
    same = (
        (F.col("own_mark") == F.col("mark")) & F.col("whole")[key].eqNullSafe(F.col("doc_id"))
        & F.col("whole")[lang].eqNullSafe(F.col("lang")) & F.col("whole")[source].eqNullSafe(F.col("source"))
    )
    return whole.join(rejected, same, "left_anti").select("whole.*")
