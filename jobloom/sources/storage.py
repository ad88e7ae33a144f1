"""Files and tables of the raw and clean layer, and versioned warehouse tables."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom import schemas

# Quotes doubled inside quotes, blanks kept: text survives the round trip.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below `spark.checkpoint.dir`.

    Only a local master may do without: there a folder of this machine is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="jobloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def open_if_present(reader) -> DataFrame | None:
    """The frame, or None where nothing lies at the path."""
    try:
        return reader()
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _texts(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def read_csv(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """Header CSV with every column as text; quoted line breaks are allowed.

    An empty field is null and a quoted empty field is the empty text: the mark
    for null is set to a sign no text holds, or the reader would merge the two.
    Files written with `one_line` hold a row per line, so large ones are split;
    any others are read one file per task.
    """
    found = spark.read.options(**_CSV, multiLine=not one_line, inferSchema=False, nullValue="\0").csv(path)
    if one_line:
        plain = {}
        for name in _texts(found):
            # A doubled backslash is set aside first, or `\\\\n` would read as a break.
            text = F.replace(name, F.lit("\\\\"), F.lit("\0"))
            for mark, sign in (("\\n", "\n"), ("\\r", "\r"), ("\0", "\\")):
                text = F.replace(text, F.lit(mark), F.lit(sign))
            plain[name] = text
        found = found.withColumns(plain)
    return found


def write_csv(df: DataFrame, path: str, one_line: bool = False) -> None:
    """Header CSV; with `one_line`, line breaks and backslashes in texts are written as escapes."""
    if one_line:
        escaped = {}
        for name in _texts(df):
            text = F.col(name)
            for sign, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
                text = F.replace(text, F.lit(sign), F.lit(mark))
            escaped[name] = text
        df = df.withColumns(escaped)
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_raw(raw: DataFrame, base: str, payload: DataFrame | None = None) -> None:
    """Raw postings as Parquet and CSV, and the landed objects as JSON.

    CSV (a row per line, so that large files are split) and JSON, if no payload is given,
    are copied from the stored Parquet, so the plan behind `raw` runs once.
    """
    spark = raw.sparkSession
    raw.write.mode("overwrite").parquet(f"{base}/parquet")
    stored = spark.read.parquet(f"{base}/parquet")
    write_csv(stored, f"{base}/csv", one_line=True)
    (stored if payload is None else payload).write.mode("overwrite").json(f"{base}/json")


def read_raw(spark: SparkSession, parquet: str | None, csv: str | None = None, one_line: bool = True) -> DataFrame:
    """Parquet if present, else CSV, else an empty frame; cleaning inputs always exist.

    The CSV is one that `write_raw` wrote; for others, whose quoted texts hold line breaks, `one_line` is False.
    """
    found = open_if_present(lambda: spark.read.parquet(parquet)) if parquet else None
    if found is None and csv:
        found = open_if_present(lambda: read_csv(spark, csv, one_line))
    if found is None:
        found = spark.createDataFrame([], "job_id string")
    return ensure_columns(found, schemas.CLEANING_INPUTS)


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    absent = {name: F.lit("") for name in names if name not in df.columns}
    return df.withColumns(absent) if absent else df


def order_columns(df: DataFrame, order: list[str] = schemas.CLEAN_COLUMNS) -> DataFrame:
    """Known columns in the given order, all others behind them."""
    known = [name for name in order if name in df.columns]
    return df.select(*known, *[name for name in df.columns if name not in order])


# Partition column of stored clean postings: year * 100 + month of the posting date.
MONTH = "posted_month"


def month_number(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def write_by_month(postings: DataFrame, path: str) -> None:
    """Postings in a folder per month, in order of location within its files, replacing what was there.

    Date bounds then choose folders, and locations row groups. A month is dealt over all tasks by a hash of the key,
    so one that holds a third of all rows is no task of its own, and the plan behind the postings runs once.
    """
    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [name for name in ("location", "job_id") if name in postings.columns]
    laid = postings.withColumn(MONTH, month_number(F.col("posted_date").try_cast("date")))
    dealt = F.pmod(F.xxhash64(*[F.col(name) for name in keys[-1:]]), F.lit(parts)) if keys else F.lit(0)
    laid = laid.repartition(MONTH, dealt).sortWithinPartitions(MONTH, *keys)
    laid.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def write_clean(clean: DataFrame, base: str) -> None:
    """Clean postings as Parquet (by month) and CSV, replacing what was there."""
    write_by_month(clean, f"{base}/parquet")
    write_csv(clean.sparkSession.read.parquet(f"{base}/parquet").drop(MONTH), f"{base}/csv")


def read_clean(
    spark: SparkSession,
    parquet: str | None,
    csv: str | None = None,
    jdbc: dict[str, str] | None = None,
    required: bool = False,
    keep_month: bool = False,
) -> DataFrame:
    """Parquet, else CSV, else a database table (`jdbc` reader options), else empty.

    With `required`, finding nothing is an error. With `keep_month`, postings that are stored by month
    keep that column, by which `filter_postings` chooses folders. CSV columns arrive as text; known ones are cast to the clean schema. To read
    a large database table in parallel, give `partitionColumn` and its bounds.
    """
    found = open_if_present(lambda: spark.read.parquet(parquet)) if parquet else None
    if found is None and csv:
        found = open_if_present(lambda: read_csv(spark, csv))
        if found is not None:
            kinds = {field.name: field.dataType for field in schemas.CLEAN}
            found = found.select(
                *[
                    F.col(name).try_cast(kinds[name]).alias(name) if name in kinds else F.col(name)
                    for name in found.columns
                ]
            )
    if found is None and jdbc:
        found = spark.read.format("jdbc").options(**jdbc).load()
    if found is None and required:
        raise FileNotFoundError(f"no table at {parquet or csv}")
    if found is None:
        return spark.createDataFrame([], schemas.CLEAN)
    return found if keep_month else found.drop(MONTH)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of another, which stays beside it until the new one is there.

    Both lie in one file system. If the second step fails, the first is undone; if the driver is lost
    between them, the old folder still lies at `path` + `.replaced`.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, old, aside = (hadoop(name.rstrip("/")) for name in (fresh, path, path.rstrip("/") + ".replaced"))
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(aside):
        raise FileExistsError(f"{aside} is left from a replacement that was cut off: put it back or remove it")
    if not files.exists(new):
        raise FileNotFoundError(fresh)
    there, done = files.exists(old), False
    if there and not files.rename(old, aside):
        raise OSError(f"{path} cannot be moved")
    try:
        done = files.rename(new, old)
    finally:
        if there and not done:
            files.rename(aside, old)
    if not done:
        raise OSError(f"{fresh} cannot be moved to {path}")
    if there:
        files.delete(aside, True)


class Snapshot:
    """One loaded copy kept for many queries, dropped on request or when too old."""

    def __init__(self, load, ttl_seconds: float | None = None):
        self._load, self._ttl = load, ttl_seconds
        self._frame: DataFrame | None = None
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        if self._frame is not None and self._ttl and time.monotonic() - self._loaded_at > self._ttl:
            self.reload()
        if self._frame is None:
            self._frame = self._load().persist(StorageLevel.MEMORY_AND_DISK)
            self._loaded_at = time.monotonic()
        return self._frame

    def reload(self) -> None:
        if self._frame is not None:
            self._frame.unpersist()
        self._frame = None


class VersionedTable:
    """A Parquet table replaced as a whole: new version folder first, pointer second.

    Readers keep the version they opened, a failed write leaves the pointer
    alone, and no plan overwrites what it reads. There is one writer at a time; a
    second one is noticed before the pointer moves.
    """

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base.rstrip("/")

    def _pointer(self) -> tuple[int, str] | None:
        if not exists(self._spark, f"{self._base}/_pointer_log"):
            return None
        log = self._spark.read.schema("version int, path string").parquet(f"{self._base}/_pointer_log")
        newest = log.agg(F.max(F.struct("version", "path")).alias("at")).first()["at"]
        return (newest["version"], newest["path"]) if newest else None

    def read(self) -> DataFrame | None:
        at = self._pointer()
        return self._spark.read.parquet(at[1]) if at else None

    def write(self, df: DataFrame) -> DataFrame:
        """Store `df` (which may read the current version) and move the pointer to it."""
        at = self._pointer()
        version = at[0] + 1 if at else 1
        path = f"{self._base}/version={version}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if self._pointer() != at:
            raise RuntimeError(f"another writer changed {self._base} meanwhile")
        entry = self._spark.range(1).select(F.lit(version).alias("version"), F.lit(path).alias("path"))
        entry.write.mode("append").parquet(f"{self._base}/_pointer_log")
        return self._spark.read.parquet(path)
