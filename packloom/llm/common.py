"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (local mode alone)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is to name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="packloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df computed once and its lineage cut, in the shared folder; meant for narrow rows."""
    shared_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint()


#: Rows that a Python worker is sent at once where rows are wide, so that JVM and Python hold a few MB of them each.
FEW_ROWS = "1000"
_SMALL = {"spark.sql.execution.arrow.maxRecordsPerBatch": FEW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile hands rows to Python in batches of few rows and about 2 MB."""
    before = {k: spark.conf.get(k) for k in _SMALL}
    try:
        for k, v in _SMALL.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder; it goes with `forget`, else when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    atexit.register(_drop, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing reads any more."""
    for df in tables:
        _drop(df.sparkSession, df.scratch_path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone; the folder is scratch
        pass


def fresh(docs: DataFrame, name: str) -> str:
    """name, or the first of name_, name__, ... that docs has no column of (in either case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Type of the column that `identified` adds.
KEY = "struct<file:bigint,at:bigint>"


def identified(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with one column more that tells its rows apart, however often they are read, and that column's name.

    Rows of files are known by a digest of the file's path (a million files share one with probability 3e-8) and the
    place there. Where docs isn't read from files, it is written once.
    """
    name = fresh(docs, "row_key")
    key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.select("*", key.alias(name)), name
    except AnalysisException:
        return written(docs.select("*", F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at")).alias(name)), "identified"), name


#: Sides of a join of up to so many narrow rows, counted first, are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows; count it only where it is cheap (a cut table)."""
    return F.broadcast(df) if df.count() <= most else df


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(keyed: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows of an identified table whose key isn't in gone (file, at)."""
    gone = written(gone, "gone")
    same = (keyed[key]["file"] == gone["file"]) & (keyed[key]["at"] == gone["at"])
    return keyed.join(sized(gone), same, "left_anti")
