"""What the operators share: the shared folder, written intermediates, skew-proof joins, text bytes."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII capitals to small letters; all other bytes stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: At most this many groups can each hold over 1 / HOT of all rows, so a table of them may be broadcast.
HOT = 1000

#: Bytes of one Arrow batch; holds the memory of a Python worker down when texts are long.
BATCH_BYTES = 8 << 20


#: What ``written`` has made in this process, in order.
_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset an own one is set, in local mode alone (tests); elsewhere executors would each write to their own disk,
    so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, computed once, no executor owns it.

    ``partition``: a column whose values get files of their own."""
    spark = df.sparkSession
    path = scratch(spark, name)
    (df.write if partition is None else df.write.partitionBy(partition)).parquet(path)
    _MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many tables ``written`` has made so far; for ``discard_since``."""
    return len(_MADE)


def discard_since(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Delete the tables made since ``mark``, but for the last ``keep``; what still reads them is lost."""
    end = len(_MADE) - keep
    for path in _MADE[mark:end]:
        _delete(spark, path)
    del _MADE[mark:end]


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches (the default bounds rows only)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key).rstrip("bB"))
    except ValueError:
        now = 0
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def trim_memory() -> None:
    """Give back what this Python worker has freed: workers live on, and their memory counts against the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(run: Callable) -> Callable:
    """A function over a task's batches that gives its memory back at the end."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return inner


def utf8(text: str | Column) -> Column:
    """A text column as UTF-8 bytes, null as none; Python then gets bytes and never decodes what it needn't."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one row per ``key`` of ``groups``, whose column ``size`` counts the rows of that key.

    Keys that hold over 1/1000 of ``total`` are at most 1000, so they are broadcast and their rows stay where they are;
    the others are shuffled.  A key with a third of all rows therefore never meets in one task.  ``how`` is inner or left.
    """
    least = max(1, total // HOT)
    hot = F.broadcast(groups.where(F.col(size) > least))
    cold = groups.where(F.col(size) <= least)
    at_hot = rows.join(hot, key)
    at_cold = rows.join(F.broadcast(groups.where(F.col(size) > least).select(*([key] if isinstance(key, str) else key))), key, "left_anti").join(cold, key, how)
    return at_hot.unionByName(at_cold)


def discard(spark: SparkSession) -> None:
    """Delete what ``written`` and ``scratch`` have left of this application; results that read it are lost with it."""
    _delete(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
