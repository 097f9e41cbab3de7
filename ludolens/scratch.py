"""Written intermediate tables, and broadcasts behind a size check.

A table that two parts of a plan must see identically is written once to the
shared folder the cluster names in ``spark.checkpoint.dir``. It survives the
loss of any executor and cuts the lineage before it.
"""

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table marked for broadcast, measured before it is marked.
BROADCAST_BYTES = 64 << 20
# Rows that a step which works in rounds shuffles at a time.
ROUND_ROWS = 16_000_000
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

_own_folder = None
_scopes: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="ludolens-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system Spark knows; none is fine too."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of each query inside when it ends.

    Otherwise they stay until the driver's garbage collector finds the query gone, and a job of
    many steps keeps those of steps long done.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates written inside when the work inside is done.

    Nothing that reads them may be used afterwards. Scopes may be nested. Inside, intermediates
    are compressed well, and the shuffle files of a query go when it ends.
    """
    _scopes.append(uuid.uuid4().hex)
    folder = _application_folder(spark)
    try:
        with dropped_shuffles(spark):
            yield
    finally:
        _scopes.pop()
        delete_path(spark, folder)


def _application_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    return "/".join([scratch_folder(spark).rstrip("/"), "ludolens", app, *_scopes])


def scratch_path(spark: SparkSession) -> str:
    """A new path, not used before, for one intermediate table."""
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written table.

    ``path`` is a :func:`scratch_path` that the caller deletes before its scope ends.
    """
    path = path or scratch_path(df.sparkSession)
    writer = df.write.option("compression", "zstd") if _scopes else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rounds_for(df: DataFrame) -> int:
    """Rounds in which to shuffle the rows of a written table."""
    return max(1, math.ceil(df.count() / ROUND_ROWS))


def in_rounds(items: list, rounds: int) -> list[list]:
    """``items`` cut into at most so many lists of neighbours, none of them empty."""
    rounds = max(1, min(rounds, len(items)))
    return [items[len(items) * i // rounds : len(items) * (i + 1) // rounds] for i in range(rounds)]


def table_bytes(df: DataFrame) -> int:
    """About how much memory the rows of ``df`` take, by counting them."""
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in df.schema.fields):
        return df.count() * 16 * len(df.columns)
    text = F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint")
    return df.agg(F.sum(text + 16 * len(df.columns))).first()[0] or 0


def broadcast_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it measures at most ``max_bytes``.

    A larger side is marked for a merge join: both sides are shuffled and
    adaptive execution splits skewed keys. Unmarked it could still be broadcast, as
    Spark takes the size of its files for that of its rows, and sorted ids
    compress to a byte or less each. Measuring runs ``df``, so pass a written table or a small
    aggregate of one.
    """
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df.hint("merge")
