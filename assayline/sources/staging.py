"""Intermediate tables in the shared folder, so they outlive any executor."""

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whether a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# How many partitions a task writes side by side; beyond them it sorts its rows.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


_made: dict[str, SparkSession] = {}


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a
    temporary folder is taken, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _classic(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="assayline-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def staged_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one; it goes when the driver ends."""
    path = f"{staging_root(spark)}/staged/{label}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back. The result has no lineage to
    recompute, and its size on disk is what the optimizer plans joins with."""
    path = staged_path(df.sparkSession, label)
    with shuffles_end(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run in here are deleted as each ends, and
    not when the driver happens to collect its plan: a job of many writes then
    needs room for one of them. A server that Spark Connect talks to has a
    setting of its own."""
    if not _classic(spark):
        yield
        return
    with _set(spark, CLEANUP, "true", "false"):
        yield


@contextmanager
def files_open(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks that write in here keep a file of ``most`` partitions open, so that
    they needn't sort their rows by partition."""
    with _set(spark, WRITERS, str(most), "0"):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_slices(
    df: DataFrame,
    write: Callable[[DataFrame, str], None],
    slices: int,
    slice_by: Sequence[str],
    mode: str = "overwrite",
) -> None:
    """``write`` the rows of ``df`` with a mode, one slice after the other, the
    later ones appended. Slices are cut by a hash of ``slice_by``: columns that
    the rows are grouped or partitioned by, so that the cut reaches the scan and
    only a slice is shuffled at a time."""
    for k, part in enumerate(cut(df, slices, slice_by)):
        write(part, "append" if k else mode)


def cut(df: DataFrame, slices: int, slice_by: Sequence[str]) -> list[DataFrame]:
    """The rows of ``df`` in parts, cut by a hash of ``slice_by``."""
    if slices < 2:
        return [df]
    place = _place(slice_by, slices)
    return [df.filter(place == k) for k in range(slices)]


def counted_cut(
    df: DataFrame, slices: Callable[[int], int], slice_by: Sequence[str], most: int
) -> list[tuple[DataFrame, int]]:
    """``cut`` with the number of rows of each part, from one query. ``slices``
    tells from the number of all rows in how many parts, ``most`` at most."""
    # A number that each number of parts divides: its places add up to theirs.
    fine = lcm(*range(1, most + 1))
    with shuffles_end(df.sparkSession):
        counts = df.groupBy(_place(slice_by, fine).alias("place")).count().collect()
    n = slices(sum(r["count"] for r in counts))
    return [
        (part, sum(r["count"] for r in counts if r["place"] % n == k))
        for k, part in enumerate(cut(df, n, slice_by))
    ]


def _place(slice_by: Sequence[str], slices: int) -> Column:
    return F.pmod(F.xxhash64(*slice_by), F.lit(slices))


class Staging:
    """Staged tables of a job, deleted when the job is done with them::

        with Staging(spark) as stage:
            clean = stage(df, "clean")
            ...  # write everything that reads ``clean``
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder = staged_path(spark, "job")

    def __call__(
        self, df: DataFrame, label: str, slices: int = 1, slice_by: Sequence[str] = ()
    ) -> DataFrame:
        path = f"{self._folder}/{label}"

        def write(part: DataFrame, mode: str) -> None:
            part.write.mode(mode).parquet(path, compression="zstd")

        with shuffles_end(self._spark):
            write_slices(df, write, slices, slice_by)
        return self.read(df.schema, label)

    def read(self, schema: T.StructType, *labels: str) -> DataFrame:
        """The rows of tables that were staged under these labels."""
        return self._spark.read.schema(schema).parquet(*[f"{self._folder}/{x}" for x in labels])

    def drop(self, label: str) -> None:
        """Delete a table before the job ends; nothing may read it any more."""
        delete_folder(self._spark, f"{self._folder}/{label}")

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        delete_folder(self._spark, self._folder)
        _made.pop(self._folder, None)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in shared storage. A session without a JVM of its own
    (Spark Connect) can't: False is returned and the storage's retention for
    ``staged/`` has to do it."""
    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None) if _classic(spark) else None
    if jvm is None:
        return False
    folder = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(conf).delete(folder, True)


def release(path: str) -> None:
    """Delete a folder of ``staged_path`` now; nothing may read it any more."""
    spark = _made.pop(path, None)
    if spark is not None:
        delete_folder(spark, path)


def _classic(spark: SparkSession) -> bool:
    return hasattr(spark, "_jsparkSession")


@atexit.register
def _clean() -> None:
    for path in list(_made):
        try:
            delete_folder(_made.pop(path), path)
        except Exception:  # noqa: BLE001  the session has ended: nothing can be reached
            return
