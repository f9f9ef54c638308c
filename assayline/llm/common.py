"""Helpers of the corpus operators: text rules, tables, intermediate tables."""

import atexit
import ctypes
import gc
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.sources.staging import delete_folder, staging_root

# What separates words, and what a word is.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_folders: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def crc_part(column: str, parts: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; a null id counts as
    empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def refuse_clash(kept: tuple[str, ...], made: tuple[str, ...]) -> None:
    """Columns that are carried to a result can't have the names of its own."""
    both = sorted(set(kept) & set(made))
    if both:
        raise ValueError(f"columns of the result can't be carried: {both}")


def sampled(df: DataFrame, column: str, most: int, total: int) -> DataFrame:
    """At most ``most`` of the ``total`` rows, those with the smallest hashes of
    ``column``. A share of the hashes is cut off first that leaves half as many
    rows again, so the sort and the limit see a bounded number of rows however
    many tasks there are."""
    steps = 1 << 30
    place = F.pmod(F.xxhash64(column), F.lit(steps))
    share = min(steps, int(1.5 * steps * (most + 100) / max(1, total)))
    return df.filter(place < share).orderBy(place, column).limit(most)


def give_back() -> None:
    """Return freed memory of this process to the system, where the C library
    can. What a fit freed would else count as the driver's until it ends."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one; it goes when the driver ends."""
    path = f"{staging_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    _folders[path] = spark
    return path


def stage(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. A lost executor
    then costs a re-read, and later joins know the real size. The folder goes
    when the driver ends; a result that is still read needs it until then.
    ``by`` are columns whose values get folders of their own."""
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folders() -> set[str]:
    """The folders that are to be deleted."""
    return set(_folders)


def free(paths: set[str]) -> None:
    """Delete such folders now; nothing may read them any more."""
    for path in paths:
        spark = _folders.pop(path, None)
        if spark is not None:
            delete_folder(spark, path)


@atexit.register
def _clean() -> None:
    for path in folders():
        try:
            free({path})
        except Exception:  # noqa: BLE001  the session has ended: nothing can be reached
            return
