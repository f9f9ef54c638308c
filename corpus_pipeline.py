"""A training corpus from documents, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again.
Stages read the columns of documents; whatever else their input holds, under
whatever name, is left out. Null and empty texts pass as empty ones (equal to
each other, so one of them stays), repeated rows are copies, texts of any length
are used whole, and an empty table gives an empty result.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.common import folder, folders, free, table
from assayline.llm.exact_dedup import exact_dedup
from assayline.llm.mixing import mix
from assayline.llm.near_dedup import keep_one_of_near
from assayline.llm.packing import pack
from assayline.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not find toxic."""
    judged = toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return judged.filter("predicted = 0").select(*COLUMNS)


def exact_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group of equal texts that stays."""
    judged = exact_dedup(docs.select(*COLUMNS), keep_columns=COLUMNS[1:])
    return judged.filter("kept").select(*COLUMNS)


def near_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return keep_one_of_near(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    taken = mix(docs.select(*COLUMNS), keep_columns=("text", "lang", "n_chars")).filter("copies > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.withColumn("__copy", each).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of tokens."""
    return pack(docs.select(*COLUMNS), with_ids=False).drop("ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("exact dedup", exact_out),
    ("near dedup", near_out),
    ("mixing", mixed),
    ("packing", packed),
]

# A fitted tagger, sketches and a tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's input and the tables it staged
    are deleted when its result is written, the last result when the driver
    ends."""
    docs = table(spark, sf_dir, "documents")
    before: set[str] = set()
    for _, stage in STAGES:
        known = folders()
        made = stage(spark, docs, sf_dir)
        kept = folder(spark, "pipeline")
        made.write.parquet(kept)
        docs = spark.read.schema(made.schema).parquet(kept)
        free((folders() - known - {kept}) | before)
        before = {kept}
    return docs
