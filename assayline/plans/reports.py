"""Counts and profiles of tables and steps, each one pass over its input."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.functions import pct
from assayline.operators.profile import count_of
from assayline.plans.silver import REQUIRED, RESULT_KEY
from assayline.sources import Layout, read_table


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [count_of(df, name) for name, df in tables.items()])


def layer_report(
    spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """Rows per table and a ``TOTAL`` row. A table that cannot be opened is
    listed with its error and does not stop the report."""
    lines = []
    for name, opened in tables.items():
        try:
            line = count_of(opened(), name).withColumn("error", F.lit(None).cast("string"))
        except AnalysisException as problem:
            line = spark.range(1).select(
                F.lit(name).alias("table_name"),
                F.lit(None).cast("long").alias("row_count"),
                F.lit(problem.getCondition() or "unreadable").alias("error"),
            )
        lines.append(line)
    counted = reduce(DataFrame.unionByName, lines)
    return (
        counted.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"), F.max("error").alias("error"),
             F.grouping("table_name").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("table_name")).alias(
                "table_name"
            ),
            "row_count",
            F.when(F.col("is_total") == 0, F.col("error")).alias("error"),
        )
    )


def report_of(
    spark: SparkSession, layout: Layout, layer: str, schemas: Mapping[str, T.StructType]
) -> DataFrame:
    return layer_report(
        spark,
        {
            name: lambda name=name, schema=schema: read_table(spark, layout, layer, name, schema)
            for name, schema in schemas.items()
        },
    )


def typed_metrics(typed: DataFrame, key: Sequence[str] = RESULT_KEY) -> DataFrame:
    """Rows, null dates, null results and surplus copies. Counts are combined per
    key before they are summed, so a key with many copies is one row per task."""
    per_key = typed.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("date_prelevement_ts").isNull()).alias("d"),
        F.count_if(F.col("resultat_parse").isNull()).alias("r"),
    )
    return per_key.agg(
        F.sum("n").alias("n_typed"),
        F.sum("d").alias("n_null_date"),
        F.sum("r").alias("n_null_result"),
        F.sum(F.col("n") - 1).alias("n_duplicates"),
    )


def missing_metrics(results: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows before and after the drop of rows without required values."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return results.agg(
        F.count("*").alias("n_before"),
        F.count_if(complete).alias("n_after"),
        F.count_if(~complete).alias("n_dropped"),
    )


def outlier_metrics(results: DataFrame, flag: str = "_est_outlier") -> DataFrame:
    counts = results.agg(F.count("*").alias("n_rows"), F.count_if(flag).alias("n_outliers"))
    return counts.withColumn("pct_outliers", pct(F.col("n_outliers"), F.col("n_rows")))


def preview(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    return df.select(*columns).limit(n)
