from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions import pct


def null_profile(
    df: DataFrame, columns: Sequence[str], min_non_null: float = 0.95
) -> DataFrame:
    """``(column, n_rows, n_null, pct_null, warn)`` per listed column, one scan;
    columns that do not exist are skipped."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(present)],
    )
    lines = [
        F.struct(F.lit(c).alias("column"), F.col("n_rows"), F.col(f"n{i}").alias("n_null"))
        for i, c in enumerate(present)
    ]
    share = F.coalesce(F.try_divide(100 * F.col("n_null"), F.col("n_rows")), F.lit(0.0))
    return counts.select(F.inline(F.array(*lines))).select(
        "column",
        "n_rows",
        "n_null",
        F.round(share, 1).alias("pct_null"),
        (share > (1 - min_non_null) * 100).alias("warn"),
    )


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per group, in group order."""
    return df.groupBy(*by).agg(F.count("*").alias("count")).orderBy(*by)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null combinations in ascending order."""
    return df.select(*columns).dropna().distinct().orderBy(*columns)


def top_labels(df: DataFrame, label: str, flag: str, k: int = 5) -> DataFrame:
    """The ``k`` labels with most flagged rows, ties by label."""
    return (
        df.filter(F.col(flag))
        .groupBy(label)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col(label).asc_nulls_last())
        .limit(k)
    )


def count_of(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )

