from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.quantiles import exact_quantiles


def iqr_bounds(
    df: DataFrame, value: str, by: str, k: float = 3.0, accuracy: int | None = None
) -> DataFrame:
    """``(by, low, high)`` per group: quartiles widened by ``k`` times their
    distance. The quartiles are exact and their work splits within a group.
    ``accuracy`` takes Spark's quantile sketch instead, exact for groups of up
    to so many rows: one shuffle less, and a sketch per task and group."""
    if accuracy is None:
        quartiles = exact_quantiles(df, [by], value, [0.25, 0.75])
    else:
        q = F.percentile_approx(value, [0.25, 0.75], accuracy)
        quartiles = df.filter(F.col(value).isNotNull()).groupBy(by).agg(q.alias("q"))
    reach = k * (F.col("q")[1] - F.col("q")[0])
    return quartiles.select(by, (F.col("q")[0] - reach).alias("low"), (F.col("q")[1] + reach).alias("high"))


def flag_iqr_outliers(
    df: DataFrame,
    value: str,
    by: str,
    flag: str = "is_outlier",
    k: float = 3.0,
    accuracy: int | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Every row kept, with ``flag`` true when its value lies strictly outside
    the bounds of its group; no value or no bounds gives false.

    Without ``bounds`` they are part of the plan and AQE takes their size from
    the finished stage: they are broadcast only when small, and otherwise a
    shuffle join is taken, where AQE splits a hot group. Jobs that read ``df``
    again pass stored bounds. Calling it starts no job.
    """
    if bounds is None:
        bounds = iqr_bounds(df, value, by, k, accuracy)
    outside = (F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))
    # Dealt anew, so that AQE may split the partitions of the join.
    limits = bounds.select(F.col(by).alias("__by"), "low", "high").hint("rebalance")
    return (
        df.join(limits, F.col(by) == F.col("__by"), "left")
        .select(*[df[c] for c in df.columns], F.coalesce(outside, F.lit(False)).alias(flag))
    )
