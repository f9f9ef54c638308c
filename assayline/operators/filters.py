from collections.abc import Iterable, Sequence
from operator import eq, ge
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPARE = {"=": eq, ">=": ge}


def apply_filters(df: DataFrame, filters: Iterable[tuple[str, str, Any]]) -> DataFrame:
    """AND of ``(column, "=" or ">=", value)``; a ``None`` value means no filter.
    Values are bound as literals, so they reach the scan as pushed filters."""
    for column, op, value in filters:
        if value is not None:
            df = df.filter(COMPARE[op](F.col(column), F.lit(value)))
    return df


def filter_members(
    df: DataFrame,
    column: str,
    members: Sequence[str] | DataFrame | None,
    available: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``column`` is one of ``members`` (a list, or a one-column
    DataFrame for long ones). With ``available``, members that are not in its
    ``column`` do not count. No member left means no filter.

    The fallback is on the member side: an empty choice is replaced by all
    values of ``column``, so the rows meet the members in a semi join, which
    stops those that don't match early.
    """
    if members is None:
        return df
    if isinstance(members, DataFrame):
        chosen = members.select(F.col(members.columns[0]).alias("__member")).dropna()
        if available is not None:
            offered = available.select(F.col(column).alias("__member"))
            chosen = chosen.join(offered, "__member", "left_semi")
    elif not members:
        return df
    elif available is None:
        return df.filter(F.col(column).isin(list(members)))
    else:
        chosen = available.select(F.col(column).alias("__member")).filter(
            F.col("__member").isin(list(members))
        )
    chosen = chosen.distinct()
    n_chosen = chosen.agg(F.count("*")).scalar()
    everything = df.select(F.col(column).alias("__member")).distinct()
    members_left = chosen.unionByName(everything.filter(n_chosen == 0))
    return df.join(members_left, F.col(column).eqNullSafe(F.col("__member")), "left_semi")
