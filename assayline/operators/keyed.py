from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _orderable(df: DataFrame, skip: set[str]) -> list[Column]:
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return [
        F.col(f"`{c}`").asc_nulls_first()
        for c in df.columns
        if c not in skip and kinds[c] not in ("map", "variant")
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``order_by`` (nulls last; a Column brings its
    own direction), ties settled by ``tie_break`` ascending, by default every
    other column, so the choice does not depend on how the rows are laid out.

    ``row_number() = 1`` is planned as a group limit before the shuffle, so a
    map task sends one row per key however many copies the key has.
    """
    used = {*keys, *[c for c in order_by if isinstance(c, str)]}
    ties = (
        _orderable(df, used)
        if tie_break is None
        else [F.col(c).asc_nulls_first() for c in tie_break]
    )
    order = [
        F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by
    ] + ties
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the smallest by ``tie_break`` (default: all columns)."""
    ties = [c for c in df.columns if c not in set(keys)] if tie_break is None else tie_break
    if not ties:
        return df.distinct()
    return latest_per_key(df, keys, order_by=(), tie_break=tie_break)
