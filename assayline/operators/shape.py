from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.functions import load_ts


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that ``df`` has, in list order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def with_load_ts(df: DataFrame, name: str, moment: str | None = None) -> DataFrame:
    return df.withColumn(name, load_ts(moment))


def handle_missing(
    df: DataFrame,
    required: Sequence[str],
    fill: Mapping[str, str] | None = None,
    missing_flag: tuple[str, str] | None = None,
) -> DataFrame:
    """Drop rows with a null in ``required``, flag nulls of one column as
    ``missing_flag = (new column, source column)``, fill text defaults."""
    # A conjunction, not na.drop: each part is pushed down as far as it can go.
    kept = df.filter(reduce(and_, [F.col(c).isNotNull() for c in required]))
    if missing_flag:
        kept = kept.withColumn(missing_flag[0], F.col(missing_flag[1]).isNull())
    return kept.na.fill(dict(fill)) if fill else kept


def _code_texts(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(column)
    while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        value, kind = F.flatten(F.filter(value, lambda v: v.isNotNull())), kind.elementType
    if isinstance(kind, T.ArrayType):
        # Elements may themselves be lists written as text ("64,69").
        if isinstance(kind.elementType, T.IntegralType):
            return F.transform(value, _padded)
        return F.flatten(F.transform(value, lambda v: F.split(v, ",")))
    if isinstance(kind, T.IntegralType):
        return F.array(_padded(value))
    return F.split(value, ",")


def _padded(number: Column) -> Column:
    return F.when(number.isNotNull(), F.format_string("%02d", number))


def expand_codes(df: DataFrame, column: str, as_name: str = "code") -> DataFrame:
    """One row per code of a scope column: numbers get two digits at least,
    texts are split at commas and trimmed, empty codes and nulls give no row."""
    texts = F.transform(_code_texts(df, column), lambda v: F.trim(v))
    return df.withColumn(as_name, F.explode(F.filter(texts, lambda v: v != "")))


def nested_to_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed non-text columns as JSON text (null stays null); texts and
    columns that do not exist are left alone."""
    kinds = {f.name: f.dataType for f in df.schema}
    made = {}
    for name in columns:
        kind = kinds.get(name)
        if kind is None or isinstance(kind, T.StringType):
            continue
        nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
        made[name] = F.to_json(name) if nested else F.col(name).cast("string")
    return df.withColumns(made) if made else df
