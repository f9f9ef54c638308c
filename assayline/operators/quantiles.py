"""Exact quantiles whose work splits, however large one group is."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices per power of two of a value, and parts that a slice is cut into.
SLICES = 256
PARTS = 4096
_LEAST, _MOST = -1_000_000, 1_000_000


def slice_of(value: Column) -> Column:
    """Number of a slice of the number line; larger values never have smaller
    numbers. NaN counts as the largest value, as in Spark's ordering."""
    size = F.floor(F.log2(F.abs(value)) * SLICES) + 400_000
    infinite = F.abs(value) == float("inf")
    return (
        F.when(F.isnan(value), F.lit(_MOST + 1))
        .when(infinite & (value > 0), F.lit(_MOST))
        .when(infinite, F.lit(_LEAST))
        .when(value == 0, F.lit(0))
        .when(value > 0, size)
        .otherwise(-size)
        .cast("int")
    )


def _placed(sums: DataFrame, group: Sequence[str], place: str, rank: Column) -> DataFrame:
    """The rows of ``sums`` (``__n`` values a place) in which ``rank`` lies in its
    group, as ``__at``, with the rank inside as ``__rank`` and the least and the
    greatest value there as ``__low``, ``__high``."""
    whole = Window.partitionBy(*group)
    inner = rank - F.col("__upto") + F.col("__n")
    return (
        sums.withColumn("__upto", F.sum("__n").over(whole.orderBy(place)))
        .withColumn("__all", F.sum("__n").over(whole))
        .withColumn("__rank", inner)
        .filter((F.col("__rank") >= 1) & (F.col("__rank") <= F.col("__n")))
        .select(*group, F.col(place).alias("__at"), "__rank", "__low", "__high")
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: Sequence[float], name: str = "q"
) -> DataFrame:
    """``by`` and the array ``name``: per group the smallest value that at least
    the given share of its values does not exceed. Nulls are left out.

    Equal values are counted first, combined in the map tasks. The counts are
    summed by slice of the number line, and a running sum over the slices of a
    group names the slice a quantile lies in. That slice is cut again into
    ``PARTS`` between its own least and greatest value, so values that lie close
    together far from zero (time stamps, ids) are told apart too, and only the
    values of one part are ranked. A group is spread over tasks by value at each
    step, so none takes it whole.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("__one"))
    counts = (
        df.filter(F.col(value).isNotNull())
        .select(key.alias("__g"), F.col(value).cast("double").alias("__v"))
        .groupBy("__g", "__v")
        .agg(F.count("*").alias("__n"))
        .withColumn("__slice", slice_of(F.col("__v")))
    )
    extremes = [F.sum("__n").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high")]
    asked = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(quantiles)]
    )
    sums = counts.groupBy("__g", "__slice").agg(*extremes)
    first = sums.withColumn("__asked", F.explode(asked)).withColumn("__i", F.col("__asked.i"))
    rank = F.greatest(F.lit(1), F.ceil(F.col("__asked.q") * F.col("__all")))
    placed = _placed(first, ["__g", "__i"], "__slice", rank).withColumnsRenamed(
        {"__g": "__pg", "__rank": "__first_rank"}
    )
    # A struct is never null, so groups with nulls meet by plain equality.
    inside = counts.join(
        placed, (F.col("__g") == F.col("__pg")) & (F.col("__slice") == F.col("__at"))
    )
    width = F.col("__high") - F.col("__low")
    part = F.floor((F.col("__v") - F.col("__low")) / width * PARTS)
    cut = inside.select(
        "__g", "__i", "__v", "__n", "__first_rank",
        F.when((width > 0) & (width < float("inf")), part).otherwise(0).cast("int").alias("__part"),
    )
    parts = cut.groupBy("__g", "__i", "__part").agg(
        F.max("__first_rank").alias("__first_rank"), *extremes
    )
    last = _placed(parts, ["__g", "__i"], "__part", F.col("__first_rank")).select(
        F.col("__g").alias("__pg"), F.col("__i").alias("__pi"), "__at", "__rank"
    )
    here = (
        (F.col("__g") == F.col("__pg")) & (F.col("__i") == F.col("__pi"))
        & (F.col("__part") == F.col("__at"))
    )
    ranked = Window.partitionBy("__g", "__i").orderBy("__v")
    found = (
        cut.join(last, here)
        .withColumn("__upto", F.sum("__n").over(ranked))
        .filter((F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__n") < F.col("__rank")))
    )
    return (
        found.groupBy("__g")
        .agg(
            F.array(
                *[F.max(F.when(F.col("__i") == i, F.col("__v"))) for i in range(len(quantiles))]
            ).alias(name)
        )
        .select(*[F.col("__g")[c].alias(c) for c in by], name)
    )


def median_and_sums(
    df: DataFrame, by: Sequence[str], value: str, counted: Mapping[str, Column]
) -> DataFrame:
    """Per group: ``n`` rows, one sum per column of ``counted``, and ``n_values``,
    ``total``, ``low``, ``high`` and the exact ``median`` of ``value`` (the smaller
    of two in the middle), nulls left out.

    One scan. Equal values of a group are combined in the map tasks and again by
    (group, value); what then moves to the group are its distinct values, which a
    window runs over. It holds no group in memory, but a task passes through all
    distinct values of one: for groups of unbounded size take
    ``exact_quantiles``. Filters on ``by`` reach the scan, and a median that
    nobody reads is not computed.
    """
    number = F.col(value)
    valued = F.when(number.isNotNull(), F.col("__n")).otherwise(0)
    counts = df.groupBy(*by, value).agg(
        F.count("*").alias("__n"),
        F.sum(value).alias("__total"),
        *[F.sum(c).alias(f"__c_{k}") for k, c in counted.items()],
    )
    group = Window.partitionBy(*by)
    half = F.ceil(F.sum(valued).over(group) / 2)
    upto = F.sum(valued).over(group.orderBy(number.asc_nulls_first()))
    middle = number.isNotNull() & (F.col("__upto") >= F.col("__half")) & (
        F.col("__upto") - F.col("__n") < F.col("__half")
    )
    return (
        counts.withColumn("__upto", upto)
        .withColumn("__half", half)
        .groupBy(*by)
        .agg(
            F.sum("__n").alias("n"),
            *[F.sum(f"__c_{k}").alias(k) for k in counted],
            F.sum(valued).alias("n_values"),
            F.sum("__total").alias("total"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.max(F.when(middle, number)).alias("median"),
        )
    )
