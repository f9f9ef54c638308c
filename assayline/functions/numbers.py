from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_DECIMAL = r"^-?\d+(\.\d+)?$"


def parse_qualified_number(text: Column) -> Column:
    """Text such as ``<0,01`` to double; anything that is not a plain decimal
    once qualifiers are gone (``ND``, ``1e-3``, inner blanks) is null.

    One ``translate`` turns commas to points and drops the qualifiers, so no
    list of "no result" words is needed: none of them is a decimal.
    """
    plain = F.translate(F.trim(text), ",<>≤≥~", ".")
    return F.when(plain.rlike(PLAIN_DECIMAL), plain.try_cast("double"))


def qualified_result(number: Column, text: Column) -> Column:
    """The numeric result, or the one read from the text where there is none."""
    return F.coalesce(number.try_cast("double"), parse_qualified_number(text))


def threshold_flag(text: Column, sign: str) -> Column:
    """Whether the untrimmed text starts with ``sign``; null text stays null."""
    return text.startswith(sign)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is zero or null."""
    return F.round(F.try_divide(100 * part, whole), scale)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate. Mean of ``value`` weighted by ``weight``; both count as zero
    when null, as the served ranking defines it; null for a zero total weight."""
    weight = F.coalesce(weight, F.lit(0))
    return F.try_divide(F.sum(F.coalesce(value, F.lit(0.0)) * weight), F.sum(weight))


def marker_size(count: Column, low: int = 12, high: int = 38, factor: float = 1.6) -> Column:
    """Whole part of ``sqrt(count) * factor`` kept within ``[low, high]``."""
    size = (F.sqrt(count) * factor).cast("int")
    return F.greatest(F.lit(low), F.least(F.lit(high), size))
