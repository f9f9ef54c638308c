from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions import pct


def status_counts(status: str, names: Mapping[str, str]) -> list[Column]:
    """One conditional count per status code, named by ``names``."""
    return [F.count_if(F.col(status) == code).alias(name) for code, name in names.items()]


def with_rates(df: DataFrame, total: str, rates: Mapping[str, str]) -> DataFrame:
    """Add ``rates = {new column: counted column}`` as percentages of ``total``."""
    return df.withColumns({new: pct(F.col(part), F.col(total)) for new, part in rates.items()})
