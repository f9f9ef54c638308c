from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts. The Z is a literal, so the session zone applies.
INSTANT_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_LAYOUT = "yyyy-MM-dd"


def parse_instant(text: Column) -> Column:
    """Text to timestamp, null when it does not fit the layout."""
    return F.try_to_timestamp(text, F.lit(INSTANT_LAYOUT))


def parse_day(text: Column) -> Column:
    """Text to date, null when it does not fit the layout."""
    return F.try_to_date(text, DAY_LAYOUT)


def period_label(year: Column, month: Column) -> Column:
    """``2025-03``; null when either part is missing."""
    return F.when(
        year.isNotNull() & month.isNotNull(), F.format_string("%d-%02d", year, month)
    )


def load_ts(moment: str | None = None) -> Column:
    """The injected load time, or the start of the query when there is none."""
    return F.lit(moment).cast("timestamp") if moment else F.current_timestamp()
