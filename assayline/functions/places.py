from pyspark.sql import Column

from assayline.functions.vocab import LAT_RANGE, LON_RANGE


def in_bbox(
    longitude: Column,
    latitude: Column,
    lon_range: tuple[float, float] = LON_RANGE,
    lat_range: tuple[float, float] = LAT_RANGE,
) -> Column:
    """Inside the box, borders included; null when a coordinate is missing
    and the other one does not already decide."""
    return longitude.between(*lon_range) & latitude.between(*lat_range)
