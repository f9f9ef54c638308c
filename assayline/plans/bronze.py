"""Landed documents to bronze tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions import load_ts, parse_instant
from assayline.operators import latest_per_key, nested_to_json

RESULT_NESTED = ("reseaux",)
PLACE_NESTED = ("codesPostaux",)
POSITION = ("_source_file", "_page", "_position", "_in_lines")


def add_lineage(df: DataFrame, source: str, moment: str | None = None) -> DataFrame:
    return df.withColumns(
        {"_ingestion_timestamp": load_ts(moment), "_source_api": F.lit(source)}
    )


def land_networks(records: DataFrame, source: str, moment: str | None = None) -> DataFrame:
    return add_lineage(records, source, moment)


def land_results(records: DataFrame, source: str, moment: str | None = None) -> DataFrame:
    """Results with nested fields as JSON text and the year of the sample date,
    the partition column."""
    flat = nested_to_json(records, RESULT_NESTED)
    return add_lineage(flat, source, moment).withColumn(
        "_partition_annee", F.year(parse_instant(F.col("date_prelevement")))
    )


def _numbers(file: Column) -> Column:
    """Numbers in the name of a file, so that page 10 comes after page 2."""
    name = F.regexp_extract(file, r"([^/]*)$", 1)
    return F.transform(
        F.regexp_extract_all(name, F.lit(r"(\d+)"), 1), lambda n: n.try_cast("decimal(38,0)")
    )


def dedupe_geo(places: DataFrame, key: str = "code") -> DataFrame:
    """Last arrival per code. Rows without a code are dropped, unless no row has
    one: then all are kept.

    Arrival order is the numbers in the file name, the name, the ordinal that
    the document carries, and the place in the document. Lines of a file carry
    no order of their own: a code that occurs twice in a file of lines without
    ordinals is an error.
    """
    arrival = [c for c in POSITION if c in places.columns]
    coded = places.filter(F.col(key).isNotNull())
    order = [F.col(c).desc_nulls_last() for c in arrival if c != "_in_lines"]
    if "_source_file" in arrival:
        order = [_numbers(F.col("_source_file")).desc_nulls_last(), *order]
    if {"_in_lines", "_page"} <= set(arrival):
        twice = (
            coded.filter(F.col("_in_lines") & F.col("_page").isNull())
            .groupBy("_source_file", key)
            .agg(F.count("*").alias("__n"))
            .filter("__n > 1")
            .agg(F.count("*"))
            .scalar()
        )
        message = F.lit("a code occurs twice in a file of lines without page ordinals")
        coded = coded.filter(F.when(twice > 0, F.raise_error(message).cast("boolean")).otherwise(True))
    coded = latest_per_key(coded, [key], order)
    n_coded = places.agg(F.count(key)).scalar()
    uncoded = places.filter(F.col(key).isNull() & (n_coded == 0))
    return coded.unionByName(uncoded).drop(*arrival)


def land_places(places: DataFrame, source: str, moment: str | None = None) -> DataFrame:
    return add_lineage(nested_to_json(dedupe_geo(places), PLACE_NESTED), source, moment)
