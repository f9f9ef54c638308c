"""Run layers with spark-submit.

spark-submit submit.py --root s3a://lake/water --landing s3a://lake/landing \\
    --first bronze --last gold --with-quality --gate
spark-submit submit.py --namespace bronze=water_bronze --namespace silver=water_silver \\
    --namespace gold=water_gold --catalog main --first silver

The landing folder holds one folder per source: geo_communes, communes_udi,
resultats_dis. The session is the cluster's own; nothing in it is changed.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from assayline import schemas
from assayline.operators import Metrics, null_profile
from assayline.plans import jobs, quality, reports
from assayline.sources import Layout, read_table


def parsed(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    parser.add_argument("--root", help="folder of the layers")
    parser.add_argument("--catalog")
    parser.add_argument("--namespace", action="append", default=[], metavar="LAYER=SCHEMA")
    parser.add_argument("--landing")
    parser.add_argument("--first", default="bronze")
    parser.add_argument("--last", default="gold")
    parser.add_argument("--only", action="append", help="a source; may be repeated")
    parser.add_argument("--lines", action="store_true", help="one document per line")
    parser.add_argument("--strict", action="store_true", help="lost pages stop the run")
    parser.add_argument("--with-quality", action="store_true")
    parser.add_argument("--gate", action="store_true")
    parser.add_argument("--accuracy", type=int, help="quantile sketches instead of exact ones")
    parser.add_argument("--range", action="append", default=[], dest="ranges",
                        metavar="VIEW=LOW:HIGH", help="values allowed in a view; may be repeated")
    parser.add_argument("--filled", type=float, default=quality.NON_NULL_SHARE,
                        help="least share of values in a filled column")
    parser.add_argument("--known-status", type=float, default=quality.STATUS_SHARE,
                        help="least share of known statuses")
    asked = parser.parse_args(arguments)
    if not asked.root and not asked.namespace:
        parser.error("--root or --namespace is needed")
    try:
        asked.ranges = {**quality.RANGES, **dict(map(_range, asked.ranges))}
    except ValueError as problem:
        parser.error(str(problem))
    return asked


def _range(given: str) -> tuple[str, tuple[float, float]]:
    """``VIEW=LOW:HIGH``; other values of the view fail its suite."""
    view, _, limits = given.partition("=")
    if view not in quality.RANGES:
        raise ValueError(f"unknown view {view}; known: {sorted(quality.RANGES)}")
    low, _, high = limits.partition(":")
    if not float(low) <= float(high):
        raise ValueError(f"range of {view} is empty: {limits}")
    return view, (float(low), float(high))


def main(arguments: Sequence[str] | None = None) -> None:
    asked = parsed(arguments)
    landing = None
    if asked.landing:
        paths = {name: f"{asked.landing.rstrip('/')}/{name}" for name in jobs.SOURCES}
        landing = jobs.Landing(paths, origins=paths, one_per_file=not asked.lines)
    spark = SparkSession.builder.appName("assayline").getOrCreate()
    names = dict(pair.split("=", 1) for pair in asked.namespace)
    layout = Layout(root=asked.root, catalog=asked.catalog, namespaces=names)
    if landing is not None and asked.first == "bronze":
        jobs.completeness(spark, landing, asked.only).show(truncate=False)
    metrics = Metrics()
    done = jobs.run(
        spark, layout, landing, asked.first, asked.last, asked.with_quality, asked.gate,
        only=asked.only, strict=asked.strict, accuracy=asked.accuracy,
        metrics=metrics, ranges=asked.ranges, filled=asked.filled, known_status=asked.known_status,
    )
    for stage, stored in done.items():
        if isinstance(stored, dict):
            for table, rows in stored.items():
                print(f"{stage}.{table}: {rows} rows")
    if "silver" in done:
        for step, counts in metrics.get().items():
            print(f"step {step}: {counts}")
        for name, contract in schemas.SILVER.items():
            stored = read_table(spark, layout, "silver", name, contract)
            null_profile(stored, contract.names).show(len(contract), truncate=False)
    for layer, contracts in (("silver", schemas.SILVER), ("gold", schemas.GOLD)):
        if layer in done:
            reports.report_of(spark, layout, layer, contracts).show(truncate=False)


if __name__ == "__main__":
    main()
    SparkSession.getActiveSession().stop()
