"""Layer jobs: each reads tables, writes tables, and returns stored row counts."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayline import schemas
from assayline.operators import Metrics
from assayline.plans import bronze as to_bronze
from assayline.plans import gold as to_gold
from assayline.plans import quality as rules
from assayline.plans import silver as to_silver
from assayline.sources import (
    Layout,
    Staging,
    collection_completeness,
    ensure_namespace,
    page_completeness,
    read_envelope,
    read_geojson,
    read_table,
    rejects,
    schema_drift,
    write_table,
)
from assayline.sources.staging import counted_cut, cut, shuffles_end

# Large tables are written in slices, so that only a part is shuffled at a time:
# one for so many rows, and at most SLICES. Landings of more than so many bytes
# are stored as they are read, without a shuffle.
SLICE_ROWS, SLICE_BYTES, SLICES = 1_000_000, 32 << 20, 8
# Each slice reads its source again where no partition of it can be left out. Tables
# of few columns, or of few of the rows, take one slice for so many of the others.
FEWER = {"conformite": 2, "violations": 4, "non_conformites": 4}
STAGES = ("bronze", "silver", "gold")
SOURCES = ("geo_communes", "communes_udi", "resultats_dis")
# Record schema and shape of the documents of each source.
RAW = {
    "geo_communes": (schemas.RAW_PLACES, "geojson"),
    "communes_udi": (schemas.RAW_NETWORKS, "envelope"),
    "resultats_dis": (schemas.RAW_RESULTS, "envelope"),
}


class LandingError(RuntimeError):
    """Raised by a strict landing; names the sources with lost pages."""


class QualityError(RuntimeError):
    """Raised by a gating quality job; names the suites that failed."""


@dataclass(frozen=True)
class Landing:
    """Folder of landed documents per source, and the origin to record."""

    paths: Mapping[str, str]
    origins: Mapping[str, str]
    one_per_file: bool = True


def _write(df: DataFrame, layout: Layout, layer: str, name: str, **options) -> int:
    parts = schemas.PARTITIONS.get(name, ())
    return write_table(df, layout, layer, name, partition_by=parts, **options)


def _slices(size: int, each: int) -> int:
    return max(1, min(SLICES, -(-size // each)))


def _fewer(name: str, slices: int) -> int:
    return -(-slices // FEWER[name])


def slices_of(df: DataFrame) -> int:
    """In how many slices so many rows are written."""
    with shuffles_end(df.sparkSession):
        return _slices(df.count(), SLICE_ROWS)


def batches_of(df: DataFrame, by: Sequence[str]) -> list[tuple[DataFrame, int]]:
    """Rows in as many batches as ``slices_of``, cut by a hash of ``by``, and the
    number of rows of each."""
    return counted_cut(df, lambda n: _slices(n, SLICE_ROWS), by, SLICES)


def _telling(
    layer: str, spent: Callable[[str, str], None] | None
) -> Callable[..., None]:
    def done_with(*names: str) -> None:
        for name in names if spent else ():
            spent(layer, name)

    return done_with


def _years(raw: DataFrame, n: int) -> list[tuple[int | None, list[DataFrame]]]:
    """Landed results by the year that bronze is partitioned by, each year in its
    share of ``n`` slices. All copies of a result are in one slice: the year
    follows from the date, which is in its key."""
    year = F.col(schemas.PARTITIONS["resultats_dis"][0])
    with shuffles_end(raw.sparkSession):
        counts = raw.groupBy(year.alias("year")).count().collect()
    total = sum(r["count"] for r in counts)
    return [
        (
            r.year,
            cut(
                raw.filter(year.eqNullSafe(F.lit(r.year).cast("int"))),
                max(1, round(n * r["count"] / total)),
                to_silver.SAMPLE_KEY,
            ),
        )
        for r in sorted(counts, key=lambda r: (r.year is not None, r.year))
    ]


def _now(spark: SparkSession) -> str:
    """The load time of a table that several queries write."""
    return spark.range(1).select(F.current_timestamp().cast("string")).first()[0]


def _is_large(records: DataFrame) -> bool:
    """Whether the landed files that ``records`` are read from exceed SLICE_BYTES."""
    files = records.inputFiles()
    listed = records.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length"))
    return listed.first()[0] > SLICE_BYTES


def bronze(
    spark: SparkSession,
    layout: Layout,
    landing: Landing,
    only: str | Sequence[str] | None = None,
    moment: str | None = None,
    strict: bool = False,
    append: bool = False,
) -> dict[str, int]:
    """Land all sources, or those of ``only``. An empty landing leaves its table.
    With ``append`` the landing is a further batch of networks or results, whose
    rows are added to those of the batches before.

    Documents that give no records, of any shape, are kept in
    ``rejects_<source>`` with their file. With ``strict``, lost documents stop
    the job before its tables change (see ``completeness``).
    """
    wanted = SOURCES if only is None else (only,) if isinstance(only, str) else tuple(only)
    unknown = set(wanted) - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown source {sorted(unknown)}; known: {list(SOURCES)}")
    if append and "geo_communes" in wanted:
        raise ValueError("places are landed whole: the last of a code is taken over all of them")
    first = "append" if append else "overwrite"
    ensure_namespace(spark, layout, "bronze")
    moment = moment or _now(spark)
    if strict:
        lost = completeness(spark, landing, wanted).filter(~F.col("is_complete"))
        names = sorted(row.source for row in lost.select("source").collect())
        if names:
            raise LandingError(", ".join(names))
    stored = {}
    for name in wanted:
        path, origin = landing.paths[name], landing.origins[name]
        schema, shape = RAW[name]
        lost = rejects(spark, path, schema, shape, landing.one_per_file)
        names = schemas.BRONZE[name].names
        if shape == "geojson":
            records = read_geojson(spark, path, schema, landing.one_per_file, with_position=True)
            _write(lost, layout, "bronze", f"rejects_{name}", mode=first)
            stored[name] = 0
            if not records.isEmpty():
                table = to_bronze.land_places(records, origin, moment)
                stored[name] = _write(table.select(*names), layout, "bronze", name)
            continue
        records = read_envelope(spark, path, schema, landing.one_per_file)
        stored[name] = 0
        if not records.isEmpty():
            land = to_bronze.land_networks if name == "communes_udi" else to_bronze.land_results
            # Documents without records are counted on the way. They are few and mostly
            # none, so the documents are parsed again only where there are some.
            seen = Observation()
            records = read_envelope(spark, path, schema, landing.one_per_file, seen)
            table = land(records, origin, moment).select(*names)
            stored[name] = _write(
                table, layout, "bronze", name, mode=first, rebalance=not _is_large(records)
            )
            if not seen.get["n_lost"]:
                lost = lost.limit(0)
        _write(lost, layout, "bronze", f"rejects_{name}", mode=first)
    return stored


def completeness(
    spark: SparkSession, landing: Landing, only: Sequence[str] | None = None
) -> DataFrame:
    """One row per source: whether its documents hold what they announce.
    Collections announce nothing; theirs are whole where all could be read."""
    check = {"geojson": collection_completeness, "envelope": page_completeness}
    found = [
        check[shape](spark, landing.paths[name], schema, landing.one_per_file).select(
            F.lit(name).alias("source"), "*"
        )
        for name, (schema, shape) in RAW.items()
        if only is None or name in only
    ]
    return reduce(DataFrame.unionByName, found)


def drift(
    spark: SparkSession, landing: Landing, only: Sequence[str] | None = None
) -> DataFrame:
    """One row per field and source that doesn't stand as declared: unknown,
    missing, retyped or empty (see ``schema_drift``)."""
    found = [
        schema_drift(spark, landing.paths[name], schema, shape, landing.one_per_file).select(
            F.lit(name).alias("source"), "*"
        )
        for name, (schema, shape) in RAW.items()
        if only is None or name in only
    ]
    return reduce(DataFrame.unionByName, found).filter("status <> 'as declared'")


def silver(
    spark: SparkSession,
    layout: Layout,
    moment: str | None = None,
    accuracy: int | None = None,
    metrics: Metrics | None = None,
    spent: Callable[[str, str], None] | None = None,
    spent_part: Callable[[str, str, Mapping[str, object]], None] | None = None,
    tables: Sequence[str] | None = None,
    append: bool = False,
    slices: int | None = None,
) -> dict[str, int]:
    """``metrics`` counts the rows of each cleaning step while it runs; ``spent``
    is called with ``bronze`` and a table once nothing here reads it any more,
    ``spent_part`` with a partition (column to value) besides, where a large
    table is read one by one.

    ``tables`` are the silver tables to make, all if unset; measures and
    conformity are made together. With ``append`` bronze holds a further batch of
    networks, with all rows of its stations, which are added to those of the
    batches before. ``slices`` is in how many slices tables are written, by their
    rows if unset.

    Cleaned results feed the bounds, the measures and the conformity, so they
    are staged: the shuffle that removes copies runs once, and a lost executor
    costs a re-read instead of that shuffle. They are cleaned by year of bronze,
    and those of a year go once they are measures."""
    wanted = set(schemas.SILVER) if tables is None else set(tables)
    of_results = {"mesures", "conformite"}
    if wanted - set(schemas.SILVER) or wanted & of_results not in (set(), of_results):
        raise ValueError(f"can't make {sorted(wanted)}: known are stations, mesures with conformite")
    if append and wanted != {"stations"}:
        raise ValueError("only stations are made in batches")
    ensure_namespace(spark, layout, "silver")
    moment = moment or _now(spark)
    stored: dict[str, int] = {}
    done_with = _telling("bronze", spent)

    def bronze_table(name: str) -> DataFrame:
        return read_table(spark, layout, "bronze", name, schemas.BRONZE[name])

    def store(name: str, df: DataFrame, n: int = 1, by: Sequence[str] = (), more: bool = False) -> None:
        mode = "append" if more else "overwrite"
        stored[name] = _write(df, layout, "silver", name, slices=n, slice_by=by, mode=mode)

    if wanted & of_results:
        raw = bronze_table("resultats_dis")
        # Steps are counted by one query each.
        n = 1 if metrics is not None else slices or slices_of(raw)
        years = _years(raw, n) if n > 1 else [(None, [raw])]
        with Staging(spark) as stage:
            parts: dict[str, DataFrame] = {}
            for year, rows in years:
                for part in rows:
                    label = f"clean_results_{len(parts)}"
                    parts[label] = stage(to_silver.clean_results(part, metrics), label)
                if spent_part and n > 1:
                    spent_part("bronze", "resultats_dis", {"_partition_annee": year})
            done_with("resultats_dis")
            clean = stage.read(next(iter(parts.values())).schema, *parts)
            bounds = stage(to_silver.result_bounds(clean, accuracy), "result_bounds")

            def measures(part: DataFrame) -> DataFrame:
                results = to_silver.categorise_stored(to_silver.flag_outliers(part, bounds))
                if metrics is not None:
                    results = metrics.rows(
                        results,
                        "measures",
                        n_outliers=F.count_if("_est_outlier"),
                        n_missing=F.count_if("_resultat_manquant"),
                    )
                return to_silver.build_measures(results, moment)

            conformity = to_silver.build_conformity(clean, moment)
            store("conformite", conformity, _fewer("conformite", n), to_silver.SAMPLE_KEY)
            for k, (label, part) in enumerate(parts.items()):
                store("mesures", measures(part), more=k > 0)
                stage.drop(label)
    if "stations" in wanted:
        networks, geo = bronze_table("communes_udi"), to_silver.clean_geo(bronze_table("geo_communes"))
        stations = to_silver.build_stations(networks, geo, moment)
        n = slices or slices_of(networks)
        store("stations", stations, n, to_silver.STATION_KEY[:1], append)
        done_with("communes_udi", "geo_communes")
    return stored


def _silver_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {
        name: read_table(spark, layout, "silver", name, schema)
        for name, schema in schemas.SILVER.items()
    }


def quality(
    spark: SparkSession,
    layout: Layout,
    gate: bool = False,
    ranges: Mapping[str, tuple[float, float]] = rules.RANGES,
    filled: float = rules.NON_NULL_SHARE,
    known_status: float = rules.STATUS_SHARE,
) -> DataFrame:
    """Check the silver tables, keep the results as a table, and return them.
    ``ranges`` are the value ranges per view, ``filled`` the least share of
    values that a filled column needs, ``known_status`` that of known statuses.
    Failures are only reported unless ``gate`` is set. In a catalog without a
    ``quality`` namespace the table is ``quality_results`` of silver."""
    table = _silver_tables(spark, layout)
    checked = [
        rules.check_stations(table["stations"], filled),
        rules.check_measures(table["mesures"], ranges, filled),
        rules.check_conformity(table["conformite"], filled, known_status),
    ]
    results = reduce(DataFrame.unionByName, checked)
    layer, name = "quality", "results"
    if layout.in_catalog and layer not in layout.namespaces:
        layer, name = "silver", "quality_results"
    ensure_namespace(spark, layout, layer)
    write_table(results, layout, layer, name)
    kept = read_table(spark, layout, layer, name, results.schema)
    if gate:
        failed = rules.suite_summary(kept).filter(~F.col("success")).select("suite")
        names = sorted(row.suite for row in failed.collect())
        if names:
            raise QualityError(", ".join(names))
    return kept


def gold(
    spark: SparkSession,
    layout: Layout,
    moment: str | None = None,
    accuracy: int | None = None,
    spent: Callable[[str, str], None] | None = None,
) -> dict[str, int]:
    """``spent`` is as that of ``silver``, for silver tables. The dimension has several readers and is staged, with its true size known
    to the optimizer. Silver has one row per sample, so samples are counted
    without a shuffle of their own, and regions add up from the place table."""
    table = _silver_tables(spark, layout)
    ensure_namespace(spark, layout, "gold")
    moment = moment or _now(spark)
    conformity, measures = table["conformite"], table["mesures"]
    n = slices_of(measures)
    stored = {}
    done_with = _telling("silver", spent)
    with Staging(spark) as stage:
        dim = stage(to_gold.entity_dim(table["stations"]), "entity_dim")
        done_with("stations")

        def store(name: str, df: DataFrame, slices: int = 1) -> None:
            parts = schemas.PARTITIONS.get(name, ())
            stored[name] = _write(df, layout, "gold", name, slices=slices, slice_by=parts)

        statuses = to_gold.status_rollup(conformity, dim, moment, unique_samples=True)
        store("conformite_commune", statuses)
        places = read_table(
            spark, layout, "gold", "conformite_commune", schemas.GOLD["conformite_commune"]
        )
        population = to_gold.region_population(dim)
        store("qualite_region", to_gold.region_of_statuses(places, population, moment))
        store("top10_communes", to_gold.best_worst(to_gold.score_rollup(places), moment=moment))
        # Samples meet their measures in slices of samples, and are grouped in slices of groups.
        failed = to_gold.failed_samples(conformity)
        details = to_gold.violations_with_measures(failed, measures)
        details = stage(details, "violations", _fewer("violations", n), to_silver.SAMPLE_KEY)
        done_with("conformite")
        store(
            "evolution_parametres",
            to_gold.period_stats(measures, dim, moment, accuracy=accuracy),
            n,
        )
        done_with("mesures")
        profile = to_gold.profile_of(details, dim, moment)
        store("non_conformites", profile, _fewer("non_conformites", n))
    return stored


def stage_range(first: str, last: str, with_quality: bool = False) -> list[str]:
    """Stages from ``first`` to ``last``, quality right after silver if asked."""
    for name in (first, last):
        if name not in STAGES:
            raise ValueError(f"unknown stage {name}; known: {list(STAGES)}")
    picked = STAGES[STAGES.index(first) : STAGES.index(last) + 1]
    if not picked:
        raise ValueError(f"stage {first} comes after {last}")
    asked = {"silver": ["silver", "quality"]} if with_quality else {}
    return [step for name in picked for step in asked.get(name, [name])]


def run(
    spark: SparkSession,
    layout: Layout,
    landing: Landing | None = None,
    first: str = "bronze",
    last: str = "gold",
    with_quality: bool = False,
    gate: bool = False,
    moment: str | None = None,
    only: str | Sequence[str] | None = None,
    strict: bool = False,
    accuracy: int | None = None,
    metrics: Metrics | None = None,
    ranges: Mapping[str, tuple[float, float]] = rules.RANGES,
    filled: float = rules.NON_NULL_SHARE,
    known_status: float = rules.STATUS_SHARE,
    append: bool = False,
    spent: Callable[[str, str], None] | None = None,
    spent_part: Callable[[str, str, Mapping[str, object]], None] | None = None,
    tables: Sequence[str] | None = None,
    slices: int | None = None,
) -> dict[str, dict[str, int] | DataFrame]:
    """Run a range of layers in one session. A failing stage stops the run.
    ``only``, ``strict`` and ``append`` are for the bronze stage, ``spent`` is for the
    silver and the gold stage; ``spent_part``, ``tables`` and ``slices`` are for the
    silver stage, which appends too where ``tables`` are named; ``accuracy`` takes
    quantile sketches of that size instead of exact quantiles; ``metrics``
    counts the rows of the silver steps; ``ranges``, ``filled`` and
    ``known_status`` are those of ``quality``."""
    done: dict[str, dict[str, int] | DataFrame] = {}
    for stage in stage_range(first, last, with_quality):
        if stage == "bronze":
            if landing is None:
                raise ValueError("the bronze stage needs a landing")
            done[stage] = bronze(spark, layout, landing, only, moment, strict, append)
        elif stage == "quality":
            done[stage] = quality(spark, layout, gate, ranges, filled, known_status)
        elif stage == "silver":
            done[stage] = silver(
                spark, layout, moment, accuracy, metrics, spent, spent_part, tables,
                append and tables is not None, slices,
            )
        else:
            done[stage] = gold(spark, layout, moment, accuracy, spent)
    return done
