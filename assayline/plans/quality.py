"""Declarative quality rules, checked in one pass per table.

All schema and value rules of a table, over all its suites, are conditional
counts of one aggregate. Uniqueness needs a grouping and is a second one. Value
rules skip nulls; a rule with nothing to check holds.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline import schemas
from assayline.functions import surrogate_key

RESULT_COLUMNS = (
    "suite", "rule", "column", "n_checked", "n_unexpected", "observed", "success",
)


@dataclass(frozen=True, eq=False)
class Rule:
    """``applies`` limits the rows looked at; ``mostly`` is the least share of
    looked-at rows that must hold. ``verdict`` settles rules on the schema."""

    name: str
    column: str | None = None
    holds: Column | None = None
    applies: Column | None = None
    mostly: float = 1.0
    verdict: bool | None = None
    observed: str | None = None
    min_rows: int | None = None
    unique: Sequence[str] = ()


def columns_match(df: DataFrame, names: Sequence[str]) -> Rule:
    return Rule(
        "columns_match_ordered_list",
        verdict=df.columns == list(names),
        observed=",".join(df.columns),
    )


def column_count(df: DataFrame, count: int) -> Rule:
    n = len(df.columns)
    return Rule("column_count_equals", verdict=n == count, observed=str(n))


def column_exists(df: DataFrame, column: str) -> Rule:
    found = column in df.columns
    return Rule("column_exists", column, verdict=found, observed=str(found).lower())


def column_type(df: DataFrame, column: str, kinds: Sequence[str]) -> Rule:
    """``kinds`` are Spark type class names, such as ``StringType``."""
    kind = type(df.schema[column].dataType).__name__ if column in df.columns else None
    return Rule("column_type_in_list", column, verdict=kind in kinds, observed=kind)


def row_count(at_least: int, where: Column | None = None) -> Rule:
    return Rule("row_count_at_least", applies=where, min_rows=at_least)


def not_null(column: str, mostly: float = 1.0) -> Rule:
    return Rule("not_null", column, holds=F.col(column).isNotNull(), mostly=mostly)


def between(
    column: str, low: float, high: float, mostly: float = 1.0, where: Column | None = None
) -> Rule:
    seen = F.col(column).isNotNull()
    return Rule(
        "between",
        column,
        holds=F.col(column).between(low, high),
        applies=seen if where is None else seen & where,
        mostly=mostly,
    )


def in_set(column: str, values: Sequence[str], mostly: float = 1.0) -> Rule:
    return Rule(
        "in_set",
        column,
        holds=F.col(column).isin(list(values)),
        applies=F.col(column).isNotNull(),
        mostly=mostly,
    )


def unique(columns: Sequence[str], name: str | None = None) -> Rule:
    """No two rows share the key; a key with a null part is not looked at."""
    return Rule("unique", name or ",".join(columns), unique=tuple(columns))


def _line(suite, rule, checked, unexpected, observed, success) -> Column:
    parts = (F.lit(suite), F.lit(rule.name), F.lit(rule.column).cast("string"),
             checked, unexpected, observed, success)
    return F.struct(*[p.alias(n) for p, n in zip(parts, RESULT_COLUMNS, strict=True)])


def _enough(checked: Column, unexpected: Column, mostly: float) -> Column:
    # Written without a division, so that 0.95 of 100 rows is exactly enough.
    if mostly >= 1.0:
        return unexpected == 0
    held = (checked - unexpected).cast("decimal(20,0)")
    return held >= checked.cast("decimal(20,0)") * F.lit(str(mostly)).cast("decimal(10,6)")


def _share_text(checked: Column, unexpected: Column) -> Column:
    share = F.round(F.try_divide(checked - unexpected, checked), 4)
    return F.coalesce(F.format_string("%.4f", share), F.lit("none"))


def _scanned(df: DataFrame, rules: Sequence[tuple[str, Rule]]) -> DataFrame:
    no_count = F.lit(None).cast("long")
    counts, lines = {}, []
    for i, (suite, rule) in enumerate(rules):
        if rule.verdict is not None:
            seen = F.lit(rule.observed).cast("string")
            lines.append(_line(suite, rule, no_count, no_count, seen, F.lit(rule.verdict)))
            continue
        applies = F.lit(True) if rule.applies is None else rule.applies
        checked = F.col(f"c{i}")
        counts[f"c{i}"] = F.count_if(applies)
        if rule.min_rows is not None:
            few = (checked < rule.min_rows).cast("long")
            lines.append(
                _line(suite, rule, checked, few, checked.cast("string"), few == 0)
            )
            continue
        unexpected = F.col(f"u{i}")
        counts[f"u{i}"] = F.count_if(applies & ~F.coalesce(rule.holds, F.lit(False)))
        lines.append(
            _line(
                suite, rule, checked, unexpected,
                _share_text(checked, unexpected), _enough(checked, unexpected, rule.mostly),
            )
        )
    totals = df.agg(
        F.count("*").alias("n"), *[c.alias(name) for name, c in counts.items()]
    )
    return totals.select(F.inline(F.array(*lines)))


def _uniqueness(df: DataFrame, suite: str, rule: Rule) -> DataFrame:
    keyed = df.select(*rule.unique).dropna()
    copies = keyed.groupBy(*rule.unique).agg(F.count("*").alias("n"))
    totals = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("c"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("u"),
    )
    checked, unexpected = F.col("c"), F.col("u")
    line = _line(
        suite, rule, checked, unexpected, _share_text(checked, unexpected), unexpected == 0
    )
    return totals.select(F.inline(F.array(line)))


def _absent(df: DataFrame, rule: Rule) -> Rule:
    """A value rule on a column that does not exist fails instead of raising."""
    needed = rule.unique or ([rule.column] if rule.holds is not None else [])
    if set(needed) <= set(df.columns):
        return rule
    return Rule(rule.name, rule.column, verdict=False, observed="no such column")


def check(df: DataFrame, suites: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """One result row per suite and rule."""
    rules = [
        (suite, _absent(df, rule)) for suite, listed in suites.items() for rule in listed
    ]
    scanned = [(s, r) for s, r in rules if not r.unique]
    parts = [_scanned(df, scanned)] if scanned else []
    parts += [_uniqueness(df, s, r) for s, r in rules if r.unique]
    return reduce(DataFrame.unionByName, parts)


def suite_summary(results: DataFrame) -> DataFrame:
    """A suite succeeds when all its rules do."""
    return results.groupBy("suite").agg(
        F.count("*").alias("n_rules"), F.every("success").alias("success")
    )


# Thresholds of the silver checks.
NON_NULL_SHARE = 0.95
STATUS_SHARE = 0.95
STATUS_VALUES = ("C", "N", "S")
RANGES = {
    "pH": (4.0, 10.0),
    "nitrates_mg_l": (0.0, 200.0),
    "nitrites_mg_l": (0.0, 10.0),
    "conductivite": (0.0, 5000.0),
    "turbidite_ntu": (0.0, 100.0),
}

# Columns that must be filled.
NON_NULL = {
    "stations": (
        "code_commune", "code_reseau", "nom_commune_norm", "annee",
        "code_departement_geo", "code_region_geo",
    ),
    "mesures": (
        "code_prelevement", "code_commune", "nom_commune_norm", "date_prelevement_ts",
        "code_parametre", "libelle_parametre_norm", "annee_prelevement", "code_departement",
    ),
    "conformite": (
        "code_prelevement", "date_prelevement_ts", "code_commune", "nom_commune_norm",
        "conformite_globale", "annee_prelevement", "code_departement",
    ),
}

# Other types a contract column may have.
ALSO_ALLOWED = {
    "LongType": ("IntegerType",),
    "DoubleType": ("FloatType",),
}


def views(label: str = "libelle_parametre_norm") -> dict[str, Column]:
    """Predicates of the five parameter views."""
    text = F.upper(F.coalesce(F.col(label), F.lit("")))
    # Label or label part of each view.
    return {
        "pH": text == "PH",
        "nitrates_mg_l": text.contains("NITRATES (EN NO3)"),
        "nitrites_mg_l": text.contains("NITRITES (EN NO2)"),
        "conductivite": text.contains("CONDUCTIVIT"),
        "turbidite_ntu": text.contains("TURBIDIT"),
    }


def view_rows(measures: DataFrame, view: str) -> DataFrame:
    return measures.filter(views()[view] & F.col("resultat_parse").isNotNull())


def contract_rules(df: DataFrame, table: str, filled: float = NON_NULL_SHARE) -> list[Rule]:
    """Columns, types, at least one row, and filled columns of a silver table."""
    contract = schemas.SILVER[table]
    rules = [
        columns_match(df, contract.names),
        column_count(df, len(contract.names)),
        row_count(1),
    ]
    for part in contract:
        kind = type(part.dataType).__name__
        rules.append(column_exists(df, part.name))
        rules.append(column_type(df, part.name, (kind, *ALSO_ALLOWED.get(kind, ()))))
    return rules + [not_null(c, filled) for c in NON_NULL[table]]


def range_rules(ranges: Mapping[str, tuple[float, float]] = RANGES) -> dict[str, list[Rule]]:
    """A suite per view that has a range; views without one are skipped."""
    value = F.col("resultat_parse")
    return {
        f"silver_mesures_range_{view}_suite": [
            row_count(0, where=rows & value.isNotNull()),
            between("resultat_parse", *ranges[view], where=rows),
        ]
        for view, rows in views().items()
        if view in ranges
    }


def check_stations(stations: DataFrame, filled: float = NON_NULL_SHARE) -> DataFrame:
    rules = contract_rules(stations, "stations", filled) + [
        not_null("code_reseau"),
        between("latitude", -90.0, 90.0),
        between("longitude", -180.0, 180.0),
    ]
    key = [F.col(c) for c in ("code_commune", "code_reseau", "nom_quartier")]
    identified = stations.select(surrogate_key(key).alias("_station_id"))
    uniqueness = [
        column_exists(identified, "_station_id"),
        not_null("_station_id"),
        unique(["_station_id"]),
    ]
    return check(stations, {"silver_stations_schema_suite": rules}).unionByName(
        check(identified, {"silver_stations_uniqueness_suite": uniqueness})
    )


def check_measures(
    measures: DataFrame,
    ranges: Mapping[str, tuple[float, float]] = RANGES,
    filled: float = NON_NULL_SHARE,
) -> DataFrame:
    """Six suites, one scan."""
    suites = {"silver_mesures_schema_suite": contract_rules(measures, "mesures", filled)}
    return check(measures, {**suites, **range_rules(ranges)})


def check_conformity(
    conformity: DataFrame, filled: float = NON_NULL_SHARE, known: float = STATUS_SHARE
) -> DataFrame:
    statuses = (
        "conformite_bact_limite_norm",
        "conformite_pc_limite_norm",
        "conformite_bact_ref_norm",
        "conformite_pc_ref_norm",
    )
    rules = contract_rules(conformity, "conformite", filled)
    rules.append(in_set("conformite_globale", STATUS_VALUES))
    rules += [in_set(c, STATUS_VALUES, known) for c in statuses]
    return check(conformity, {"silver_conformite_schema_suite": rules})


CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stations": check_stations,
    "mesures": check_measures,
    "conformite": check_conformity,
}
