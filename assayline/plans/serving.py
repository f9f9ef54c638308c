"""Read queries over the gold tables: filtered pages, menus, rankings, series."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions import marker_size, period_label, vocab, weighted_mean
from assayline.operators import (
    apply_filters,
    distinct_values,
    filter_members,
    latest_per_key,
)

# Order of each table, then the rest of its key, which makes the
# order total so that pages do not overlap.
PLACE_TAIL = (
    ("code_departement", "asc"), ("nom_departement_norm", "asc"), ("code_region_geo", "asc"),
)
TABLE_ORDERS: dict[str, tuple[tuple[str, str], ...]] = {
    "conformite_commune": (
        ("annee_prelevement", "desc"),
        ("taux_conformite_pct", "desc"),
        ("nom_commune_norm", "asc"),
        ("code_commune", "asc"),
        *PLACE_TAIL,
    ),
    "evolution_parametres": (
        ("annee_prelevement", "desc"),
        ("mois_prelevement", "desc"),
        ("libelle_parametre_norm", "asc"),
        ("code_commune", "asc"),
        ("nom_commune_norm", "asc"),
        ("code_parametre", "asc"),
        ("categorie_parametre", "asc"),
        ("libelle_unite_norm", "asc"),
        *PLACE_TAIL,
    ),
    "qualite_region": (
        ("annee_prelevement", "desc"),
        ("taux_conformite_pct", "desc"),
        ("code_region_geo", "asc"),
    ),
    "top10_communes": (("classement_type", "asc"), ("rang", "asc")),
    "non_conformites": (
        ("annee_prelevement", "desc"),
        ("nb_prelevements_non_conformes", "desc"),
        ("nom_commune_norm", "asc"),
        ("code_commune", "asc"),
        ("code_parametre", "asc"),
        ("libelle_parametre_norm", "asc"),
        ("categorie_parametre", "asc"),
        ("libelle_unite_norm", "asc"),
        *PLACE_TAIL,
    ),
}

# Columns that can be asked for by value.
_EQUAL = {
    "conformite_commune": (
        "annee_prelevement", "code_departement", "code_commune", "code_region_geo",
    ),
    "evolution_parametres": (
        "annee_prelevement", "mois_prelevement", "code_departement", "code_commune",
        "code_parametre", "libelle_parametre_norm", "categorie_parametre",
    ),
    "qualite_region": ("annee_prelevement", "code_region_geo"),
    "top10_communes": ("classement_type", "code_region_geo"),
    "non_conformites": (
        "annee_prelevement", "code_departement", "code_commune", "code_parametre",
        "categorie_parametre",
    ),
}
_AT_LEAST = {"min_taux_conformite_pct": "taux_conformite_pct"}
_RATED = ("conformite_commune", "qualite_region")

# Most rows of a page.
PAGE_LIMIT = 1000
RANKING_LIMIT = 20


@dataclass(frozen=True)
class Page:
    """``rows`` of one page, ``total`` (one row, ``row_count``) of all of them."""

    table: str
    limit: int
    offset: int
    filters: Mapping[str, Any]
    rows: DataFrame
    total: DataFrame

    def with_total(self) -> DataFrame:
        return self.rows.withColumn("row_count", self.total.scalar())

    def total_with_rows(self) -> DataFrame:
        """As ``with_total``, but a page behind the end is one row that is empty
        except for ``row_count``."""
        n_shown = self.rows.agg(F.count("*")).scalar()
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.rows.schema]
        none = self.total.select(*blank, "row_count").filter(n_shown == 0)
        return self.with_total().unionByName(none)


def table_order(table: str) -> list[Column]:
    return [
        F.col(name).desc_nulls_last() if way == "desc" else F.col(name).asc_nulls_last()
        for name, way in TABLE_ORDERS[table]
    ]


def department(code: int | str | None) -> str | None:
    """Department codes are texts of two characters or more."""
    return f"{code:02d}" if isinstance(code, int) else code


def _bound(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be {low}..{'' if high is None else high}, got {value}")


def _predicates(table: str, asked: Mapping[str, Any]) -> list[tuple[str, str, Any]]:
    equal = _EQUAL[table]
    found = []
    for name, value in asked.items():
        if name in _AT_LEAST and table in _RATED:
            found.append((_AT_LEAST[name], ">=", value))
        elif name in equal:
            found.append((name, "=", department(value) if name == "code_departement" else value))
        else:
            raise ValueError(f"{table} has no filter {name}")
    if asked.get("mois_prelevement") is not None:
        _bound("mois_prelevement", asked["mois_prelevement"], 1, 12)
    if asked.get("classement_type") not in (None, vocab.BEST_TAG, vocab.WORST_TAG):
        raise ValueError(f"unknown classement_type {asked['classement_type']}")
    return found


def page(
    df: DataFrame, table: str, limit: int | None = None, offset: int = 0, **filters: Any
) -> Page:
    """One page of a gold table. Sorting keeps ``offset + limit`` rows per task;
    the total is a separate count, not a window over all rows."""
    most = RANKING_LIMIT if table == "top10_communes" else PAGE_LIMIT
    limit = min(100, most) if limit is None else limit
    _bound("limit", limit, 1, most)
    _bound("offset", offset, 0)
    kept = apply_filters(df, _predicates(table, filters))
    rows = kept.orderBy(*table_order(table)).offset(offset).limit(limit)
    total = kept.agg(F.count("*").alias("row_count"))
    return Page(table, limit, offset, dict(filters), rows, total)


def _scoped(df: DataFrame, year: int | None, dept: int | str | None) -> DataFrame:
    return apply_filters(
        df, [("annee_prelevement", "=", year), ("code_departement", "=", department(dept))]
    )


def menu_values(
    statuses: DataFrame,
    stats: DataFrame,
    year: int | None = None,
    dept: int | str | None = None,
) -> dict[str, DataFrame]:
    """Years (never filtered), parameter labels and communes for the menus."""
    places = ["nom_commune_norm", "code_commune"]
    years = distinct_values(statuses, ["annee_prelevement"])
    return {
        "years": years.orderBy(F.desc("annee_prelevement")),
        "parameters": distinct_values(_scoped(stats, year, dept), ["libelle_parametre_norm"]),
        "communes": distinct_values(_scoped(statuses, year, dept), places).select(
            "code_commune", "nom_commune_norm"
        ),
    }


def weighted_top(
    stats: DataFrame,
    label: str,
    year: int | None = None,
    dept: int | str | None = None,
    limit: int = RANKING_LIMIT,
    exclude_missing: bool = False,
) -> DataFrame:
    """Places by the mean of a parameter weighted by its number of measures.
    Results without a value weigh in as zero; ``exclude_missing`` leaves them out."""
    _bound("limit", limit, 1, RANKING_LIMIT)
    place = [
        "code_commune", "nom_commune_norm", "code_departement",
        "code_region_geo", "libelle_unite_norm",
    ]
    weight = F.col("nb_mesures")
    if exclude_missing:
        weight = weight - F.coalesce("nb_resultats_manquants", F.lit(0))
    mean = weighted_mean(F.col("valeur_moyenne"), weight)
    return (
        _scoped(stats, year, dept)
        .filter(F.col("libelle_parametre_norm") == label)
        .groupBy(*place)
        .agg(
            F.sum(F.coalesce("nb_mesures", F.lit(0))).alias("nb_mesures"),
            F.round(mean, 3).alias("valeur_moyenne_ponderee"),
            F.max("valeur_max").alias("valeur_max"),
            F.min("valeur_min").alias("valeur_min"),
        )
        .filter(F.col("nb_mesures") > 0)
        .orderBy(
            F.col("valeur_moyenne_ponderee").desc_nulls_last(),
            F.col("nb_mesures").desc_nulls_last(),
            F.col("nom_commune_norm").asc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in place if c != "nom_commune_norm"],
        )
        .limit(limit)
    )


def top_bars(ranked: DataFrame, k: int = RANKING_LIMIT) -> DataFrame:
    """The ``k`` greatest means of a ranking, smallest of them first, as bars
    are drawn from the bottom."""
    best = ranked.orderBy(
        F.col("valeur_moyenne_ponderee").desc_nulls_first(),
        F.col("nb_mesures").desc_nulls_first(),
        F.col("nom_commune_norm").asc_nulls_last(),
        F.col("code_commune").asc_nulls_last(),
    ).limit(k)
    return best.orderBy(
        F.col("valeur_moyenne_ponderee").asc_nulls_last(),
        F.col("nb_mesures").asc_nulls_last(),
        F.col("nom_commune_norm").desc_nulls_first(),
        F.col("code_commune").desc_nulls_first(),
    )


def kpi_summary(
    statuses: DataFrame,
    stats: DataFrame,
    label: str | None = None,
    year: int | None = None,
    communes: Sequence[str] | None = None,
) -> DataFrame:
    """One row: places, samples, rate weighted by samples, measures of ``label``.
    ``communes`` are limited to those of the year; none left means all."""
    placed = _scoped(statuses, year, None)
    measured = _scoped(stats, year, None)
    if label is not None:
        measured = measured.filter(F.col("libelle_parametre_norm") == label)
    if communes:
        # A menu place has a code and a name.
        offered = placed.select("code_commune", "nom_commune_norm").dropna()
        placed = filter_members(placed, "code_commune", communes, offered)
        measured = filter_members(measured, "code_commune", communes, offered)
    weight = F.when(F.col("nb_prelevements_total") > 0, F.col("nb_prelevements_total"))
    rate = F.coalesce("taux_conformite_pct", F.lit(0.0))
    n_measures = measured.agg(F.coalesce(F.sum("nb_mesures"), F.lit(0)))
    return placed.agg(
        F.count("*").alias("nb_communes"),
        F.coalesce(F.sum("nb_prelevements_total"), F.lit(0)).alias("nb_prelevements_total"),
        F.round(F.try_divide(F.sum(rate * weight), F.sum(weight)), 2).alias(
            "taux_conformite_pct"
        ),
    ).withColumn("nb_mesures", n_measures.scalar())


def most_measured(stats: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` places with most measures, ties by name. Rows without a code or
    a name are skipped."""
    named = stats.filter((F.col("code_commune") != "") & (F.col("nom_commune_norm") != ""))
    return (
        named.groupBy("code_commune")
        .agg(
            F.sum(F.coalesce("nb_mesures", F.lit(0))).alias("nb_mesures"),
            F.max("nom_commune_norm").alias("nom_commune_norm"),
        )
        .orderBy(F.desc("nb_mesures"), "nom_commune_norm", "code_commune")
        .limit(k)
    )


def map_points(statuses: DataFrame, year: int | None = None) -> DataFrame:
    """Every row of a place with coordinates: those of its first row in table
    order that has any, its rate and its size; places without any are left out."""
    rows = _scoped(statuses, year, None).filter(F.col("code_commune") != "")
    located = rows.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    points = latest_per_key(
        located.select(
            "code_commune", "nom_commune_norm", "code_region_geo", "code_departement",
            "nom_departement_norm", "longitude", "latitude", "annee_prelevement",
            "taux_conformite_pct", F.coalesce("population", F.lit(0)).alias("population"),
        ),
        ["code_commune"],
        table_order("conformite_commune"),
        tie_break=(),
    ).drop("annee_prelevement", "taux_conformite_pct", "nom_departement_norm")
    measured = rows.select(
        "code_commune",
        F.round(F.coalesce("taux_conformite_pct", F.lit(0.0)), 3).alias("metric_value"),
        F.round(F.coalesce("nb_prelevements_total", F.lit(0)).cast("double"), 2).alias(
            "size_value"
        ),
    )
    return (
        measured.join(points, "code_commune")
        .withColumn("marker_size", marker_size(F.col("size_value")))
        .orderBy(
            F.col("metric_value").desc_nulls_first(),
            F.col("size_value").desc_nulls_first(),
            "code_commune",
        )
    )


def series(
    stats: DataFrame,
    label: str,
    year: int | None = None,
    communes: Sequence[str] | DataFrame | None = None,
    available: DataFrame | None = None,
    k: int = 5,
) -> DataFrame:
    """Monthly values of a parameter for the chosen places, or for the ``k`` most
    measured ones when none is chosen. Rows without a period are left out whole."""
    rows = _scoped(stats, year, None).filter(F.col("libelle_parametre_norm") == label)
    if communes:
        kept = filter_members(rows, "code_commune", communes, available)
    else:
        chosen = most_measured(rows, k).select("code_commune")
        kept = rows.join(chosen, "code_commune", "left_semi")
    name = F.coalesce(F.nullif("nom_commune_norm", F.lit("")), F.lit(vocab.UNKNOWN_PLACE))
    period = period_label(F.col("annee_prelevement"), F.col("mois_prelevement"))
    return (
        kept.withColumns({"nom_commune_norm": name, "periode": period})
        .filter(F.col("periode").isNotNull())
        .orderBy(
            "nom_commune_norm", "annee_prelevement", "mois_prelevement", "code_commune",
            "code_parametre", "libelle_unite_norm",
        )
        .select(
            "nom_commune_norm", "code_commune", "periode", "valeur_moyenne", "nb_mesures",
            "valeur_min", "valeur_max", "libelle_unite_norm",
        )
    )


def series_unit(stats: DataFrame, label: str, year: int | None = None) -> DataFrame:
    """The first unit, in table order, that is not empty."""
    return (
        _scoped(stats, year, None)
        .filter((F.col("libelle_parametre_norm") == label) & (F.col("libelle_unite_norm") != ""))
        .orderBy(*table_order("evolution_parametres"))
        .limit(1)
        .select("libelle_unite_norm")
    )


def defaults(
    statuses: DataFrame,
    stats: DataFrame,
    preferred: str = vocab.PREFERRED_LABEL,
    year: int | None = None,
    asked: str | None = None,
) -> DataFrame:
    """One row: the latest year, and the preferred label if measured, else the
    first one by name. With ``year``, that year and the labels measured in it;
    an ``asked`` label that is offered is kept."""
    label = F.col("libelle_parametre_norm")
    offered = _scoped(stats, year, None)
    wanted = [asked, preferred] if asked is not None else [preferred]
    found = [F.max(F.when(label == name, label)) for name in wanted]
    labels = offered.agg(F.coalesce(*found, F.min(label)))
    latest = F.max("annee_prelevement") if year is None else F.lit(year)
    return statuses.agg(latest.alias("annee_prelevement")).withColumn(
        "libelle_parametre_norm", labels.scalar()
    )
