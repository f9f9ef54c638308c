"""Bronze tables to the three silver tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline import schemas
from assayline.functions import (
    in_bbox,
    keyword_category,
    plain_keyword_category,
    label_norm,
    map_codes,
    parse_day,
    parse_instant,
    qualified_result,
    threshold_flag,
    vocab,
    worst_of_status,
)
from assayline.operators import (
    Metrics,
    first_per_key,
    flag_iqr_outliers,
    handle_missing,
    iqr_bounds,
    latest_per_key,
    select_existing,
    with_load_ts,
)

RESULT_KEY = ("code_prelevement", "code_parametre", "date_prelevement")
STATION_KEY = ("code_commune", "code_reseau", "nom_quartier")
SAMPLE_KEY = ("code_prelevement",)
REQUIRED = ("date_prelevement_ts", "code_commune", "code_parametre")

# Raw status column to normalised one.
STATUS_COLUMNS = {
    "conformite_limites_bact_prelevement": "conformite_bact_limite_norm",
    "conformite_limites_pc_prelevement": "conformite_pc_limite_norm",
    "conformite_references_bact_prelevement": "conformite_bact_ref_norm",
    "conformite_references_pc_prelevement": "conformite_pc_ref_norm",
}
LABEL_COLUMNS = {
    "libelle_parametre": "libelle_parametre_norm",
    "nom_commune": "nom_commune_norm",
    "nom_departement": "nom_departement_norm",
}

CONTRACT = {*schemas.SILVER["mesures"].names, *schemas.SILVER["conformite"].names}
RAW_USED = {
    *CONTRACT,
    *STATUS_COLUMNS,
    *LABEL_COLUMNS,
    "date_prelevement",
    "resultat_numerique",
    "libelle_unite",
    "_ingestion_timestamp",
}


def type_results(raw: DataFrame) -> DataFrame:
    """Sample time with year and month, numeric result with the text one as
    fallback, threshold flags, and the ingestion time under its silver name."""
    text = F.col("resultat_alphanumerique")
    number = F.col("resultat_numerique")
    timed = raw.withColumn("date_prelevement_ts", parse_instant(F.col("date_prelevement")))
    return timed.withColumns(
        {
            "annee_prelevement": F.year("date_prelevement_ts"),
            "mois_prelevement": F.month("date_prelevement_ts"),
            "resultat_numerique": number.try_cast("double"),
            "resultat_parse": qualified_result(number, text),
            "est_sous_seuil": threshold_flag(text, "<"),
            "est_sur_seuil": threshold_flag(text, ">"),
            "_bronze_ingestion_ts": F.col("_ingestion_timestamp"),
        }
    )


def dedupe_results(results: DataFrame) -> DataFrame:
    """Raw or typed results, the last loaded row of each key."""
    return latest_per_key(results, RESULT_KEY, ["_ingestion_timestamp"])


def normalise_results(results: DataFrame) -> DataFrame:
    labels = {new: label_norm(F.col(old)) for old, new in LABEL_COLUMNS.items()}
    statuses = {
        new: map_codes(F.col(old), vocab.STATUSES, fallback=F.upper)
        for old, new in STATUS_COLUMNS.items()
    }
    unit = {"libelle_unite_norm": map_codes(F.col("libelle_unite"), vocab.UNITS)}
    return results.withColumns({**labels, **unit, **statuses})


def settle_missing(results: DataFrame) -> DataFrame:
    return handle_missing(
        results,
        required=REQUIRED,
        fill={
            "libelle_unite_norm": vocab.UNKNOWN_UNIT,
            "nom_distributeur": vocab.UNKNOWN_DISTRIBUTOR,
        },
        missing_flag=("_resultat_manquant", "resultat_parse"),
    )


def clean_results(raw: DataFrame, metrics: Metrics | None = None) -> DataFrame:
    """Raw results to one typed, normalised row per result, with the columns
    silver tables are made of.

    Copies go first, while rows are narrow and untyped: the key and the load
    time are raw columns. Rows with an unusable date or without a parameter are
    dropped before that shuffle, as both only depend on the key. With
    ``metrics`` rows are counted on their way, without a scan of their own; the
    filters then stay behind the first count.
    """
    used = raw.select(*[c for c in raw.columns if c in RAW_USED])
    if metrics is None:
        clean = settle_missing(normalise_results(type_results(dedupe_results(used))))
    else:
        one = metrics.rows(dedupe_results(metrics.rows(used, "landed")), "deduped")
        typed = metrics.rows(
            normalise_results(type_results(one)),
            "typed",
            n_null_date=F.count_if(F.col("date_prelevement_ts").isNull()),
            n_null_result=F.count_if(F.col("resultat_parse").isNull()),
        )
        clean = metrics.rows(settle_missing(typed), "clean")
    return clean.select(*[c for c in clean.columns if c in CONTRACT])


def result_bounds(clean: DataFrame, accuracy: int | None = None) -> DataFrame:
    return iqr_bounds(clean, "resultat_parse", "code_parametre", accuracy=accuracy)


def flag_outliers(
    clean: DataFrame, bounds: DataFrame | None = None, accuracy: int | None = None
) -> DataFrame:
    return flag_iqr_outliers(
        clean, "resultat_parse", "code_parametre", "_est_outlier", accuracy=accuracy, bounds=bounds
    )


def categorise(results: DataFrame) -> DataFrame:
    """Adds the category of each label."""
    return results.withColumn(
        "categorie_parametre",
        keyword_category(
            F.col("libelle_parametre_norm"), vocab.CATEGORY_RULES, vocab.CATEGORY_DEFAULT
        ),
    )


def categorise_stored(results: DataFrame) -> DataFrame:
    """As ``categorise``, for results whose label is a stored column: the plain
    chain of keyword tests then costs no recomputation and stays in generated
    code."""
    return results.withColumn(
        "categorie_parametre",
        plain_keyword_category(
            F.col("libelle_parametre_norm"), vocab.CATEGORY_RULES, vocab.CATEGORY_DEFAULT
        ),
    )


def build_measures(results: DataFrame, moment: str | None = None) -> DataFrame:
    """Contract columns that exist, in contract order, and the load time."""
    stamped = with_load_ts(results, "_silver_timestamp", moment)
    return select_existing(stamped, schemas.SILVER["mesures"].names)


def build_conformity(results: DataFrame, moment: str | None = None) -> DataFrame:
    """One row per sample with its overall status. Needs neither outlier flags
    nor categories, so it can start from ``clean_results``."""
    kept = select_existing(results, schemas.SILVER["conformite"].names)
    statuses = [F.col(c) for c in STATUS_COLUMNS.values()]
    samples = first_per_key(kept, SAMPLE_KEY).withColumn(
        "conformite_globale", worst_of_status(statuses)
    )
    stamped = with_load_ts(samples, "_silver_timestamp", moment)
    return select_existing(stamped, schemas.SILVER["conformite"].names)


def clean_geo(places: DataFrame) -> DataFrame:
    return places.select(
        F.col("code").alias("code_commune_geo"),
        F.col("nom").alias("nom_commune_geo"),
        F.col("codeDepartement").alias("code_departement_geo"),
        F.col("codeRegion").alias("code_region_geo"),
        "population",
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("latitude").try_cast("double").alias("latitude"),
    ).withColumn("_coords_valides", in_bbox(F.col("longitude"), F.col("latitude")))


def build_stations(
    networks: DataFrame, geo: DataFrame, moment: str | None = None
) -> DataFrame:
    """One row per place, network and district, with its commune's position."""
    kept = networks.select(
        *STATION_KEY,
        "nom_commune",
        "nom_reseau",
        parse_day(F.col("debut_alim")).alias("debut_alim"),
        F.col("annee").try_cast("int").alias("annee"),
    )
    # The label follows from the name, so rows are sorted without it.
    unique = first_per_key(kept, STATION_KEY).withColumn(
        "nom_commune_norm", label_norm(F.col("nom_commune"))
    )
    located = unique.join(geo, unique["code_commune"] == geo["code_commune_geo"], "left")
    stamped = with_load_ts(located, "_silver_timestamp", moment)
    return stamped.select(*schemas.SILVER["stations"].names)


def explode_networks(measures: DataFrame, networks: DataFrame | None = None) -> DataFrame:
    """One row per measure and network of its JSON network list; with
    ``networks`` (one row per ``code_reseau``) their columns are attached."""
    listed = F.from_json("reseaux", schemas.NETWORK_LIST)
    rows = measures.withColumn("_network", F.explode(listed)).select(
        *measures.columns,
        F.col("_network.code").alias("code_reseau"),
        F.col("_network.nom").alias("nom_reseau"),
    )
    return rows.join(networks, "code_reseau", "left") if networks is not None else rows
