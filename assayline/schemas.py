"""Declared table schemas. Column names are the data contract of the layers."""

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
DATE = T.DateType()
TIME = T.TimestampType()
TEXTS = T.ArrayType(TEXT)
NETWORK_LIST = T.ArrayType(
    T.StructType([T.StructField("code", TEXT), T.StructField("nom", TEXT)])
)

# Record layouts of the landed sources.
RAW_NETWORKS = T.StructType(
    [
        T.StructField("code_commune", TEXT),
        T.StructField("nom_commune", TEXT),
        T.StructField("nom_quartier", TEXT),
        T.StructField("code_reseau", TEXT),
        T.StructField("nom_reseau", TEXT),
        T.StructField("debut_alim", TEXT),
        T.StructField("annee", TEXT),
    ]
)
RAW_RESULTS = T.StructType(
    [
        T.StructField("code_departement", TEXT),
        T.StructField("nom_departement", TEXT),
        T.StructField("code_commune", TEXT),
        T.StructField("nom_commune", TEXT),
        T.StructField("code_prelevement", TEXT),
        T.StructField("date_prelevement", TEXT),
        T.StructField("reference_analyse", TEXT),
        T.StructField("code_installation_amont", TEXT),
        T.StructField("nom_installation_amont", TEXT),
        T.StructField("code_parametre", TEXT),
        T.StructField("code_parametre_se", TEXT),
        T.StructField("code_parametre_cas", TEXT),
        T.StructField("libelle_parametre", TEXT),
        T.StructField("libelle_parametre_maj", TEXT),
        T.StructField("libelle_parametre_web", TEXT),
        T.StructField("code_type_parametre", TEXT),
        T.StructField("code_lieu_analyse", TEXT),
        T.StructField("resultat_alphanumerique", TEXT),
        T.StructField("resultat_numerique", DOUBLE),
        T.StructField("libelle_unite", TEXT),
        T.StructField("code_unite", TEXT),
        T.StructField("limite_qualite_parametre", TEXT),
        T.StructField("reference_qualite_parametre", TEXT),
        T.StructField("conclusion_conformite_prelevement", TEXT),
        T.StructField("conformite_limites_bact_prelevement", TEXT),
        T.StructField("conformite_limites_pc_prelevement", TEXT),
        T.StructField("conformite_references_bact_prelevement", TEXT),
        T.StructField("conformite_references_pc_prelevement", TEXT),
        T.StructField("nom_uge", TEXT),
        T.StructField("nom_distributeur", TEXT),
        T.StructField("nom_moa", TEXT),
        T.StructField("reseaux", NETWORK_LIST),
    ]
)
RAW_PLACES = T.StructType(
    [
        T.StructField("nom", TEXT),
        T.StructField("code", TEXT),
        T.StructField("codeDepartement", TEXT),
        T.StructField("codeRegion", TEXT),
        T.StructField("siren", TEXT),
        T.StructField("codeEpci", TEXT),
        T.StructField("codesPostaux", TEXTS),
        T.StructField("population", LONG),
    ]
)

LINEAGE = [T.StructField("_ingestion_timestamp", TIME), T.StructField("_source_api", TEXT)]


def _as_text(schema: T.StructType, *names: str) -> list[T.StructField]:
    return [T.StructField(f.name, TEXT) if f.name in names else f for f in schema]


BRONZE = {
    "geo_communes": T.StructType(
        [
            *_as_text(RAW_PLACES, "codesPostaux"),
            T.StructField("longitude", DOUBLE),
            T.StructField("latitude", DOUBLE),
            *LINEAGE,
        ]
    ),
    "communes_udi": T.StructType([*RAW_NETWORKS, *LINEAGE]),
    "resultats_dis": T.StructType(
        [
            *_as_text(RAW_RESULTS, "reseaux"),
            *LINEAGE,
            T.StructField("_partition_annee", INT),
        ]
    ),
}

# Silver contract, in column order. Department codes stay text.
SILVER = {
    "stations": T.StructType(
        [
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune", TEXT),
            T.StructField("nom_quartier", TEXT),
            T.StructField("code_reseau", TEXT),
            T.StructField("nom_reseau", TEXT),
            T.StructField("debut_alim", DATE),
            T.StructField("annee", INT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("code_departement_geo", TEXT),
            T.StructField("code_region_geo", TEXT),
            T.StructField("population", LONG),
            T.StructField("longitude", DOUBLE),
            T.StructField("latitude", DOUBLE),
            T.StructField("_coords_valides", BOOL),
            T.StructField("_silver_timestamp", TIME),
        ]
    ),
    "mesures": T.StructType(
        [
            T.StructField("code_prelevement", TEXT),
            T.StructField("reference_analyse", TEXT),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("date_prelevement_ts", TIME),
            T.StructField("mois_prelevement", INT),
            T.StructField("code_parametre", TEXT),
            T.StructField("code_parametre_se", TEXT),
            T.StructField("code_parametre_cas", TEXT),
            T.StructField("libelle_parametre_norm", TEXT),
            T.StructField("code_type_parametre", TEXT),
            T.StructField("categorie_parametre", TEXT),
            T.StructField("code_lieu_analyse", TEXT),
            T.StructField("resultat_parse", DOUBLE),
            T.StructField("resultat_alphanumerique", TEXT),
            T.StructField("est_sous_seuil", BOOL),
            T.StructField("est_sur_seuil", BOOL),
            T.StructField("libelle_unite_norm", TEXT),
            T.StructField("limite_qualite_parametre", TEXT),
            T.StructField("reference_qualite_parametre", TEXT),
            T.StructField("nom_distributeur", TEXT),
            T.StructField("nom_uge", TEXT),
            T.StructField("nom_moa", TEXT),
            T.StructField("reseaux", TEXT),
            T.StructField("_resultat_manquant", BOOL),
            T.StructField("_est_outlier", BOOL),
            T.StructField("_bronze_ingestion_ts", TIME),
            T.StructField("_silver_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
            T.StructField("code_departement", TEXT),
        ]
    ),
    "conformite": T.StructType(
        [
            T.StructField("code_prelevement", TEXT),
            T.StructField("date_prelevement_ts", TIME),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("nom_distributeur", TEXT),
            T.StructField("nom_uge", TEXT),
            T.StructField("conformite_bact_limite_norm", TEXT),
            T.StructField("conformite_pc_limite_norm", TEXT),
            T.StructField("conformite_bact_ref_norm", TEXT),
            T.StructField("conformite_pc_ref_norm", TEXT),
            T.StructField("conclusion_conformite_prelevement", TEXT),
            T.StructField("reseaux", TEXT),
            T.StructField("conformite_globale", TEXT),
            T.StructField("_silver_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
            T.StructField("code_departement", TEXT),
        ]
    ),
}

# Gold contract, in column order.
GOLD = {
    "conformite_commune": T.StructType(
        [
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("code_region_geo", TEXT),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("population", LONG),
            T.StructField("longitude", DOUBLE),
            T.StructField("latitude", DOUBLE),
            T.StructField("_coords_valides", BOOL),
            T.StructField("nb_prelevements_total", LONG),
            T.StructField("nb_prelevements_conformes", LONG),
            T.StructField("nb_prelevements_non_conformes", LONG),
            T.StructField("nb_prelevements_sans_objet", LONG),
            T.StructField("taux_conformite_pct", DOUBLE),
            T.StructField("taux_non_conformite_pct", DOUBLE),
            T.StructField("_gold_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
            T.StructField("code_departement", TEXT),
        ]
    ),
    "evolution_parametres": T.StructType(
        [
            T.StructField("mois_prelevement", INT),
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("code_region_geo", TEXT),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("code_parametre", TEXT),
            T.StructField("libelle_parametre_norm", TEXT),
            T.StructField("categorie_parametre", TEXT),
            T.StructField("libelle_unite_norm", TEXT),
            T.StructField("nb_mesures", LONG),
            T.StructField("nb_resultats_manquants", LONG),
            T.StructField("nb_outliers", LONG),
            T.StructField("valeur_moyenne", DOUBLE),
            T.StructField("valeur_mediane", DOUBLE),
            T.StructField("valeur_min", DOUBLE),
            T.StructField("valeur_max", DOUBLE),
            T.StructField("pct_resultats_manquants", DOUBLE),
            T.StructField("pct_outliers", DOUBLE),
            T.StructField("_gold_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
            T.StructField("code_departement", TEXT),
        ]
    ),
    "qualite_region": T.StructType(
        [
            T.StructField("code_region_geo", TEXT),
            T.StructField("nb_communes", LONG),
            T.StructField("nb_prelevements_total", LONG),
            T.StructField("nb_prelevements_conformes", LONG),
            T.StructField("nb_prelevements_non_conformes", LONG),
            T.StructField("nb_prelevements_sans_objet", LONG),
            T.StructField("population_couverte", LONG),
            T.StructField("taux_conformite_pct", DOUBLE),
            T.StructField("taux_non_conformite_pct", DOUBLE),
            T.StructField("_gold_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
        ]
    ),
    "top10_communes": T.StructType(
        [
            T.StructField("code_departement", TEXT),
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("code_region_geo", TEXT),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("population", LONG),
            T.StructField("longitude", DOUBLE),
            T.StructField("latitude", DOUBLE),
            T.StructField("nb_prelevements_total", LONG),
            T.StructField("nb_prelevements_conformes", LONG),
            T.StructField("nb_prelevements_non_conformes", LONG),
            T.StructField("nb_prelevements_sans_objet", LONG),
            T.StructField("taux_conformite_pct", DOUBLE),
            T.StructField("taux_non_conformite_pct", DOUBLE),
            T.StructField("rang", INT),
            T.StructField("classement_type", TEXT),
            T.StructField("_gold_timestamp", TIME),
        ]
    ),
    "non_conformites": T.StructType(
        [
            T.StructField("nom_departement_norm", TEXT),
            T.StructField("code_region_geo", TEXT),
            T.StructField("code_commune", TEXT),
            T.StructField("nom_commune_norm", TEXT),
            T.StructField("code_parametre", TEXT),
            T.StructField("libelle_parametre_norm", TEXT),
            T.StructField("categorie_parametre", TEXT),
            T.StructField("libelle_unite_norm", TEXT),
            T.StructField("nb_prelevements_non_conformes", LONG),
            T.StructField("nb_mesures_associees", LONG),
            T.StructField("nb_mesures_avec_seuil_reglementaire", LONG),
            T.StructField("valeur_moyenne", DOUBLE),
            T.StructField("valeur_max", DOUBLE),
            T.StructField("nb_outliers", LONG),
            T.StructField("nb_mesures_sous_seuil", LONG),
            T.StructField("pct_outliers", DOUBLE),
            T.StructField("_gold_timestamp", TIME),
            T.StructField("annee_prelevement", INT),
            T.StructField("code_departement", TEXT),
        ]
    ),
}

# Partition columns per table.
QUALITY_RESULTS = T.StructType(
    [
        T.StructField("suite", TEXT),
        T.StructField("rule", TEXT),
        T.StructField("column", TEXT),
        T.StructField("n_checked", LONG),
        T.StructField("n_unexpected", LONG),
        T.StructField("observed", TEXT),
        T.StructField("success", BOOL),
    ]
)

PARTITIONS = {
    "resultats_dis": ("_partition_annee",),
    "mesures": ("annee_prelevement", "code_departement"),
    "conformite": ("annee_prelevement", "code_departement"),
    "conformite_commune": ("annee_prelevement", "code_departement"),
    "evolution_parametres": ("annee_prelevement", "code_departement"),
    "qualite_region": ("annee_prelevement",),
    "non_conformites": ("annee_prelevement", "code_departement"),
}
