"""Fixed values the results depend on."""

# Unit spellings.
UNITS = {
    "ug/l": "ug/L",
    "mg/l": "mg/L",
    "MG/L": "mg/L",
    "us/cm": "uS/cm",
    "ntu": "NTU",
    "NFU": "NTU",
}

# Status spellings (any other text is upper-cased).
STATUSES = {"C": "C", "N": "N", "S": "S", "c": "C", "n": "N", "s": "S"}

# Keywords per category; the first category that matches wins.
RADIOACTIVITY = (
    "TRITIUM", "RADIOACTIVITE", "DOSE TOTALE", "DOSE INDICATIVE", "CESIUM",
    "STRONTIUM", "IODE", "RADON", "URANIUM", "ALPHA", "BETA", "GAMMA",
)
MICROBIOLOGY = (
    "COLI", "COLIFORM", "ENTEROCOQU", "BACTERIE", "BACTERIES", "STREPTO",
    "CLOSTRIDIUM", "LEGIONELLA", "PSEUDOMONAS", "GERME", "FLORE", "SPORE",
    "CAMPYLOBACTER", "CRYPTOSPORIDIUM", "GIARDIA",
)
CHEMISTRY = (
    "NITRATE", "NITRITE", "PESTICIDE", "HERBICIDE", "INSECTICIDE", "ALUMINIUM",
    "PLOMB", "CUIVRE", "FER", "MANGANESE", "ZINC", "NICKEL", "CHROME",
    "ARSENIC", "MERCURE", "CADMIUM", "FLUORURE", "CHLORURE", "SULFATE",
    "AMMONIUM", "PHOSPHATE", "PH", "CONDUCTIVITE", "CONDUCTIV", "TURBIDITE",
    "COULEUR", "ODEUR", "TEMPERATURE", "CHLORE", "BROMATE", "TRIHALOMETHANE",
    "THM", "BENZENE", "TOLUENE", "XYLENE", "MCPA", "ATRAZINE", "GLYPHOSATE",
    "TRIBUTYLTIN", "HYDROCARBURE",
)
CATEGORY_RULES = (
    ("RADIOACTIVITE", RADIOACTIVITY),
    ("MICROBIOLOGIE", MICROBIOLOGY),
    ("CHIMIE", CHEMISTRY),
)
CATEGORY_DEFAULT = "AUTRE"

# Fills for missing text.
UNKNOWN_UNIT = "INCONNUE"
UNKNOWN_DISTRIBUTOR = "INCONNU"
UNKNOWN_PLACE = "INCONNUE"

# Ranking tags and the preferred menu label.
BEST_TAG = "PLUS_CONFORME"
WORST_TAG = "MOINS_CONFORME"
PREFERRED_LABEL = "NITRATES (EN NO3)"

# Bounding box, inclusive.
LON_RANGE = (-5.5, 9.6)
LAT_RANGE = (41.0, 51.2)
