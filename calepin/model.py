"""Column layouts and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Booking operators, and how each one writes its files.
OPERATORS = ("maiia", "keldoc", "doctolib")
SEPARATORS = {"maiia": ",", "keldoc": ";", "doctolib": ","}

NOT_PROVIDED = "NR"

# Texts accepted in the boolean fields.
TRUE_TEXTS = ("t", "T", "VRAI", "TRUE", "true")
FALSE_TEXTS = ("f", "F", "FAUX", "FALSE", "false")

# Texts that a pandas CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# What marks the reason of a booster appointment, upper-cased.
BOOSTER_WORDS = ("RAPPEL", "3", "IMMUN", "TROIS")

# What a blank count looks like in the keldoc slot files.
SLOT_BLANK = " -   "

# Department, region code, region short name.
TERRITORY = (
    ("971", "01", "GDP"),
    ("972", "02", "MAR"),
    ("973", "03", "GUY"),
    ("974", "04", "REU"),
    ("976", "06", "MAY"),
    ("75", "11", "IDF"),
    ("77", "11", "IDF"),
    ("78", "11", "IDF"),
    ("91", "11", "IDF"),
    ("92", "11", "IDF"),
    ("93", "11", "IDF"),
    ("94", "11", "IDF"),
    ("95", "11", "IDF"),
    ("18", "24", "CVL"),
    ("28", "24", "CVL"),
    ("36", "24", "CVL"),
    ("37", "24", "CVL"),
    ("41", "24", "CVL"),
    ("45", "24", "CVL"),
    ("21", "27", "BFC"),
    ("25", "27", "BFC"),
    ("39", "27", "BFC"),
    ("58", "27", "BFC"),
    ("70", "27", "BFC"),
    ("71", "27", "BFC"),
    ("89", "27", "BFC"),
    ("90", "27", "BFC"),
    ("14", "28", "NOR"),
    ("27", "28", "NOR"),
    ("50", "28", "NOR"),
    ("61", "28", "NOR"),
    ("76", "28", "NOR"),
    ("02", "32", "HDF"),
    ("59", "32", "HDF"),
    ("60", "32", "HDF"),
    ("62", "32", "HDF"),
    ("80", "32", "HDF"),
    ("08", "44", "GES"),
    ("10", "44", "GES"),
    ("51", "44", "GES"),
    ("52", "44", "GES"),
    ("54", "44", "GES"),
    ("55", "44", "GES"),
    ("57", "44", "GES"),
    ("67", "44", "GES"),
    ("68", "44", "GES"),
    ("88", "44", "GES"),
    ("44", "52", "PDL"),
    ("49", "52", "PDL"),
    ("53", "52", "PDL"),
    ("72", "52", "PDL"),
    ("85", "52", "PDL"),
    ("22", "53", "BRE"),
    ("29", "53", "BRE"),
    ("35", "53", "BRE"),
    ("56", "53", "BRE"),
    ("16", "75", "NAQ"),
    ("17", "75", "NAQ"),
    ("19", "75", "NAQ"),
    ("23", "75", "NAQ"),
    ("24", "75", "NAQ"),
    ("33", "75", "NAQ"),
    ("40", "75", "NAQ"),
    ("47", "75", "NAQ"),
    ("64", "75", "NAQ"),
    ("79", "75", "NAQ"),
    ("86", "75", "NAQ"),
    ("87", "75", "NAQ"),
    ("09", "76", "OCC"),
    ("11", "76", "OCC"),
    ("12", "76", "OCC"),
    ("30", "76", "OCC"),
    ("31", "76", "OCC"),
    ("32", "76", "OCC"),
    ("34", "76", "OCC"),
    ("46", "76", "OCC"),
    ("48", "76", "OCC"),
    ("65", "76", "OCC"),
    ("66", "76", "OCC"),
    ("81", "76", "OCC"),
    ("82", "76", "OCC"),
    ("01", "84", "ARA"),
    ("03", "84", "ARA"),
    ("07", "84", "ARA"),
    ("15", "84", "ARA"),
    ("26", "84", "ARA"),
    ("38", "84", "ARA"),
    ("42", "84", "ARA"),
    ("43", "84", "ARA"),
    ("63", "84", "ARA"),
    ("69", "84", "ARA"),
    ("73", "84", "ARA"),
    ("74", "84", "ARA"),
    ("04", "93", "PAC"),
    ("05", "93", "PAC"),
    ("06", "93", "PAC"),
    ("13", "93", "PAC"),
    ("83", "93", "PAC"),
    ("84", "93", "PAC"),
    ("2A", "94", "COR"),
    ("2B", "94", "COR"),
)

# Mayotte is in the dimension but receives no regional file of its own.
ARS_REGIONS = tuple(dict.fromkeys(name for _, _, name in TERRITORY if name != "MAY"))

# Raw appointment fields, all text.
RAW_BOOKING = (
    "date_creation", "date_rdv", "id_centre", "nom_centre", "cp_centre",
    "motif_rdv", "rang_vaccinal", "parcours_rdv", "annee_naissance",
    "honore", "annule", "type_vaccin",
)

# Normalised appointment, in publication order.
BOOKING = T.StructType(
    [
        T.StructField("date_creation", T.DateType()),
        T.StructField("date_rdv", T.DateType()),
    ]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "id_centre", "nom_centre", "cp_centre", "code_departement",
            "code_region", "region", "motif_rdv", "rang_vaccinal",
            "parcours_rdv", "annee_naissance", "honore", "annule",
            "operateur", "type_vaccin", "rdv_cnam", "rdv_rappel",
        )
    ]
)

# Raw slot fields under their common names, all text.
RAW_SLOT = (
    "date", "id_centre", "nom_centre", "cp_centre", "nb_heures", "nb_lignes",
    "nb_creneaux", "type_vaccin",
)

# Slot headers that differ from the common names, and common
# fields an operator does not deliver.
SLOT_HEADERS = {
    "maiia": {"date": "date_rdv"},
    "keldoc": {},
    "doctolib": {"nb_creneaux": "nb_créneaux"},
}
SLOT_ABSENT = {"maiia": ("nb_creneaux", "type_vaccin"), "keldoc": (), "doctolib": ()}

# Normalised slot, in publication order; ``date_texte`` is the date as delivered.
SLOT = (
    "date", "date_texte", "id_centre", "nom_centre", "cp_centre", "code_departement",
    "code_region", "region", "nb_heures", "nb_lignes", "nb_creneaux",
    "type_vaccin", "operateur",
)

# Additive measures and the keys of the centre-day table.
MEASURES = ("nb", "nb_rdv_cnam", "nb_rdv_rappel")
CENTRE_DAY_KEYS = (
    "date_rdv", "id_centre", "nom_centre", "cp_centre", "code_departement",
    "code_region", "region", "rang_vaccinal", "operateur", "type_vaccin",
)

# Defaults of the published tables.
DEFAULT_THRESHOLD = 0.001
DEFAULT_WEEKS = 5
DEFAULT_FIRST_DAY = "2021-01-18"
