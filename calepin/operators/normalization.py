"""Normalised appointments and slots.

``operateur`` is a column, so the three feeds go through one plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.functions import texts
from calepin.functions.dates import as_day, free_day
from calepin.functions.postcodes import department, pad_booking_postcode, pad_slot_postcode
from calepin.model import BOOKING, NOT_PROVIDED, RAW_BOOKING, SLOT
from calepin.operators.territory import with_region
from calepin.operators.validation import tag_rejects


def normalize_bookings(
    valid: DataFrame, keep: tuple[str, ...] = (), dimension: DataFrame | None = None
) -> DataFrame:
    """Normalised appointments from the rows of ``tag_rejects``; ``keep`` names
    extra columns to carry along."""
    operator, reason = F.col("operateur"), F.col("motif_rdv")
    # Upper and lower case are computed once here and read several times below.
    prepared = valid.withColumns(
        {
            "cp_centre": pad_booking_postcode(F.col("cp_centre")),
            "motif_rdv": texts.or_not_provided(reason),
            "motif_min": F.lower(reason),
            "motif_maj": F.upper(texts.or_not_provided(reason)),
        }
    )
    journey = F.col("parcours_rdv")
    normalized = prepared.withColumns(
        {
            "date_rdv": F.col("jour_rdv"),
            "date_creation": F.coalesce(F.col("jour_creation"), F.col("jour_rdv")),
            "code_departement": texts.or_not_provided(department(F.col("cp_centre"))),
            "cp_centre": texts.or_not_provided(F.col("cp_centre")),
            "id_centre": texts.or_not_provided(F.col("id_centre")),
            "annee_naissance": texts.or_not_provided(F.col("annee_naissance")),
            "rang_vaccinal": texts.dose(F.col("rang_vaccinal")),
            "parcours_rdv": F.when(
                (operator == "doctolib") & journey.isNull(), F.lit(NOT_PROVIDED)
            ).otherwise(journey),
            "honore": F.col("honore_lu"),
            "annule": F.col("annule_lu"),
            "type_vaccin": texts.vaccine(F.col("motif_min"), F.col("type_vaccin")),
            "rdv_cnam": texts.insurer_flag(F.col("motif_maj")),
            "rdv_rappel": texts.booster_flag(F.col("motif_maj")),
        }
    )
    return with_region(normalized, dimension).select(*keep, *BOOKING.fieldNames())


def normalize_slots(
    raw: DataFrame, keep: tuple[str, ...] = (), dimension: DataFrame | None = None
) -> DataFrame:
    """Normalised opening slots. Slots are not validated: a missing postcode or
    an unreadable date stays as a null."""
    keldoc = F.col("operateur") == "keldoc"
    counts = {
        name: F.when(keldoc, texts.slot_count(F.col(name))).otherwise(F.col(name))
        for name in ("nb_heures", "nb_lignes", "nb_creneaux")
    }
    prepared = raw.withColumns(
        {
            "date": free_day(F.col("date")),
            "date_texte": F.col("date"),
            "cp_centre": pad_slot_postcode(F.col("cp_centre")),
            **counts,
        }
    ).withColumn("code_departement", department(F.col("cp_centre")))
    return with_region(prepared, dimension).select(*keep, *SLOT)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, duplicates included."""
    first, *others = feeds
    for feed in others:
        first = first.unionByName(feed)
    return first


def checked_bookings(
    raw: DataFrame, keep: tuple[str, ...] = (), dimension: DataFrame | None = None
) -> DataFrame:
    """Valid and rejected appointments in one table, from one pass.

    Adds to the normalised columns ``motif_rejet`` (null if valid), two flags
    on fields that were blank, and for rejected rows the fields as checked in
    the struct ``brut``. Stored as columns this costs next to nothing, and the
    raw files need not be read a second time for rejects and figures.
    """
    rejected = F.col("motif_rejet").isNotNull()
    tagged = tag_rejects(raw).withColumns(
        {
            "id_centre_absent": F.col("id_centre").isNull(),
            "annee_naissance_absente": F.col("annee_naissance").isNull(),
            "brut": F.when(rejected, F.struct(*RAW_BOOKING)),
        }
    )
    flags = ("motif_rejet", "id_centre_absent", "annee_naissance_absente", "brut")
    return normalize_bookings(tagged, (*keep, *flags), dimension)


def stored_rejects(checked: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Rejected rows, out of ``checked_bookings``: as delivered but for the two
    fields whose content is fixed per operator."""
    return checked.filter(F.col("motif_rejet").isNotNull()).select(
        "brut.*", "operateur", "motif_rejet", F.lit(as_day(as_of)).alias("date_traitement")
    )
