"""Published counts.

The three measures are additive, so every table is a sum of them over its own
keys. A rollup therefore reads single appointments, a centre-day table or any
union of stored partial tables alike, and Spark combines on the map side
before each shuffle, which keeps a very frequent key cheap.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.functions.dates import publication_window, week_start
from calepin.model import (
    CENTRE_DAY_KEYS,
    DEFAULT_FIRST_DAY,
    DEFAULT_WEEKS,
    MEASURES,
    NOT_PROVIDED,
)
from calepin.operators.normalization import union_feeds

# Keys of the published tables, under their published names.
DAILY_KEYS = (
    "code_region", "region", "departement", "id_centre", "nom_centre",
    "rang_vaccinal", "type_vaccin", "date_rdv",
)
WEEKLY_KEYS = {
    "centre": (
        "code_region", "region", "departement", "id_centre", "nom_centre",
        "rang_vaccinal", "date_debut_semaine",
    ),
    "departement": ("code_region", "region", "departement", "rang_vaccinal", "date_debut_semaine"),
    "region": ("code_region", "region", "rang_vaccinal", "date_debut_semaine"),
    "national": ("rang_vaccinal", "date_debut_semaine"),
}

# Row order of the published files. The order of the centre table ends with
# the centre id, so that it is total.
SORT_KEYS = {
    "centre": (
        "region", "nom_centre", "departement", "date_debut_semaine", "rang_vaccinal", "id_centre",
    ),
    "departement": ("departement", "region", "date_debut_semaine", "rang_vaccinal"),
    "region": ("region", "date_debut_semaine", "rang_vaccinal"),
    "national": ("date_debut_semaine", "rang_vaccinal"),
    "ars": (
        "code_region", "region", "departement", "id_centre", "nom_centre",
        "rang_vaccinal", "date_rdv", "type_vaccin",
    ),
}


def effective(bookings: DataFrame) -> DataFrame:
    """Appointments neither marked as missed nor as cancelled; blanks count."""
    return bookings.filter(
        ~F.col("honore").eqNullSafe("false") & ~F.col("annule").eqNullSafe("true")
    )


def measured(bookings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per effective appointment: the centre-day keys and measures."""
    return effective(bookings).select(
        *keep,
        *CENTRE_DAY_KEYS,
        F.lit(1).cast("long").alias("nb"),
        (F.col("rdv_cnam").eqNullSafe("true")).cast("long").alias("nb_rdv_cnam"),
        (F.col("rdv_rappel").eqNullSafe("true")).cast("long").alias("nb_rdv_rappel"),
    )


def _sums(df: DataFrame, keys, measures=MEASURES) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in measures))


def with_complete_keys(df: DataFrame) -> DataFrame:
    """Rows with all centre-day keys; the published tables hold no others.

    One test per key, so that each reaches the scan or vanishes on its own.
    """
    return df.filter(reduce(and_, (F.col(key).isNotNull() for key in CENTRE_DAY_KEYS)))


def centre_day_with_gaps(bookings: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Centre-day counts including the groups with a missing key, kept apart
    per value of the columns ``per``."""
    return _sums(measured(bookings, per), (*per, *CENTRE_DAY_KEYS))


def centre_day(bookings: DataFrame) -> DataFrame:
    """Counts per centre, day, dose, vaccine and operator."""
    return with_complete_keys(centre_day_with_gaps(bookings))


def merge_rollup(*partials: DataFrame) -> DataFrame:
    """One centre-day table out of several, whatever rows each one covers."""
    return _sums(union_feeds(*partials), CENTRE_DAY_KEYS)


def excluded_rows(counted: DataFrame) -> DataFrame:
    """How many appointments the missing keys keep out of the tables.

    ``counted`` is a table with measures from before ``with_complete_keys``.
    """
    gap = reduce(or_, (F.col(key).isNull() for key in CENTRE_DAY_KEYS))
    groups = {
        "nb_effectifs": F.lit(True),
        "nb_exclus_cle_nulle": gap,
        "nb_region_inconnue": F.col("region").isNull(),
        "nb_nom_centre_absent": F.col("nom_centre").isNull(),
    }
    return counted.agg(
        *(
            F.coalesce(F.sum(F.when(group, F.col("nb"))), F.lit(0)).alias(name)
            for name, group in groups.items()
        )
    )


def ars_daily(counted: DataFrame) -> DataFrame:
    """Daily counts per centre: every date, unknown doses included."""
    complete = with_complete_keys(counted).withColumnRenamed("code_departement", "departement")
    return _sums(complete, DAILY_KEYS)


def published_weeks(
    counted: DataFrame,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
) -> DataFrame:
    """Rows of the publication window with a known dose, and their Monday."""
    low, high = publication_window(first_day, as_of, weeks)
    return (
        with_complete_keys(counted)
        .filter(F.col("date_rdv").between(F.lit(low), F.lit(high)))
        .filter(F.col("rang_vaccinal") != NOT_PROVIDED)
        .withColumn("date_debut_semaine", week_start(F.col("date_rdv")))
        .withColumnRenamed("code_departement", "departement")
    )


def weekly(
    counted: DataFrame,
    level: str,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
) -> DataFrame:
    """Weekly counts at one level: centre, departement, region or national."""
    measures = MEASURES if level == "centre" else ("nb",)
    return _sums(published_weeks(counted, as_of, first_day, weeks), WEEKLY_KEYS[level], measures)


def coarser(finer: DataFrame, level: str) -> DataFrame:
    """Weekly counts at one level out of the table of a finer one."""
    return _sums(finer, WEEKLY_KEYS[level], ("nb",))


def weekly_hierarchy(
    counted: DataFrame,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
) -> DataFrame:
    """Department, region and national weekly counts in one result.

    Grouping sets copy their input once per level, so they run on the weekly
    department table and not on the appointments.
    """
    keys = [F.col(name) for name in WEEKLY_KEYS["departement"]]
    levels = [[F.col(name) for name in WEEKLY_KEYS[level]] for level in ("departement", "region", "national")]
    departments = weekly(counted, "departement", as_of, first_day, weeks)
    return (
        departments.groupingSets(levels, *keys)
        .agg(
            F.sum("nb").alias("nb"),
            F.grouping("departement").alias("sans_departement"),
            F.grouping("region").alias("sans_region"),
        )
        .select(
            F.when(F.col("sans_region") == 1, F.lit("national"))
            .when(F.col("sans_departement") == 1, F.lit("region"))
            .otherwise(F.lit("departement"))
            .alias("niveau"),
            *WEEKLY_KEYS["departement"],
            "nb",
        )
    )
