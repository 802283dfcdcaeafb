"""Warnings on completeness and plausibility, one row per operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calepin.functions.dates import as_day
from calepin.model import DEFAULT_THRESHOLD
from calepin.operators.validation import error_report, rate_figures, row_figures, with_every_operator

FRIDAY = 4


def _warnings(no_centre: Column, no_birth_year: Column, day: Column, friday: Column) -> list[Column]:
    return [
        F.count_if(no_centre).alias("nb_id_centre_absent"),
        F.count_if(no_birth_year).alias("nb_annee_naissance_absente"),
        F.max(F.year(day)).cast("long").alias("annee_max"),
        F.coalesce(F.max(F.year(day)) >= 2022, F.lit(False)).alias("rdv_2022_ou_apres"),
        F.bool_or(friday).alias("publie_un_vendredi"),
    ]


def quality_warnings(valid: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Warnings from the valid rows of ``tag_rejects``."""
    return valid.groupBy("operateur").agg(
        *_warnings(
            F.col("id_centre").isNull(),
            F.col("annee_naissance").isNull(),
            F.col("jour_rdv"),
            F.lit(as_day(as_of).weekday() == FRIDAY),
        )
    )


def _stored_warnings(friday: Column) -> list[Column]:
    """Warnings out of checked appointments; they look at valid rows only."""
    valid = F.col("motif_rejet").isNull()
    return _warnings(
        valid & F.col("id_centre_absent"),
        valid & F.col("annee_naissance_absente"),
        F.when(valid, F.col("date_rdv")),
        friday,
    )


def stored_figures(
    checked: DataFrame,
    as_of: str | dt.date,
    threshold: float = DEFAULT_THRESHOLD,
    expected: tuple[str, ...] = (),
) -> DataFrame:
    """Error report and warnings in one pass over the stored table of checked
    appointments. A feed without rows has no latest year, and neither has one
    without valid rows."""
    friday = as_day(as_of).weekday() == FRIDAY
    silent = {"rdv_2022_ou_apres": False, "publie_un_vendredi": friday}
    return error_report(checked, as_of, threshold, expected, _stored_warnings(F.lit(friday)), silent)


def lot_figures(
    checked: DataFrame, keys: tuple[str, ...], threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """The same figures per ingested lot, by the lot's own day."""
    friday = F.weekday("date_publication") == FRIDAY
    figures = checked.groupBy(*keys).agg(*row_figures(), *_stored_warnings(friday))
    return figures.withColumns(rate_figures(threshold))


def slot_quality(slots: DataFrame, expected: tuple[str, ...] = ()) -> DataFrame:
    """Rows, missing postcodes and unreadable dates per slot feed.

    Operators in ``expected`` without a feed appear with no rows.
    """
    figures = slots.groupBy("operateur").agg(
        F.count("*").alias("tot_row"),
        F.count_if(F.col("cp_centre").isNull()).alias("nb_cp_centre_absent"),
        F.count_if(F.col("date_texte").isNotNull() & F.col("date").isNull()).alias("nb_date_illisible"),
    )
    return with_every_operator(figures, expected) if expected else figures
