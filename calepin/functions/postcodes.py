"""Postcode rules: format check, padding and department."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_postcode(text: Column) -> Column:
    """Four or five digits, possibly followed by `` Cedex``; a blank is wrong."""
    return F.coalesce(text.rlike("^[0-9]{4,5}( Cedex)?$"), F.lit(False))


def _pad(text: Column) -> Column:
    return F.when(F.length(text) == 4, F.concat(F.lit("0"), text)).otherwise(text)


def pad_booking_postcode(text: Column) -> Column:
    """Leading zero for four characters that do not start with one."""
    return F.when(text.startswith("0"), text).otherwise(_pad(text))


def pad_slot_postcode(text: Column) -> Column:
    """As for appointments, once a single leading space is gone."""
    stripped = F.when(text.startswith(" "), F.substr(text, F.lit(2))).otherwise(text)
    return F.when(text.startswith("0"), text).otherwise(_pad(stripped))


def department(postcode: Column) -> Column:
    """Department of a padded postcode; Corsica is split in two, overseas
    departments have three characters."""
    number = F.substring_index(postcode, " ", 1).try_cast("int")
    return (
        F.when(F.floor(number / 100).isin(200, 201), F.lit("2A"))
        .when(F.floor(number / 1000) == 20, F.lit("2B"))
        .when(postcode.startswith("97"), F.substring(postcode, 1, 3))
        .otherwise(F.substring(postcode, 1, 2))
    )
