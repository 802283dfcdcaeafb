"""Functional control rules on normalised appointments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calepin.functions.dates import as_day, iso_week, monday, week_start


def control_table(bookings: DataFrame) -> DataFrame:
    """Cancelled, kept and missed appointments per centre, postcode and week."""
    missed = (F.col("annule") == "false") & (F.col("honore") == "false")
    return (
        bookings.withColumn("num_semaine", iso_week(F.col("date_rdv")))
        .withColumn("debut_semaine", week_start(F.col("date_rdv")))
        .filter(F.col("id_centre").isNotNull() & F.col("cp_centre").isNotNull())
        .filter(F.col("date_rdv").isNotNull())
        .groupBy("id_centre", "cp_centre", "num_semaine", "debut_semaine")
        .agg(
            F.count_if(F.col("annule") == "true").alias("rdv_annul"),
            F.count_if(F.col("honore") == "true").alias("rdv_honore"),
            F.count_if(missed).alias("rdv_non_honore"),
        )
    )


def _breaks_rule_1() -> Column:
    return F.col("rdv_annul") > F.col("rdv_honore")


def _breaks_rule_2(as_of: str | dt.date, week_number_only: bool) -> Column:
    day = as_day(as_of)
    if week_number_only:
        past = F.col("num_semaine") < F.lit(day.isocalendar().week)
    else:
        past = F.col("debut_semaine") < F.lit(monday(day))
    return past & (F.col("rdv_non_honore") > F.col("rdv_honore"))


def rule_1(control: DataFrame) -> DataFrame:
    """Groups with more cancelled than kept appointments."""
    return control.filter(_breaks_rule_1())


def rule_2(control: DataFrame, as_of: str | dt.date, week_number_only: bool = False) -> DataFrame:
    """Past groups with more missed than kept appointments.

    ``week_number_only`` compares bare ISO week numbers and so mixes years.
    """
    return control.filter(_breaks_rule_2(as_of, week_number_only))


def rule_summary(
    control: DataFrame, as_of: str | dt.date, week_number_only: bool = False
) -> DataFrame:
    """Per rule: breaching groups, distinct postcodes and distinct centres."""
    columns = []
    for name, broken in (
        ("rg1", _breaks_rule_1()),
        ("rg2", _breaks_rule_2(as_of, week_number_only)),
    ):
        columns += [
            F.count_if(broken).alias(f"{name}_groupes"),
            F.count_distinct(F.when(broken, F.col("cp_centre"))).alias(f"{name}_codes_postaux"),
            F.count_distinct(F.when(broken, F.col("id_centre"))).alias(f"{name}_centres"),
        ]
    # Only breaching groups reach the distinct counts.
    return control.filter(_breaks_rule_1() | _breaks_rule_2(as_of, week_number_only)).agg(*columns)
