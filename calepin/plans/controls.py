"""Functional controls on the stored appointments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from calepin.operators.controls import control_table, rule_1, rule_2, rule_summary
from calepin.plans import layout
from calepin.sources.feeds import read_normalized


def control_bookings(
    spark: SparkSession,
    out: str,
    as_of: str | dt.date,
    publication: str | dt.date | None = None,
    week_number_only: bool = False,
) -> dict[str, DataFrame]:
    """Breaches of both rules and their summary, for one publication.

    ``as_of`` is the day from which weeks count as past.
    """
    table = control_table(
        read_normalized(spark, layout.stored(out, layout.CHECKED), publication or as_of)
    )
    return {
        "rg1": rule_1(table),
        "rg2": rule_2(table, as_of, week_number_only),
        "resume": rule_summary(table, as_of, week_number_only),
    }
