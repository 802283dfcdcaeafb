"""Normalised appointments to published tables."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from calepin.model import ARS_REGIONS, DEFAULT_FIRST_DAY, DEFAULT_WEEKS
from calepin.operators.rollups import (
    SORT_KEYS,
    ars_daily,
    centre_day_with_gaps,
    coarser,
    excluded_rows,
    merge_rollup,
    weekly,
)
from calepin.plans import layout
from calepin.sources.feeds import read_normalized, read_publication
from calepin.sources.sinks import (
    write_by_region,
    write_csv,
    write_publication,
    write_together,
)

OPEN_DATA = {
    "par_centre": "centre",
    "par_dep": "departement",
    "par_reg": "region",
    "national": "national",
}


def store(df: DataFrame, out: str, table: str, as_of: str | dt.date) -> DataFrame:
    """Store a table of one publication, and read it back."""
    path = layout.stored(out, table)
    write_publication(df, path, as_of)
    schema = df.schema.add("date_publication", "date")
    return read_publication(df.sparkSession, path, schema, as_of).drop("date_publication")


def write_published_tables(
    counted: DataFrame,
    out: str,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
    regions: tuple[str, ...] = ARS_REGIONS,
) -> None:
    """Weekly tables, daily table whole and by region, and excluded rows.

    The daily and the weekly centre table are aggregated once and stored. Both
    forms of the daily table come from it, and each weekly level from the one
    below.
    """
    path = partial(layout.published, out, as_of)
    spark = counted.sparkSession

    def write_weeks() -> None:
        centre = store(weekly(counted, "centre", as_of, first_day, weeks), out, layout.WEEKLY, as_of)
        tables = {"centre": centre, "departement": coarser(centre, "departement")}
        for level, finer in (("region", "departement"), ("national", "region")):
            tables[level] = coarser(tables[finer], level)
        write_together(
            spark,
            *(
                partial(write_csv, tables[level], path("opendata", name), SORT_KEYS[level])
                for name, level in OPEN_DATA.items()
            ),
        )

    def write_days() -> None:
        daily = store(ars_daily(counted), out, layout.DAILY, as_of)
        write_together(
            spark,
            partial(write_csv, daily, path("prise_rdv"), SORT_KEYS["ars"]),
            partial(write_by_region, daily, path("ars"), regions),
        )

    write_together(
        spark, write_weeks, write_days, partial(write_csv, excluded_rows(counted), path("exclusions"))
    )


def store_counted(counted: DataFrame, out: str, as_of: str | dt.date) -> DataFrame:
    """Store centre-day counts, and read them back.

    All tables come from the stored counts: the appointments are aggregated
    once, and a lost executor costs a rollup and not that aggregation.
    """
    return store(counted, out, layout.CENTRE_DAY, as_of)


def publish(
    spark: SparkSession,
    out: str,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
    regions: tuple[str, ...] = ARS_REGIONS,
    without: tuple[str, ...] = (),
) -> None:
    """All published tables from the stored appointments of ``as_of``.

    ``without`` leaves operators out, for instance those with an alert.
    """
    bookings = read_normalized(spark, layout.stored(out, layout.CHECKED), as_of, without)

    def rollups() -> None:
        counted = store_counted(centre_day_with_gaps(bookings), out, as_of)
        write_published_tables(counted, out, as_of, first_day, weeks, regions)

    raw_path = layout.published(out, as_of, "prise_rdv-raw")
    write_together(spark, rollups, partial(write_csv, bookings, raw_path, gzip=True))


def publish_from_partials(
    partials: list[DataFrame],
    out: str,
    as_of: str | dt.date,
    first_day: str | dt.date = DEFAULT_FIRST_DAY,
    weeks: int = DEFAULT_WEEKS,
    regions: tuple[str, ...] = ARS_REGIONS,
) -> None:
    """The same tables from centre-day counts of separate slices."""
    counted = store_counted(merge_rollup(*partials), out, as_of)
    write_published_tables(counted, out, as_of, first_day, weeks, regions)
