"""Files to checked, normalised appointments."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from calepin.model import DEFAULT_THRESHOLD, OPERATORS
from calepin.operators.normalization import checked_bookings, stored_rejects
from calepin.operators.quality import stored_figures
from calepin.plans import layout
from calepin.sources.drops import chosen_drops
from calepin.sources.feeds import read_bookings, read_checked, read_report
from calepin.sources.sinks import write_publication, write_together


def process_bookings(
    spark: SparkSession,
    landing: str,
    out: str,
    as_of: str | dt.date,
    threshold: float = DEFAULT_THRESHOLD,
    multi_line: bool = False,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Take each operator's newest drop, check, normalise and store it, then
    write rejects and error report. Returns the stored report.

    ``dimension`` stands in for the built-in departments and regions.

    The raw files are parsed once, without a shuffle: each input split goes
    straight to one Parquet file. Everything else reads the stored table.
    """
    raw = read_bookings(spark, chosen_drops(spark, landing, as_of), multi_line)
    path = layout.stored(out, layout.CHECKED)
    write_publication(checked_bookings(raw, dimension=dimension), path, as_of, "operateur")
    checked = read_checked(spark, path, as_of)
    figures = stored_figures(checked, as_of, threshold, OPERATORS)
    # Few rejects come out of every split. They are gathered into full files
    # by no key, so that an operator with many is spread.
    rejects = stored_rejects(checked, as_of).hint("rebalance")
    report_path = layout.stored(out, layout.ERROR_REPORT)
    write_together(
        spark,
        partial(
            write_publication,
            figures.coalesce(1),  # one row per operator
            report_path,
            as_of,
            separator=";",
        ),
        partial(
            write_publication, rejects, layout.stored(out, layout.REJECTS), as_of, "operateur"
        ),
    )
    return read_report(spark, report_path, as_of, figures.schema)


def alerted_operators(report: DataFrame) -> tuple[str, ...]:
    """Operators over the error threshold; the report has a row for each."""
    return tuple(sorted(row.operateur for row in report.filter("alerte").collect()))
