"""Row checks on raw appointments, reject routing and error figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calepin.functions.dates import as_day, booking_day
from calepin.functions.postcodes import is_postcode
from calepin.functions.texts import three_valued
from calepin.model import DEFAULT_THRESHOLD, NOT_PROVIDED, OPERATORS, RAW_BOOKING


def with_operator_constants(raw: DataFrame) -> DataFrame:
    """Fields whose content is fixed per operator.

    The vaccine type of maiia is discarded and doctolib delivers no birth year.
    """
    operator = F.col("operateur")
    return raw.withColumns(
        {
            "type_vaccin": F.when(operator == "maiia", F.lit(NOT_PROVIDED)).otherwise(
                F.col("type_vaccin")
            ),
            "annee_naissance": F.when(operator == "doctolib", F.lit(NOT_PROVIDED)).otherwise(
                F.col("annee_naissance")
            ),
        }
    )


def reject_reason() -> Column:
    """Name of the first field that fails its check, null for a valid row."""
    checks = (
        ("honore", F.col("honore_lu").isNotNull()),
        ("annule", F.col("annule_lu").isNotNull()),
        ("date_rdv", F.col("jour_rdv").isNotNull()),
        ("date_creation", F.col("date_creation").isNull() | F.col("jour_creation").isNotNull()),
        ("cp_centre", is_postcode(F.col("cp_centre"))),
    )
    reason = F
    for field, passes in checks:
        reason = reason.when(~passes, F.lit(field))
    return reason


def tag_rejects(raw: DataFrame) -> DataFrame:
    """Raw rows with ``motif_rejet``, valid and rejected ones in one pass.

    Fields that have to be read to be checked stay at hand as read: the dates
    ``jour_rdv`` and ``jour_creation``, the flags ``honore_lu``, ``annule_lu``.
    """
    operator = F.col("operateur")
    return (
        with_operator_constants(raw)
        .withColumns(
            {
                "jour_rdv": booking_day(F.col("date_rdv"), operator),
                "jour_creation": booking_day(F.col("date_creation"), operator),
                "honore_lu": three_valued(F.col("honore")),
                "annule_lu": three_valued(F.col("annule")),
            }
        )
        .withColumn("motif_rejet", reject_reason())
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("motif_rejet").isNull()).drop("motif_rejet")


def rejected_rows(tagged: DataFrame, as_of: str | dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows as checked (the fields that are fixed per operator hold
    their fixed value), with operator, reason and processing date."""
    return tagged.filter(F.col("motif_rejet").isNotNull()).select(
        *keep,
        *RAW_BOOKING,
        "operateur",
        "motif_rejet",
        F.lit(as_day(as_of)).alias("date_traitement"),
    )


def reject_counts(tagged: DataFrame) -> DataFrame:
    """Rejected rows per operator and reason."""
    return (
        tagged.filter(F.col("motif_rejet").isNotNull())
        .groupBy("operateur", "motif_rejet")
        .agg(F.count("*").alias("nb_lignes"))
    )


def with_every_operator(
    figures: DataFrame, expected: tuple[str, ...], constants: dict[str, object] | None = None
) -> DataFrame:
    """Figures per operator. An expected one that has none gets zero for each
    count (``tot_``, ``err_`` and ``nb_`` columns), the ``constants``, and null
    for the rest."""
    names = ", ".join(f"('{name}')" for name in expected)
    every = figures.sparkSession.sql(f"select * from values {names} as t(operateur)")
    counts = [name for name in figures.columns if name.startswith(("tot_", "err_", "nb_"))]
    filled = every.join(figures, "operateur", "left").na.fill(0, counts)
    return filled.na.fill(constants) if constants else filled


def row_figures() -> list[Column]:
    return [
        F.count("*").alias("tot_row"),
        F.count_if(F.col("motif_rejet").isNotNull()).alias("err_row"),
    ]


def rate_figures(threshold: float) -> dict[str, Column]:
    rate = F.when(F.col("tot_row") > 0, F.col("err_row") / F.col("tot_row"))
    return {"taux_erreur": rate, "alerte": F.coalesce(rate > F.lit(float(threshold)), F.lit(False))}


def error_report(
    tagged: DataFrame,
    as_of: str | dt.date,
    threshold: float = DEFAULT_THRESHOLD,
    expected: tuple[str, ...] = (),
    also: list[Column] = (),
    constants: dict[str, object] | None = None,
) -> DataFrame:
    """Rows, errors, error rate and alert per operator.

    Operators in ``expected`` that delivered nothing appear with no rows.
    ``also`` are further aggregates to compute on the way, ``constants`` their
    values for an operator without rows.
    """
    report = tagged.groupBy("operateur").agg(
        *row_figures(),
        *also,
    )
    further = report.columns[3:]
    if expected:
        report = with_every_operator(report, expected, constants)
    return report.select(
        F.lit(as_day(as_of)).alias("date_traitement"),
        "operateur",
        "tot_row",
        "err_row",
        *(column.alias(name) for name, column in rate_figures(threshold).items()),
        *further,
    )


def check_operator(name: str) -> str:
    if name not in OPERATORS:
        raise ValueError(f"unknown operator: {name}")
    return name
