"""Which delivered file counts as of a date.

A *drop* is what an operator delivers for a day: a file, or a folder of part
files, whose name holds the day and the operator.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calepin.functions.dates import as_day
from calepin.model import OPERATORS

# Name formats of the drops. The first group is the drop.
_OPERATOR = "|".join(OPERATORS)
_DROP = r"^((?:.*/)?{name}\.csv(?:\.gz)?)(?:/.*)?$"
BOOKING_DROP = _DROP.format(name=rf"([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})-({_OPERATOR})-rdv")
DOCTOLIB_DROP = _DROP.format(name=r"([0-9]{2}-[0-9]{2}-[0-9]{4})_vaccination_appointments")
SLOT_DROP = _DROP.format(name=rf"([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})-({_OPERATOR})-plages-horaires")


def list_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all CSV files under a folder. Names alone are listed: no task
    runs and no file is opened, whatever its size. A dated folder or a glob
    keeps the list to what can count."""
    files = spark.read.text(folder, recursiveFileLookup=True, pathGlobFilter="*.csv*").inputFiles()
    return spark.createDataFrame([(unquote(path),) for path in files], "path string")


def booking_drops(paths: DataFrame) -> DataFrame:
    """``path, depot, operateur, date_depot`` for the appointment files."""
    path = F.col("path")
    named = path.rlike(BOOKING_DROP)
    iso, french = (F.regexp_extract(path, name, 2) for name in (BOOKING_DROP, DOCTOLIB_DROP))
    return (
        paths.filter(named | path.rlike(DOCTOLIB_DROP))
        .select(
            "path",
            F.when(named, F.regexp_extract(path, BOOKING_DROP, 1))
            .otherwise(F.regexp_extract(path, DOCTOLIB_DROP, 1))
            .alias("depot"),
            F.when(named, F.regexp_extract(path, BOOKING_DROP, 3))
            .otherwise(F.lit("doctolib"))
            .alias("operateur"),
            F.when(named, F.try_to_date(iso, "yyyy-MM-dd"))
            .otherwise(F.try_to_date(french, "dd-MM-yyyy"))
            .alias("date_depot"),
        )
        .filter(F.col("date_depot").isNotNull())
    )


def slot_drops(paths: DataFrame) -> DataFrame:
    """``path, depot, operateur, date_depot`` for the slot files."""
    path = F.col("path")
    return (
        paths.filter(path.rlike(SLOT_DROP))
        .select(
            "path",
            F.regexp_extract(path, SLOT_DROP, 1).alias("depot"),
            F.regexp_extract(path, SLOT_DROP, 3).alias("operateur"),
            F.try_to_date(F.regexp_extract(path, SLOT_DROP, 2), "yyyy-MM-dd").alias("date_depot"),
        )
        .filter(F.col("date_depot").isNotNull())
    )


def latest_drops(drops: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Per operator, the newest drop not later than ``as_of``."""
    return (
        drops.filter(F.col("date_depot") <= F.lit(as_day(as_of)))
        .groupBy("operateur")
        .agg(
            F.max_by("depot", F.struct("date_depot", "depot")).alias("depot"),
            F.max("date_depot").alias("date_depot"),
        )
    )


def chosen_drops(
    spark: SparkSession, folder: str, as_of: str | dt.date, slots: bool = False
) -> dict[str, str]:
    """Operator to drop path, at most one each; a missing feed is left out."""
    try:
        paths = list_paths(spark, folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    named = slot_drops(paths) if slots else booking_drops(paths)
    return {row.operateur: row.depot for row in latest_drops(named, as_of).collect()}
