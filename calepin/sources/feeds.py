"""Readers for the operators' CSV drops and for the stored tables."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calepin.functions.dates import as_day, or_fail, strict_iso_day
from calepin.functions.texts import missing_to_null
from calepin.model import (
    BOOKING,
    CENTRE_DAY_KEYS,
    MEASURES,
    NOT_PROVIDED,
    OPERATORS,
    RAW_BOOKING,
    RAW_SLOT,
    SEPARATORS,
    SLOT_ABSENT,
    SLOT_HEADERS,
)
from calepin.operators.normalization import union_feeds
from calepin.operators.validation import check_operator


def _part_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files below the given files and folders; no content is read."""
    return sorted(spark.read.text(paths, recursiveFileLookup=True).inputFiles())


def read_text_parts(
    spark: SparkSession, paths: str | list[str], separator: str = ",", multi_line: bool = False
) -> list[DataFrame]:
    """CSV with every column as text, named by its header, blanks as null: one
    table per header found, since part files may hold other columns or the
    same in another order. A file that does not have the header it was read by
    fails the job. Each table keeps the file's path as ``fichier``.

    Fields with line breaks need ``multi_line``, which reads a file in one
    task; without it a file is split.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = partial(spark.read.csv, sep=separator, header=True, quote='"', escape='"', multiLine=multi_line)
    files = _part_files(spark, paths)
    if not files:
        raise ValueError(f"no file below {', '.join(paths)}")
    # One look at the first line of each file, several files at a time.
    with ThreadPoolExecutor(max_workers=8) as pool:
        headers = list(pool.map(lambda file: tuple(reader(file).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        groups.setdefault(header, []).append(file)
    tables = []
    for header, own in groups.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        table = reader(own, schema=schema, enforceSchema=False)
        tables.append(
            table.select(*(missing_to_null(name) for name in header), F.col("_metadata.file_path").alias("fichier"))
        )
    return tables


def read_text_table(
    spark: SparkSession, paths: str | list[str], separator: str = ",", multi_line: bool = False
) -> DataFrame:
    """All parts of a CSV table, columns matched by name."""
    parts = [part.drop("fichier") for part in read_text_parts(spark, paths, separator, multi_line)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def read_booking_drop(
    spark: SparkSession,
    operator: str,
    paths: str | list[str],
    multi_line: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw appointments of one operator, columns picked by name."""

    def raw(table: DataFrame) -> DataFrame:
        filled = []
        if operator == "doctolib":
            # Never delivered, respectively not in every delivery.
            filled = [n for n in ("annee_naissance", "motif_rdv") if n == "annee_naissance" or n not in table.columns]
        return table.select(
            *(F.lit(NOT_PROVIDED).alias(n) if n in filled else F.col(n) for n in RAW_BOOKING),
            F.lit(operator).alias("operateur"),
            *keep,
        )

    separator = SEPARATORS[check_operator(operator)]
    return union_feeds(*map(raw, read_text_parts(spark, paths, separator, multi_line)))


def read_slot_drop(
    spark: SparkSession, operator: str, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Raw slots of one operator under the common column names."""
    separator = SEPARATORS[check_operator(operator)]
    headers, absent = SLOT_HEADERS[operator], SLOT_ABSENT[operator]

    def raw(table: DataFrame) -> DataFrame:
        return table.select(
            *(
                (F.lit(NOT_PROVIDED) if name in absent else F.col(headers.get(name, name))).alias(name)
                for name in RAW_SLOT
            ),
            F.lit(operator).alias("operateur"),
        )

    return union_feeds(*map(raw, read_text_parts(spark, paths, separator, multi_line)))


def _no_rows(spark: SparkSession, names: tuple[str, ...]) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in (*names, "operateur")]
    return spark.createDataFrame([], T.StructType(fields))


def read_bookings(
    spark: SparkSession, drops: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """Raw appointments of all delivered feeds; a missing feed adds no rows."""
    feeds = [
        read_booking_drop(spark, name, drops[name], multi_line) for name in OPERATORS if name in drops
    ]
    return union_feeds(*feeds) if feeds else _no_rows(spark, RAW_BOOKING)


def read_slots(
    spark: SparkSession, drops: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """Raw slots of all delivered feeds; a missing feed adds no rows."""
    feeds = [
        read_slot_drop(spark, name, drops[name], multi_line) for name in OPERATORS if name in drops
    ]
    return union_feeds(*feeds) if feeds else _no_rows(spark, RAW_SLOT)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A delivered department or region table, all text."""
    return read_text_table(spark, path)


def read_published_bookings(
    spark: SparkSession, path: str, multi_line: bool = False
) -> DataFrame:
    """Normalised appointments from a published CSV; a bad date fails the job."""
    table = read_text_table(spark, path, multi_line=multi_line)
    return table.select(
        *(
            (strict_iso_day(F.col(f.name), f.name) if f.dataType == T.DateType() else F.col(f.name)).alias(f.name)
            for f in BOOKING
        )
    )


def read_centre_day_csv(spark: SparkSession, path: str) -> DataFrame:
    """Centre-day counts from CSV, with a date and whole numbers; a text that is
    neither fails the job."""
    table = read_text_table(spark, path)
    return table.select(
        strict_iso_day(F.col("date_rdv"), "date_rdv").alias("date_rdv"),
        *CENTRE_DAY_KEYS[1:],
        *(
            or_fail(F.col(name).try_cast("long"), F.col(name), f"{name} is not a whole number: ").alias(name)
            for name in MEASURES
        ),
    )


# Stored tables. ``operateur`` and ``date_publication`` are partition columns.

_PUBLICATION = T.StructField("date_publication", T.DateType())
CHECKED = T.StructType(
    [field for field in BOOKING if field.name != "operateur"]
    + [
        T.StructField("motif_rejet", T.StringType()),
        T.StructField("id_centre_absent", T.BooleanType()),
        T.StructField("annee_naissance_absente", T.BooleanType()),
        T.StructField("brut", T.StructType([T.StructField(n, T.StringType()) for n in RAW_BOOKING])),
        _PUBLICATION,
        T.StructField("operateur", T.StringType()),
    ]
)
COUNTED = T.StructType(
    [field for name in CENTRE_DAY_KEYS for field in BOOKING if field.name == name]
    + [T.StructField(name, T.LongType()) for name in MEASURES]
    + [_PUBLICATION]
)


def read_publication(
    spark: SparkSession, path: str, schema: T.StructType, as_of: str | dt.date
) -> DataFrame:
    """A stored table's rows of one publication. Only its own folder is
    opened, whatever other publications the table holds; none gives no rows."""
    day = as_day(as_of).isoformat()
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/date_publication={day}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_checked(spark: SparkSession, path: str, as_of: str | dt.date) -> DataFrame:
    """Checked appointments of one publication, valid and rejected."""
    return read_publication(spark, path, CHECKED, as_of)


def read_normalized(
    spark: SparkSession, path: str, as_of: str | dt.date, without: tuple[str, ...] = ()
) -> DataFrame:
    """Normalised appointments of one publication, less some operators."""
    table = read_checked(spark, path, as_of).filter(F.col("motif_rejet").isNull())
    if without:
        table = table.filter(~F.col("operateur").isin(*without))
    return table.select(*BOOKING.fieldNames())


def read_counted(spark: SparkSession, path: str, as_of: str | dt.date) -> DataFrame:
    """Stored centre-day counts of one publication, missing keys included."""
    return read_publication(spark, path, COUNTED, as_of).drop("date_publication")


def read_report(
    spark: SparkSession, path: str, as_of: str | dt.date, schema: T.StructType
) -> DataFrame:
    """A stored error report of one publication."""
    day = as_day(as_of).isoformat()
    return spark.read.schema(schema).csv(f"{path}/date_publication={day}", sep=";", header=True, enforceSchema=False)
