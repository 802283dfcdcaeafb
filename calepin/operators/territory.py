"""Department and region lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calepin.model import ARS_REGIONS, TERRITORY


def territory_dimension(spark: SparkSession) -> DataFrame:
    """``code_departement, code_region, region`` for the 101 departments.

    A literal relation: its size is fixed by the country, not by the data.
    """
    rows = ", ".join(f"('{department}', '{code}', '{name}')" for department, code, name in TERRITORY)
    return spark.sql(f"select * from values {rows} as t(code_departement, code_region, region)")


def territory_from_tables(departments: DataFrame, regions: DataFrame) -> DataFrame:
    """The same dimension from delivered tables: departments with ``dep`` and
    ``reg``, regions with ``reg`` and the short name ``libelle3``."""
    return departments.select(F.col("dep").alias("code_departement"), "reg").join(
        regions.select("reg", F.col("libelle3").alias("region")), "reg", "left"
    ).select("code_departement", F.col("reg").alias("code_region"), "region")


def with_region(df: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Add ``code_region`` and ``region``; an unknown department gives null.

    The built-in dimension is broadcast, having 101 rows whatever the data. A
    dimension passed by the caller carries no hint, so Spark broadcasts it
    only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if dimension is None:
        return df.join(F.broadcast(territory_dimension(df.sparkSession)), "code_departement", "left")
    # Both parts of Corsica form one region, whatever the given table says.
    corsica = F.col("code_departement").isin("2A", "2B")
    return df.join(dimension, "code_departement", "left").withColumns(
        {
            "code_region": F.when(corsica, F.lit("94")).otherwise(F.col("code_region")),
            "region": F.when(corsica, F.lit("COR")).otherwise(F.col("region")),
        }
    )


def region_extract(df: DataFrame, region: str, allowed: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of one region; a name outside the list is an error."""
    if region not in (allowed or ARS_REGIONS):
        raise ValueError(f"unknown region: {region}")
    return df.filter(F.col("region") == region)
