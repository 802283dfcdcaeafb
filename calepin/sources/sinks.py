"""Writers.

Stored tables are Parquet, replaced by partition, so running a job again
changes nothing. Published tables are CSV folders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calepin.functions.dates import as_day
from calepin.model import ARS_REGIONS
from calepin.operators.rollups import SORT_KEYS

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes at the same time; the first error is raised.

    Each is a Spark job of its own, so that a small one does not wait for the
    last tasks of a large one.
    """
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
        for job in started:
            job.result()


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions present in ``df`` and leave all others alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def swap_folder(spark: SparkSession, new: str, place: str) -> None:
    """Put a complete new folder in the place of an old one. The old one goes
    only when the new one stands; a run that fails before leaves it alone."""
    jvm = spark._jvm.org.apache.hadoop.fs
    new_path, place_path, old_path = (jvm.Path(x) for x in (new, place, f"{new}.old"))
    files = place_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(place_path) and not files.rename(place_path, old_path):
        raise OSError(f"cannot move {place}")
    if not files.rename(new_path, place_path):
        files.rename(old_path, place_path)
        raise OSError(f"cannot move {new} to {place}")
    files.delete(old_path, True)


def write_publication(
    df: DataFrame, path: str, as_of: str | dt.date, *columns: str, separator: str | None = None
) -> None:
    """Replace all that a table holds for one publication date, so that a
    second run leaves nothing of the first. CSV if a separator is given.

    The rows are written beside the table's folders, under a name that readers
    pass over, and then swapped in.
    """
    day = as_day(as_of).isoformat()
    beside = f"{path}/_date_publication={day}.{uuid.uuid4().hex}"
    writer = df.write
    if columns:
        writer = writer.partitionBy(*columns)
    if separator:
        writer.options(**CSV_OPTIONS).option("sep", separator).csv(beside)
    else:
        writer.parquet(beside)
    swap_folder(df.sparkSession, beside, f"{path}/date_publication={day}")


def write_csv(
    df: DataFrame,
    path: str,
    sort: tuple[str, ...] = (),
    separator: str = ",",
    gzip: bool = False,
) -> None:
    """CSV with a header, nulls printed as nothing.

    ``sort`` orders rows through the part files. The sort is a range
    partitioning, so a large table stays spread over many tasks.
    """
    ordered = df.orderBy(*sort) if sort else df
    writer = ordered.write.mode("overwrite").options(**CSV_OPTIONS).option("sep", separator)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_by_region(daily: DataFrame, path: str, regions: tuple[str, ...] = ARS_REGIONS) -> None:
    """One CSV folder per region, rows in key order.

    The range partitioning runs over the region and all row keys, so a region
    that holds a large share of the rows is spread over several tasks while
    the small ones share a task. The region is copied because the partition
    column leaves the files.
    """
    (
        daily.filter(F.col("region").isin(*regions))
        .withColumn("region_part", F.col("region"))
        .orderBy("region_part", *SORT_KEYS["ars"])
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .partitionBy("region_part")
        .csv(path)
    )
