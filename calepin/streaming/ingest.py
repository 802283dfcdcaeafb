"""Ingest of new and corrected appointment files as they are delivered.

The stream watches file names. Every drop is a *lot* of its own: its checked
rows, rejects, figures and centre-day counts are stored under the lot's
partition, and a drop read again (because a part file came late or was
corrected, or because a run is repeated) replaces its lot. A ledger keeps each
lot's files with their times of change; a run compares it with the landing
folder, since a stream passes over a path it has seen. Counts add up, so there
is no state and no watermark.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calepin.model import BOOKING, DEFAULT_THRESHOLD, RAW_BOOKING
from calepin.operators.normalization import checked_bookings, union_feeds
from calepin.operators.quality import lot_figures
from calepin.operators.rollups import centre_day_with_gaps, merge_rollup
from calepin.sources.drops import booking_drops, latest_drops
from calepin.sources.feeds import CHECKED, COUNTED, read_booking_drop
from calepin.sources.sinks import write_partitions, write_together

CHECKED_LOTS = "rdv_controles_lots"
COUNTED_LOTS = "centre_jour_lots"
REJECT_LOTS = "rejets_lots"
FIGURE_LOTS = "rapport_err_lots"
LEDGER = "fichiers_lots"
LOT_KEYS = ("date_publication", "depot_operateur", "lot")
_LOT_FIELDS = [
    T.StructField("date_publication", T.DateType()),
    T.StructField("depot_operateur", T.StringType()),
    T.StructField("lot", T.LongType()),
]
_FILE = "path string, modificationTime timestamp, length long, content binary"
_LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("depot", T.StringType()),
    ]
)
_REJECT = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*RAW_BOOKING, "operateur", "motif_rejet")]
    + [T.StructField("date_traitement", T.DateType())]
)
_FIGURES = T.StructType(
    [
        T.StructField("tot_row", T.LongType()),
        T.StructField("err_row", T.LongType()),
        T.StructField("nb_id_centre_absent", T.LongType()),
        T.StructField("nb_annee_naissance_absente", T.LongType()),
        T.StructField("annee_max", T.LongType()),
        T.StructField("rdv_2022_ou_apres", T.BooleanType()),
        T.StructField("publie_un_vendredi", T.BooleanType()),
        T.StructField("taux_erreur", T.DoubleType()),
        T.StructField("alerte", T.BooleanType()),
    ]
)


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme: sources spell it differently."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _with_lot(drops: DataFrame) -> DataFrame:
    """A drop's lot keys: its day, its operator and a number of its path."""
    return drops.withColumns(
        {
            "date_publication": F.col("date_depot"),
            "depot_operateur": F.col("operateur"),
            "lot": F.xxhash64(_plain(F.col("depot"))),
        }
    )


def _lot_table(
    spark: SparkSession, path: str, fields: T.StructType, lots: list | None = None
) -> DataFrame:
    """A table of lots; of the given lots only their own folders are opened."""
    schema = T.StructType([f for f in fields if f.name not in LOT_KEYS] + _LOT_FIELDS)
    reader = spark.read.schema(schema).option("basePath", path)
    if lots is None:
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            lots = []
    if not lots:
        return spark.createDataFrame([], schema)
    parts = [
        f"{path}/date_publication={lot.date_publication}/depot_operateur={lot.depot_operateur}/lot={lot.lot}"
        for lot in lots
    ]
    kept = [part for part in parts if _exists(spark, part)]  # a lot without rejects has no folder there
    return reader.parquet(*kept) if kept else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Path and time of change of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.csv*").load(paths).select("path", "modificationTime")


def store_lot(
    batch: DataFrame, out: str, threshold: float = DEFAULT_THRESHOLD, multi_line: bool = False
) -> None:
    """Store the drops that the files named in ``batch`` belong to, whole."""
    spark = batch.sparkSession
    # Drops of one micro-batch, at most as many as it has files.
    drops = (
        booking_drops(batch.select("path")).groupBy("operateur").agg(F.collect_set("depot").alias("depots")).collect()
    )
    if not drops:
        return
    # One reader per operator and header; the lot comes from each file's path.
    raw = union_feeds(
        *(
            read_booking_drop(spark, drop.operateur, sorted(drop.depots), multi_line, keep=("fichier",))
            for drop in drops
        )
    )
    depots = [depot for drop in drops for depot in drop.depots]
    files = _files(spark, depots)
    ledger = _with_lot(booking_drops(files.select("path")).join(files, "path")).select(
        *_LEDGER.fieldNames(), *LOT_KEYS
    )
    # A row per file of the micro-batch's drops.
    lot_of = ledger.select(_plain(F.col("path")).alias("fichier"), *LOT_KEYS)
    with_lot = raw.withColumn("fichier", _plain(F.col("fichier"))).join(F.broadcast(lot_of), "fichier")
    checked = checked_bookings(with_lot.drop("fichier"), keep=LOT_KEYS)
    write_partitions(checked, f"{out}/{CHECKED_LOTS}", *LOT_KEYS)

    lots = ledger.select(*LOT_KEYS).distinct().collect()
    stored = _lot_table(spark, f"{out}/{CHECKED_LOTS}", CHECKED, lots)
    rejects = stored.filter(F.col("motif_rejet").isNotNull()).select(
        "brut.*", F.col("depot_operateur").alias("operateur"), "motif_rejet",
        F.col("date_publication").alias("date_traitement"), *LOT_KEYS,
    )
    counted = centre_day_with_gaps(stored.filter(F.col("motif_rejet").isNull()), LOT_KEYS)
    # Lots that had rejects or counts once and have none now lose theirs.
    for table in (REJECT_LOTS, COUNTED_LOTS):
        _drop_lots(spark, f"{out}/{table}", lots)
    write_together(
        spark,
        partial(write_partitions, rejects, f"{out}/{REJECT_LOTS}", *LOT_KEYS),
        partial(write_partitions, counted, f"{out}/{COUNTED_LOTS}", *LOT_KEYS),
        partial(write_partitions, lot_figures(stored, LOT_KEYS, threshold), f"{out}/{FIGURE_LOTS}", *LOT_KEYS),
    )
    # Last: a run that fails before is repeated for these files.
    write_partitions(ledger, f"{out}/{LEDGER}", *LOT_KEYS)


def _drop_lots(spark: SparkSession, path: str, lots: list) -> None:
    for lot in lots:
        place = spark._jvm.org.apache.hadoop.fs.Path(
            f"{path}/date_publication={lot.date_publication}/depot_operateur={lot.depot_operateur}/lot={lot.lot}"
        )
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def ledger_of(spark: SparkSession, out: str, lots: list | None = None) -> DataFrame:
    """Files ingested, with their drop, lot and time of change."""
    return _lot_table(spark, f"{out}/{LEDGER}", _LEDGER, lots)


def corrected_files(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """Files that changed after they were ingested."""
    known = ledger_of(spark, out).select("path", F.col("modificationTime").alias("read_at"))
    changed = _files(spark, landing).join(known, "path").filter("modificationTime <> read_at")
    return changed.select("path")


def ingest_new_drops(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    max_files: int = 1000,
    multi_line: bool = False,
    threshold: float = DEFAULT_THRESHOLD,
) -> None:
    """Store every file not seen by an earlier run with this checkpoint, and
    every file that changed since it was stored."""
    # The content column stays in the schema but is never read.
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv*")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
    )
    query = (
        files.writeStream.foreachBatch(lambda batch, _: store_lot(batch, out, threshold, multi_line))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store_lot(corrected_files(spark, landing, out), out, threshold, multi_line)


def current_lots(spark: SparkSession, out: str, as_of: str | dt.date | None) -> list | None:
    """All lots (None), or per operator the drop that counts as of a day, by
    the rule of the batch job: at most one an operator."""
    if as_of is None:
        return None
    ledger = ledger_of(spark, out)
    drops = ledger.select("depot", F.col("depot_operateur").alias("operateur"), F.col("date_publication").alias("date_depot"))
    return _with_lot(latest_drops(drops, as_of)).select(*LOT_KEYS).collect()


def _current(
    spark: SparkSession, out: str, table: str, fields: T.StructType, as_of: str | dt.date | None
) -> DataFrame:
    return _lot_table(spark, f"{out}/{table}", fields, current_lots(spark, out, as_of))


def ingested_bookings(
    spark: SparkSession, out: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Normalised appointments of the ingested files.

    Without ``as_of`` the drops count as slices of one delivery and all are
    taken; with it each is a full picture and the newest per operator counts.
    """
    table = _current(spark, out, CHECKED_LOTS, CHECKED, as_of)
    return table.filter(F.col("motif_rejet").isNull()).select(*BOOKING.fieldNames())


def ingested_rejects(
    spark: SparkSession, out: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Rejected rows of the ingested files."""
    return _current(spark, out, REJECT_LOTS, _REJECT, as_of).select(*_REJECT.fieldNames())


def ingested_figures(
    spark: SparkSession, out: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Error report and warnings per lot."""
    table = _current(spark, out, FIGURE_LOTS, _FIGURES, as_of)
    return table.withColumnRenamed("depot_operateur", "operateur")


def ingested_centre_day(
    spark: SparkSession, out: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Centre-day counts merged over the lots, missing keys included."""
    return merge_rollup(_current(spark, out, COUNTED_LOTS, COUNTED, as_of).select(*_counted_columns()))


def _counted_columns() -> list[str]:
    return [f.name for f in COUNTED if f.name != "date_publication"]
