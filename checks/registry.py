"""Registered queries: every operator and job, over whole derived feeds."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calepin.functions import dates, postcodes, texts
from calepin.model import (
    BOOKING,
    OPERATORS,
    RAW_BOOKING,
    SEPARATORS,
    SLOT,
    SLOT_ABSENT,
    SLOT_HEADERS,
)
from calepin.operators import controls, quality, rollups, validation
from calepin.operators.normalization import normalize_bookings, normalize_slots, union_feeds
from calepin.operators.territory import (
    region_extract,
    territory_dimension,
    territory_from_tables,
    with_region,
)
from calepin.plans import layout
from calepin.plans.bookings import process_bookings
from calepin.plans.controls import control_bookings
from calepin.plans.publication import OPEN_DATA, publish, publish_from_partials
from calepin.plans.slots import process_slots
from calepin.sources import drops, feeds, sinks
from calepin.sources.workspace import work_folder
from calepin.streaming.ingest import (
    ingest_new_drops,
    ingested_bookings,
    ingested_centre_day,
    ingested_figures,
    ingested_rejects,
)
from checks.fixtures import AS_OF, FIRST_DAY, THRESHOLD, WEEKS, given, raw_bookings, raw_slots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given order and ship dates run from 1995 on; the snapshot queries pick
# files as of this day.
SNAPSHOT_DAY = "1998-06-15"


def folder_for(spark: SparkSession) -> str:
    """A work folder below ``spark.checkpoint.dir``; a session of one process
    that names none, as in tests, gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return work_folder(shared or tempfile.mkdtemp(prefix="calepin-"))


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.tag_rejects(raw_bookings(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.valid_rows(tagged(spark, sf_dir))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_bookings(valid(spark, sf_dir), ("rdv_id",))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.measured(normalized(spark, sf_dir))


# Validation


@registered
def format_checks(spark, sf_dir):
    """Outcome of each field check on its own."""
    operator = F.col("operateur")
    created = F.col("date_creation")
    return raw_bookings(spark, sf_dir).select(
        "rdv_id",
        texts.three_valued(F.col("honore")).isNotNull().alias("honore_valide"),
        texts.three_valued(F.col("annule")).isNotNull().alias("annule_valide"),
        dates.booking_day(F.col("date_rdv"), operator).isNotNull().alias("date_rdv_valide"),
        (created.isNull() | dates.booking_day(created, operator).isNotNull()).alias(
            "date_creation_valide"
        ),
        postcodes.is_postcode(F.col("cp_centre")).alias("cp_centre_valide"),
    )


@registered
def reject_counts(spark, sf_dir):
    return validation.reject_counts(tagged(spark, sf_dir))


@registered
def rejects(spark, sf_dir):
    return validation.rejected_rows(tagged(spark, sf_dir), AS_OF, ("rdv_id",))


@registered
def valid_rdv(spark, sf_dir):
    return valid(spark, sf_dir).select("rdv_id", "operateur", *RAW_BOOKING)


@registered
def threshold_alert(spark, sf_dir):
    return validation.error_report(tagged(spark, sf_dir), AS_OF, THRESHOLD)


@registered
def quality_warnings(spark, sf_dir):
    return quality.quality_warnings(valid(spark, sf_dir), AS_OF)


# Normalisation


@registered
def normalized_rdv(spark, sf_dir):
    return normalized(spark, sf_dir)


@registered
def dose_norm(spark, sf_dir):
    raw = F.col("rang_vaccinal")
    return raw_bookings(spark, sf_dir).select("rdv_id", raw.alias("brut"), texts.dose(raw).alias("rang"))


@registered
def vaccine_type(spark, sf_dir):
    reason = F.col("motif_rdv")
    return validation.with_operator_constants(raw_bookings(spark, sf_dir)).select(
        "rdv_id",
        reason,
        texts.vaccine(F.lower(reason), F.col("type_vaccin")).alias("type_vaccin"),
    )


@registered
def motif_flags(spark, sf_dir):
    upper = F.upper(texts.or_not_provided(F.col("motif_rdv")))
    return raw_bookings(spark, sf_dir).select(
        "rdv_id",
        texts.insurer_flag(upper).alias("rdv_cnam"),
        texts.booster_flag(upper).alias("rdv_rappel"),
    )


@registered
def bool_norm(spark, sf_dir):
    return valid(spark, sf_dir).select(
        "rdv_id", *(texts.three_valued(F.col(name)).alias(name) for name in ("honore", "annule"))
    )


@registered
def date_parse(spark, sf_dir):
    operator = F.col("operateur")
    day = dates.booking_day(F.col("date_rdv"), operator)
    return raw_bookings(spark, sf_dir).select(
        "rdv_id",
        day.alias("date_rdv"),
        F.coalesce(dates.booking_day(F.col("date_creation"), operator), day).alias("date_creation"),
    )


@registered
def date_bounds(spark, sf_dir):
    """Days around both ends of what counts as a date, among the others."""
    ends = ("1677-09-21", "1677-09-22", "1677-10-01", "2262-02-01", "2262-04-11", "2262-04-12", "9999-12-31", "0001-01-01")
    key = F.col("o_orderkey")
    text = F.element_at(F.array(*map(F.lit, ends)), (key % len(ends) + 1).cast("int"))
    delivered = F.when(key % 2 == 0, text).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return given(spark, sf_dir, "orders").select(
        key.alias("rdv_id"), delivered.alias("brut"), dates.iso_day(delivered).alias("jour")
    )


@registered
def dep_from_cp(spark, sf_dir):
    padded = postcodes.pad_booking_postcode(F.col("cp_centre"))
    return valid(spark, sf_dir).select(
        "rdv_id", padded.alias("cp_centre"), postcodes.department(padded).alias("code_departement")
    )


@registered
def region_lookup(spark, sf_dir):
    return with_region(dep_from_cp(spark, sf_dir)).select(
        "rdv_id", "cp_centre", "code_departement", "code_region", "region"
    )


@registered
def week_keys(spark, sf_dir):
    low, high = dates.publication_window(FIRST_DAY, AS_OF, WEEKS)
    day = F.col("date_rdv")
    return normalized(spark, sf_dir).select(
        "rdv_id",
        day,
        dates.iso_week(day).alias("num_semaine"),
        dates.week_start(day).alias("debut_semaine"),
        day.between(F.lit(low), F.lit(high)).alias("dans_fenetre"),
    )


@registered
def effective_rdv(spark, sf_dir):
    return rollups.effective(normalized(spark, sf_dir)).select("rdv_id", "honore", "annule")


# Rollups


@registered
def centre_day(spark, sf_dir):
    return rollups.centre_day(normalized(spark, sf_dir))


@registered
def ars_daily(spark, sf_dir):
    return rollups.ars_daily(measured(spark, sf_dir))


@registered
def weekly_centre(spark, sf_dir):
    return rollups.weekly(measured(spark, sf_dir), "centre", AS_OF, FIRST_DAY, WEEKS)


@registered
def weekly_dep(spark, sf_dir):
    return rollups.weekly(measured(spark, sf_dir), "departement", AS_OF, FIRST_DAY, WEEKS)


@registered
def weekly_reg(spark, sf_dir):
    return rollups.weekly(measured(spark, sf_dir), "region", AS_OF, FIRST_DAY, WEEKS)


@registered
def weekly_national(spark, sf_dir):
    return rollups.weekly(measured(spark, sf_dir), "national", AS_OF, FIRST_DAY, WEEKS)


@registered
def weekly_hierarchy(spark, sf_dir):
    return rollups.weekly_hierarchy(measured(spark, sf_dir), AS_OF, FIRST_DAY, WEEKS)


@registered
def merge_rollup(spark, sf_dir):
    """Centre-day counts of appointments made before and after the start of
    2021, added up."""
    bookings = normalized(spark, sf_dir)
    early = F.col("date_creation") < F.lit("2021-01-01").cast("date")
    slices = (bookings.filter(early), bookings.filter(~early))
    return rollups.with_complete_keys(
        rollups.merge_rollup(*(rollups.centre_day_with_gaps(part) for part in slices))
    )


@registered
def excluded_null_keys(spark, sf_dir):
    return rollups.excluded_rows(measured(spark, sf_dir))


@registered
def region_extract_idf(spark, sf_dir):
    return region_extract(ars_daily(spark, sf_dir), "IDF")


# Controls


@registered
def control_table(spark, sf_dir):
    return controls.control_table(normalized(spark, sf_dir))


@registered
def rg1(spark, sf_dir):
    return controls.rule_1(control_table(spark, sf_dir))


@registered
def rg2(spark, sf_dir):
    return controls.rule_2(control_table(spark, sf_dir), AS_OF)


@registered
def rg2_week_number(spark, sf_dir):
    return controls.rule_2(control_table(spark, sf_dir), AS_OF, week_number_only=True)


@registered
def rg_summary(spark, sf_dir):
    return controls.rule_summary(control_table(spark, sf_dir), AS_OF)


# Slots

_LINE = ("l_orderkey", "l_linenumber")


@registered
def normalized_creneaux(spark, sf_dir):
    return normalize_slots(raw_slots(spark, sf_dir), _LINE)


@registered
def creneaux_keldoc_clean(spark, sf_dir):
    """Blank counts and guessed dates of the keldoc feed."""
    slots = normalize_slots(raw_slots(spark, sf_dir), _LINE)
    return slots.filter(F.col("operateur") == "keldoc").select(
        *_LINE, "date", "date_texte", "nb_heures", "nb_lignes", "nb_creneaux"
    )


@registered
def creneaux_union(spark, sf_dir):
    """The three feeds normalised one by one, then united."""
    raw = raw_slots(spark, sf_dir)
    parts = [normalize_slots(raw.filter(F.col("operateur") == name), _LINE) for name in OPERATORS]
    return union_feeds(*parts)


@registered
def creneaux_postcodes(spark, sf_dir):
    padded = postcodes.pad_slot_postcode(F.col("cp_centre"))
    return raw_slots(spark, sf_dir).select(
        *_LINE,
        F.col("cp_centre").alias("cp_brut"),
        padded.alias("cp_centre"),
        postcodes.department(padded).alias("code_departement"),
    )


# Files: names and reading


@registered
def asof_snapshot(spark, sf_dir):
    """One appointment file name per order, and the newest per operator."""
    day = F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 4
    name = (
        F.when(kind == 0, F.concat(day.cast("string"), F.lit("-maiia-rdv.csv")))
        .when(kind == 1, F.concat(day.cast("string"), F.lit("-keldoc-rdv.csv")))
        .when(
            kind == 2,
            F.concat(F.date_format(day, "dd-MM-yyyy"), F.lit("_vaccination_appointments.csv")),
        )
        .otherwise(F.concat(day.cast("string"), F.lit("-keldoc-autre.csv")))
    )
    paths = given(spark, sf_dir, "orders").select(F.concat(F.lit("depots/"), name).alias("path"))
    return drops.latest_drops(drops.booking_drops(paths), SNAPSHOT_DAY)


@registered
def asof_slot_snapshot(spark, sf_dir):
    """One slot file name per line item, and the newest per operator."""
    day = F.col("l_shipdate").cast("date").cast("string")
    operator = F.element_at(F.array(*map(F.lit, OPERATORS)), (F.col("l_linenumber") % 3 + 1).cast("int"))
    name = F.concat(day, F.lit("-"), operator, F.lit("-plages-horaires.csv"))
    paths = given(spark, sf_dir, "lineitem").select(F.concat(F.lit("depots/"), name).alias("path"))
    return drops.latest_drops(drops.slot_drops(paths), SNAPSHOT_DAY)


@registered
def null_tokens(spark, sf_dir):
    """Spellings of a missing value among texts that only look like one."""
    samples = ("NA", "null", "N/A", "nan", "None", "", "NR", "-", "NAN", "n.a.", "#N/A", "NULL")
    text = F.element_at(
        F.array(*map(F.lit, samples)), (F.col("o_orderkey") % len(samples) + 1).cast("int")
    )
    delivered = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rdv_id"), text.alias("brut"), text.alias("valeur")
    )
    return delivered.select("rdv_id", "brut", texts.missing_to_null("valeur"))


def repeated(df: DataFrame, copies: int) -> DataFrame:
    """Every row so many times, each copy with centres of its own."""
    if copies == 1:
        return df
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    own = F.when(F.col("copie") > 1, F.concat_ws("-", "id_centre", "copie")).otherwise(F.col("id_centre"))
    return df.withColumn("copie", copy).withColumn("id_centre", own).drop("copie")


def deliver_bookings(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """Write the derived appointments as the operators' drops, so many copies
    of each row."""
    folder = folder_for(spark)
    raw = repeated(raw_bookings(spark, sf_dir), copies)
    for name in OPERATORS:
        without = ("annee_naissance",) if name == "doctolib" else ()
        sinks.write_csv(
            raw.filter(F.col("operateur") == name).select(*(c for c in RAW_BOOKING if c not in without)),
            f"{folder}/rdv/{name}/{AS_OF}-{name}-rdv.csv",
            separator=SEPARATORS[name],
        )
    return folder


def deliver_slots(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """Write the derived slots as the operators' drops, so many copies of each
    row."""
    folder = folder_for(spark)
    raw = repeated(raw_slots(spark, sf_dir), copies)
    for name in OPERATORS:
        columns = [
            F.col(c).alias(SLOT_HEADERS[name].get(c, c))
            for c in feeds.RAW_SLOT
            if c not in SLOT_ABSENT[name]
        ]
        sinks.write_csv(
            raw.filter(F.col("operateur") == name).select(*columns),
            f"{folder}/creneaux/{name}/{AS_OF}-{name}-plages-horaires.csv",
            separator=SEPARATORS[name],
        )
    return folder


@registered
def scan_bookings(spark, sf_dir):
    folder = deliver_bookings(spark, sf_dir)
    return feeds.read_bookings(spark, drops.chosen_drops(spark, f"{folder}/rdv", AS_OF))


@registered
def scan_slots(spark, sf_dir):
    folder = deliver_slots(spark, sf_dir)
    return feeds.read_slots(spark, drops.chosen_drops(spark, f"{folder}/creneaux", AS_OF, slots=True))


@registered
def published_scan(spark, sf_dir):
    """Normalised appointments through a gzip CSV."""
    path = f"{folder_for(spark)}/prise_rdv-raw"
    sinks.write_csv(normalized(spark, sf_dir).select(*BOOKING.fieldNames()), path, gzip=True)
    return feeds.read_published_bookings(spark, path)


@registered
def centre_day_scan(spark, sf_dir):
    """Centre-day counts through a CSV."""
    path = f"{folder_for(spark)}/centre_jour"
    sinks.write_csv(centre_day(spark, sf_dir), path)
    return feeds.read_centre_day_csv(spark, path)


@registered
def region_split(spark, sf_dir):
    """Daily counts through one CSV folder per region."""
    path = f"{folder_for(spark)}/ars"
    sinks.write_by_region(ars_daily(spark, sf_dir), path)
    table = spark.read.option("header", True).csv(path)
    return table.withColumns(
        {
            "date_rdv": F.col("date_rdv").cast("date"),
            **{name: F.col(name).cast("long") for name in rollups.MEASURES},
        }
    )


# Jobs


def processed(spark: SparkSession, sf_dir: str) -> str:
    folder = deliver_bookings(spark, sf_dir)
    process_bookings(spark, f"{folder}/rdv", f"{folder}/sortie", AS_OF, THRESHOLD)
    return f"{folder}/sortie"


def read_published(spark: SparkSession, out: str) -> DataFrame:
    """The four weekly tables of a publication as one result."""
    tables = []
    for name, level in OPEN_DATA.items():
        table = feeds.read_text_table(spark, layout.published(out, AS_OF, "opendata", name))
        tables.append(table.withColumn("niveau", F.lit(level)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return union.withColumns(
        {
            "date_debut_semaine": F.col("date_debut_semaine").cast("date"),
            **{name: F.col(name).cast("long") for name in rollups.MEASURES},
        }
    )


@registered
def job_bookings(spark, sf_dir):
    """Drops to stored normalised appointments."""
    out = processed(spark, sf_dir)
    return feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), AS_OF)


@registered
def job_rejects(spark, sf_dir):
    """Drops to stored rejects."""
    out = processed(spark, sf_dir)
    return spark.read.parquet(layout.stored(out, layout.REJECTS)).drop("date_publication")


@registered
def job_error_report(spark, sf_dir):
    """Drops to the error report file."""
    out = processed(spark, sf_dir)
    report = spark.read.csv(layout.stored(out, layout.ERROR_REPORT), sep=";", header=True)
    return report.select(
        "operateur",
        F.col("tot_row").cast("long").alias("tot_row"),
        F.col("err_row").cast("long").alias("err_row"),
        F.col("alerte").cast("boolean").alias("alerte"),
        F.col("nb_id_centre_absent").cast("long").alias("nb_id_centre_absent"),
        F.col("nb_annee_naissance_absente").cast("long").alias("nb_annee_naissance_absente"),
        F.col("annee_max").cast("long").alias("annee_max"),
    )


@registered
def job_publication(spark, sf_dir):
    """Drops to the published weekly tables."""
    out = processed(spark, sf_dir)
    publish(spark, out, AS_OF, FIRST_DAY, WEEKS)
    return read_published(spark, out)


@registered
def job_publication_partials(spark, sf_dir):
    """The same tables from one centre-day table per operator."""
    out = processed(spark, sf_dir)
    bookings = feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), AS_OF)
    partials = [
        rollups.centre_day_with_gaps(bookings.filter(F.col("operateur") == name)) for name in OPERATORS
    ]
    publish_from_partials(partials, out, AS_OF, FIRST_DAY, WEEKS)
    return read_published(spark, out)


@registered
def job_controls(spark, sf_dir):
    """Drops to the summary of both rules."""
    return control_bookings(spark, processed(spark, sf_dir), AS_OF)["resume"]


@registered
def job_slots(spark, sf_dir):
    """Drops to published slots."""
    folder = deliver_slots(spark, sf_dir)
    process_slots(spark, f"{folder}/creneaux", f"{folder}/sortie", AS_OF)
    table = feeds.read_text_table(spark, layout.published(f"{folder}/sortie", AS_OF, "creneaux"))
    return table.select(F.col("date").cast("date").alias("date"), *SLOT[1:])


@registered
def slot_figures(spark, sf_dir):
    """Drops to the figures per slot feed."""
    folder = deliver_slots(spark, sf_dir)
    return process_slots(spark, f"{folder}/creneaux", f"{folder}/sortie", AS_OF)


@registered
def job_daily_file(spark, sf_dir):
    """Drops to the published daily file."""
    return daily_types(feeds.read_text_table(spark, layout.published(publication(spark, sf_dir), AS_OF, "prise_rdv")))


@registered
def job_regions(spark, sf_dir):
    """Drops to the regional folders."""
    path = layout.published(publication(spark, sf_dir), AS_OF, "ars")
    return daily_types(spark.read.option("header", True).csv(path))


@registered
def job_exclusions(spark, sf_dir):
    """Drops to the figures on excluded rows."""
    table = feeds.read_text_table(spark, layout.published(publication(spark, sf_dir), AS_OF, "exclusions"))
    return table.select(*(F.col(c).cast("long").alias(c) for c in table.columns))


def publication(spark: SparkSession, sf_dir: str) -> str:
    out = processed(spark, sf_dir)
    publish(spark, out, AS_OF, FIRST_DAY, WEEKS)
    return out


def daily_types(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "date_rdv": F.col("date_rdv").cast("date"),
            **{name: F.col(name).cast("long") for name in rollups.MEASURES},
        }
    )


@registered
def published_order(spark, sf_dir):
    """Rows of each published file and how many stand before their forerunner,
    read in the order of the part files."""
    out = publication(spark, sf_dir)
    files = {**{("opendata", name): level for name, level in OPEN_DATA.items()}, ("prise_rdv",): "ars"}
    counts = []
    for parts, level in files.items():
        table = spark.read.option("header", True).csv(layout.published(out, AS_OF, *parts))
        key = F.struct(*rollups.SORT_KEYS[level])
        within = table.select(
            key.alias("cle"),
            F.col("_metadata.file_name").alias("fichier"),
            F.col("_metadata.file_block_start").alias("bloc"),
            F.monotonically_increasing_id().alias("numero"),
        )
        # In each block of a file its own rows, then a row a block.
        before = F.lag("cle").over(Window.partitionBy("fichier", "bloc").orderBy("numero"))
        blocks = (
            within.withColumn("avant", before)
            .groupBy("fichier", "bloc")
            .agg(
                F.count("*").alias("lignes"),
                F.count_if(F.col("avant") > F.col("cle")).alias("deplacees"),
                F.min_by("cle", "numero").alias("premiere"),
                F.max_by("cle", "numero").alias("derniere"),
            )
        )
        last = F.lag("derniere").over(Window.orderBy("fichier", "bloc"))
        counts.append(
            blocks.withColumn("avant", last)
            .agg(
                F.sum("lignes").alias("lignes"),
                (F.sum("deplacees") + F.count_if(F.col("avant") > F.col("premiere"))).alias("deplacees"),
            )
            .withColumn("niveau", F.lit(level))
        )
    return reduce(DataFrame.unionByName, counts)


@registered
def job_dimension(spark, sf_dir):
    """Drops to normalised appointments by delivered department and region
    tables, in which one region has another name."""
    folder = deliver_bookings(spark, sf_dir)
    dimension = territory_dimension(spark)
    sinks.write_csv(dimension.select(F.col("code_departement").alias("dep"), F.col("code_region").alias("reg")), f"{folder}/dep")
    names = dimension.select(F.col("code_region").alias("reg"), "region").distinct()
    renamed = F.when(F.col("region") == "IDF", F.lit("ILE")).otherwise(F.col("region"))
    sinks.write_csv(names.select("reg", renamed.alias("libelle3")), f"{folder}/reg")
    delivered = territory_from_tables(
        feeds.read_dimension(spark, f"{folder}/dep"), feeds.read_dimension(spark, f"{folder}/reg")
    )
    process_bookings(spark, f"{folder}/rdv", f"{folder}/sortie", AS_OF, THRESHOLD, dimension=delivered)
    return feeds.read_normalized(spark, layout.stored(f"{folder}/sortie", layout.CHECKED), AS_OF)


@registered
def job_missing_and_rejected(spark, sf_dir):
    """The report with one feed missing and one all of whose rows are rejected."""
    folder = folder_for(spark)
    raw = raw_bookings(spark, sf_dir)
    for name in ("maiia", "keldoc"):
        own = raw.filter(F.col("operateur") == name)
        if name == "keldoc":
            own = own.withColumn("cp_centre", F.lit("?"))
        sinks.write_csv(own.select(*RAW_BOOKING), f"{folder}/rdv/{AS_OF}-{name}-rdv.csv", separator=SEPARATORS[name])
    report = process_bookings(spark, f"{folder}/rdv", f"{folder}/sortie", AS_OF, THRESHOLD)
    return report.drop("date_traitement", "taux_erreur")


@registered
def scan_parts(spark, sf_dir):
    """Drops in part files, some with their columns turned round and those of
    doctolib without the optional one."""
    folder = folder_for(spark)
    raw = raw_bookings(spark, sf_dir)
    columns = {
        "maiia": (RAW_BOOKING, RAW_BOOKING[::-1]),
        "keldoc": (RAW_BOOKING, (*RAW_BOOKING[5:], *RAW_BOOKING[:5])),
        "doctolib": tuple(
            tuple(c for c in RAW_BOOKING if c not in without)
            for without in (("annee_naissance",), ("annee_naissance", "motif_rdv"))
        ),
    }
    for name, forms in columns.items():
        for k, form in enumerate(forms):
            own = raw.filter((F.col("operateur") == name) & (F.floor(F.col("rdv_id") / 3) % 2 == k))
            path = f"{folder}/rdv/{AS_OF}-{name}-rdv.csv/partie-{k}.csv"
            sinks.write_csv(own.select(*form), path, separator=SEPARATORS[name])
    return feeds.read_bookings(spark, drops.chosen_drops(spark, f"{folder}/rdv", AS_OF))


@registered
def operator_whitelist(spark, sf_dir):
    """Operators as delivered, and whether the check lets them pass."""

    def known(name: str) -> bool:
        try:
            return validation.check_operator(name) == name
        except ValueError:
            return False

    names = (*OPERATORS, "Maiia", "autre", "")
    passes = F.element_at(F.create_map(*(F.lit(x) for name in names for x in (name, known(name)))), F.col("operateur"))
    name = F.element_at(F.array(*map(F.lit, names)), (F.col("o_orderkey") % len(names) + 1).cast("int"))
    return given(spark, sf_dir, "orders").select("o_orderkey", name.alias("operateur")).withColumn("connu", passes)


# Incremental ingest


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """Two runs over the drops; the second finds nothing new."""
    folder = deliver_bookings(spark, sf_dir)
    for _ in range(2):
        ingest_new_drops(spark, f"{folder}/rdv", f"{folder}/sortie", f"{folder}/suivi", threshold=THRESHOLD)
    return f"{folder}/sortie"


def corrected(spark: SparkSession, sf_dir: str) -> str:
    """An earlier drop and a second one of the same day, the first delivered
    again with other content under its name, then the drops that count."""
    folder = folder_for(spark)
    raw = raw_bookings(spark, sf_dir)

    def deliver(name: str, path: str, rows: DataFrame) -> None:
        without = ("annee_naissance",) if name == "doctolib" else ()
        sinks.write_csv(
            rows.filter(F.col("operateur") == name).select(*(c for c in RAW_BOOKING if c not in without)),
            f"{folder}/rdv/{path}",
            separator=SEPARATORS[name],
        )

    run = lambda: ingest_new_drops(
        spark, f"{folder}/rdv", f"{folder}/sortie", f"{folder}/suivi", threshold=THRESHOLD
    )
    deliver("doctolib", "17-12-2021_vaccination_appointments.csv", raw.filter("rdv_id % 2 = 0"))
    deliver("maiia", f"{AS_OF}-maiia-rdv.csv", raw.filter("rdv_id % 5 = 0"))
    run()
    deliver("doctolib", f"{AS_OF}-doctolib-rdv.csv", raw)
    deliver("keldoc", f"{AS_OF}-keldoc-rdv.csv", raw)
    deliver("maiia", f"{AS_OF}-maiia-rdv.csv", raw)
    run()
    return f"{folder}/sortie"


@registered
def ingest_bookings(spark, sf_dir):
    return ingested_bookings(spark, ingested(spark, sf_dir))


@registered
def ingest_corrected(spark, sf_dir):
    """Two drops a day and a corrected one give what the batch job gives."""
    return ingested_bookings(spark, corrected(spark, sf_dir), AS_OF)


@registered
def ingest_rejects(spark, sf_dir):
    return ingested_rejects(spark, corrected(spark, sf_dir), AS_OF)


@registered
def ingest_error_report(spark, sf_dir):
    return ingested_figures(spark, corrected(spark, sf_dir), AS_OF).select(
        "operateur", "tot_row", "err_row", "alerte", "nb_id_centre_absent", "nb_annee_naissance_absente", "annee_max"
    )


@registered
def ingest_centre_day(spark, sf_dir):
    return rollups.with_complete_keys(ingested_centre_day(spark, ingested(spark, sf_dir)))
