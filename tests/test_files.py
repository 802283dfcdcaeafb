"""Readers, writers and jobs over files."""

import datetime as dt
import gzip
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from calepin.model import ARS_REGIONS, OPERATORS
from calepin.operators import rollups
from calepin.plans import layout
from calepin.plans.bookings import alerted_operators, process_bookings
from calepin.plans.controls import control_bookings
from calepin.plans.publication import publish
from calepin.plans.slots import process_slots
from calepin.sources import drops, feeds, sinks
from calepin.sources.workspace import work_folder
from calepin.streaming.ingest import (
    CHECKED_LOTS,
    ingest_new_drops,
    ingested_bookings,
    ingested_centre_day,
    ingested_figures,
    ingested_rejects,
    store_lot,
)

D = dt.date
HEADER = "id_centre,nom_centre,date_creation,date_rdv,cp_centre,motif_rdv,rang_vaccinal,parcours_rdv,annee_naissance,honore,annule,type_vaccin,extra"
LINE = "C1,Mairie,,2021-03-01,75001,dose,1,,1950,,,Pfizer,x"


def put(path: Path, *lines: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_latest_drop(spark, tmp_path):
    for name in (
        "maiia/2021-03-01-maiia-rdv.csv", "maiia/2021-03-08-maiia-rdv.csv", "maiia/2021-04-01-maiia-rdv.csv",
        "maiia/2021-03-09-maiia-plages-horaires.csv", "maiia/notes.csv", "maiia/2021-13-09-maiia-rdv.csv",
        "doctolib/08-03-2021_vaccination_appointments.csv", "doctolib/2021-03-02-doctolib-rdv.csv",
    ):
        put(tmp_path / name, HEADER)
    chosen = drops.chosen_drops(spark, str(tmp_path), "2021-03-10")
    assert {name: Path(path).name for name, path in chosen.items()} == {
        "maiia": "2021-03-08-maiia-rdv.csv",
        "doctolib": "08-03-2021_vaccination_appointments.csv",
    }
    assert list(drops.chosen_drops(spark, str(tmp_path), "2021-03-10", slots=True)) == ["maiia"]
    assert drops.chosen_drops(spark, str(tmp_path), "2021-02-01") == {}
    assert drops.chosen_drops(spark, str(tmp_path / "absent"), "2021-03-10") == {}


def test_drop_may_be_a_folder_of_part_files(spark, tmp_path):
    for part in ("a", "b"):
        put(tmp_path / "maiia/2021-03-08-maiia-rdv.csv" / f"part-{part}.csv", HEADER, LINE)
    chosen = drops.chosen_drops(spark, str(tmp_path), "2021-03-10")
    assert chosen["maiia"].endswith("2021-03-08-maiia-rdv.csv")
    assert feeds.read_bookings(spark, chosen).count() == 2


def test_listing_runs_no_task(spark, tmp_path):
    put(tmp_path / "a b/2021-03-08-maiia-rdv.csv", HEADER)
    (tmp_path / "2021-03-09-maiia-rdv.csv").write_text("x\n" * 3_000_000)
    paths = drops.list_paths(spark, str(tmp_path))
    assert "FileScan" not in paths._jdf.queryExecution().executedPlan().toString()
    assert {Path(r.path).name for r in paths.collect()} == {"2021-03-08-maiia-rdv.csv", "2021-03-09-maiia-rdv.csv"}
    assert list(drops.chosen_drops(spark, str(tmp_path), "2021-03-08")) == ["maiia"]


def test_a_stray_quote_keeps_lines_apart(spark, tmp_path):
    path = put(tmp_path / "x.csv", HEADER, LINE.replace("Mairie", 'Salle 12" bis'), LINE)
    rows = feeds.read_booking_drop(spark, "maiia", path).collect()
    assert [r.nom_centre for r in rows] == ['Salle 12" bis', "Mairie"]


def test_parts_are_read_by_their_own_header(spark, tmp_path):
    folder = tmp_path / "2021-03-08-maiia-rdv.csv"
    columns, values = HEADER.split(","), LINE.split(",")
    put(folder / "part-a.csv", HEADER, LINE)
    put(folder / "part-b.csv", ",".join(columns[::-1]), ",".join(values[::-1]))
    first, second = feeds.read_booking_drop(spark, "maiia", str(folder)).collect()
    assert first == second and first.id_centre == "C1"


def test_a_bad_count_fails(spark, tmp_path):
    names = (*rollups.CENTRE_DAY_KEYS, *rollups.MEASURES)
    row = ["2021-03-01", *["x"] * 9, "1", "2", "abc"]
    path = put(tmp_path / "c.csv", ",".join(names), ",".join(row))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a whole number"):
            feeds.read_centre_day_csv(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_failed_run_leaves_the_old_publication(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_publication(spark.range(3), path, "2021-12-17")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        sinks.write_publication(broken, path, "2021-12-17")
    assert spark.read.parquet(path).count() == 3
    sinks.write_publication(spark.range(7), path, "2021-12-17")
    assert spark.read.parquet(path).count() == 7


def test_columns_go_by_name_and_blanks_to_null(spark, tmp_path):
    path = put(tmp_path / "x.csv", HEADER, LINE, 'NR,NA,null,2021-03-01,75001,"dose ""x"", deux",1,"",nan,,,,')
    first, second = feeds.read_booking_drop(spark, "maiia", path).collect()
    assert (first.date_rdv, first.cp_centre, first.date_creation, first.operateur) == ("2021-03-01", "75001", None, "maiia")
    assert (second.id_centre, second.nom_centre, second.date_creation, second.parcours_rdv) == ("NR", None, None, None)
    assert (second.motif_rdv, second.annee_naissance) == ('dose "x", deux', None)


def test_line_breaks_inside_fields(spark, tmp_path):
    path = put(tmp_path / "x.csv", HEADER, LINE.replace("dose", '"dose\nun"'), LINE)
    rows = feeds.read_booking_drop(spark, "maiia", path, multi_line=True).collect()
    assert sorted(r.motif_rdv for r in rows) == ["dose", "dose\nun"]


def test_separator_and_optional_column(spark, tmp_path):
    keldoc = put(tmp_path / "k.csv", HEADER.replace(",", ";"), LINE.replace(",", ";"))
    assert feeds.read_booking_drop(spark, "keldoc", keldoc).first().nom_centre == "Mairie"
    without = "date_creation,date_rdv,id_centre,nom_centre,cp_centre,rang_vaccinal,parcours_rdv,honore,annule,type_vaccin"
    doctolib = put(tmp_path / "d.csv", without, ",2021-03-01,C1,N,75001,1,,,,Pfizer")
    row = feeds.read_booking_drop(spark, "doctolib", doctolib).first()
    assert (row.motif_rdv, row.annee_naissance, row.type_vaccin) == ("NR", "NR", "Pfizer")
    with pytest.raises(Exception):
        feeds.read_booking_drop(spark, "maiia", doctolib).collect()
    with pytest.raises(ValueError):
        feeds.read_booking_drop(spark, "autre", doctolib)


def test_slot_headers(spark, tmp_path):
    maiia = put(tmp_path / "m.csv", "date_rdv,id_centre,nom_centre,cp_centre,nb_heures,nb_lignes", "2021-01-04,C1,N,75001,3,2")
    doctolib = put(tmp_path / "d.csv", "date,id_centre,nom_centre,cp_centre,nb_heures,nb_lignes,nb_créneaux,type_vaccin", "2021-01-04,C1,N,75001,3,2,9,Pfizer")
    row = feeds.read_slot_drop(spark, "maiia", maiia).first()
    assert (row.date, row.nb_creneaux, row.type_vaccin) == ("2021-01-04", "NR", "NR")
    assert feeds.read_slot_drop(spark, "doctolib", doctolib).first().nb_creneaux == "9"


def test_dimension_files(spark, tmp_path):
    path = put(tmp_path / "d.csv", '"dep","reg"', '"01","84"')
    assert tuple(feeds.read_dimension(spark, path).first()) == ("01", "84")


def test_csv_prints_nulls_as_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", None, ""), (" b ", 'c"d', "e,f")], "x string, y string, z string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "o"))
    (part,) = (tmp_path / "o").glob("part-*")
    assert part.read_text().splitlines() == ["x,y,z", "a,,", ' b ,"c""d","e,f"']
    sinks.write_csv(df.coalesce(1), str(tmp_path / "g"), gzip=True)
    (part,) = (tmp_path / "g").glob("part-*.gz")
    assert gzip.decompress(part.read_bytes()).decode().splitlines()[0] == "x,y,z"


def test_sorted_parts_are_in_order(spark, tmp_path):
    sinks.write_csv(spark.range(0, 1000, 1, 8).select((999 - F.col("id")).alias("n")), str(tmp_path / "o"), ("n",))
    lines = [line for part in sorted((tmp_path / "o").glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert lines == [str(n) for n in range(1000)]


def daily_rows(spark, count):
    """A third of all rows in one region, the others over the rest."""
    names = [*ARS_REGIONS, "MAY"]
    index = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.floor(F.col("id") / 3) % len(names)).cast("int"))
    return spark.range(count).select(
        F.lit("00").alias("code_region"),
        F.element_at(F.array(*map(F.lit, names)), index + 1).alias("region"),
        F.lit("75").alias("departement"),
        F.concat(F.lit("C"), F.col("id")).alias("id_centre"),
        F.lit("N").alias("nom_centre"),
        F.lit("1").alias("rang_vaccinal"),
        F.lit("Pfizer").alias("type_vaccin"),
        F.lit("2021-03-01").cast("date").alias("date_rdv"),
        *(F.lit(1).cast("long").alias(name) for name in rollups.MEASURES),
    )


def test_region_folders(spark, tmp_path):
    path = str(tmp_path / "ars")
    sinks.write_by_region(daily_rows(spark, 900), path)
    back = spark.read.option("header", True).csv(path)
    assert back.filter("region <> region_part").isEmpty()
    assert {r.region for r in back.select("region").distinct().collect()} == set(ARS_REGIONS)
    assert back.count() == daily_rows(spark, 900).filter("region <> 'MAY'").count()


def test_a_large_region_is_spread_over_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_by_region(daily_rows(spark, 9000), str(tmp_path / "ars"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(list((tmp_path / "ars" / f"region_part={ARS_REGIONS[0]}").glob("part-*"))) > 1


def test_work_folder_is_below_the_one_given():
    assert work_folder("/shared/").startswith("/shared/calepin-") and work_folder("/a") != work_folder("/a")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "depots"
    lines = [
        LINE, LINE, LINE.replace("75001", ""), LINE.replace(",1950,,,", ",,oui,,"),
        LINE.replace(",1,,1950", ",R,,"), LINE.replace("Mairie", ""),
    ]
    put(folder / "maiia/2021-12-16-maiia-rdv.csv", HEADER, *lines)
    put(folder / "maiia/2021-12-01-maiia-rdv.csv", HEADER, LINE)
    put(folder / "keldoc/2021-12-17-keldoc-rdv.csv", HEADER.replace(",", ";"),
        LINE.replace("2021-03-01", "01/03/21").replace(",", ";"))
    return folder


def published_rows(spark, out, *parts):
    rows = feeds.read_text_table(spark, layout.published(out, "2021-12-17", *parts)).collect()
    return sorted(map(tuple, rows), key=repr)


def test_bookings_to_publication_and_again(spark, landing, tmp_path):
    out = str(tmp_path / "sortie")
    for _ in range(2):
        report = process_bookings(spark, str(landing), out, "2021-12-17", threshold=0.1)
        figures = {r.operateur: r for r in report.collect()}
        assert (figures["maiia"].tot_row, figures["maiia"].err_row, figures["maiia"].nb_annee_naissance_absente) == (6, 2, 1)
        assert (figures["keldoc"].tot_row, figures["doctolib"].tot_row) == (1, 0)
        assert alerted_operators(report) == ("maiia",)
        rejects = spark.read.parquet(layout.stored(out, layout.REJECTS))
        assert {(r.motif_rejet, r.operateur) for r in rejects.collect()} == {("cp_centre", "maiia"), ("honore", "maiia")}
        assert rejects.count() == 2
        assert feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), "2021-12-17").count() == 5
        publish(spark, out, "2021-12-17")
        assert published_rows(spark, out, "opendata", "national") == [("1", "2021-03-01", "3"), ("3", "2021-03-01", "1")]
        assert published_rows(spark, out, "exclusions") == [("5", "1", "0", "1")]
        raw = feeds.read_published_bookings(spark, layout.published(out, "2021-12-17", "prise_rdv-raw"))
        assert raw.count() == 5
    publish(spark, out, "2021-12-17", without=("maiia",))
    assert published_rows(spark, out, "opendata", "national") == [("1", "2021-03-01", "1")]
    summary = control_bookings(spark, out, "2021-12-17")["resume"].first()
    assert summary.rg1_groupes == 0


def test_a_second_run_leaves_nothing_of_the_first(spark, landing, tmp_path):
    out = str(tmp_path / "sortie")
    process_bookings(spark, str(landing), out, "2021-12-17")
    read_rejects = lambda: spark.read.schema("motif_rejet string").parquet(layout.stored(out, layout.REJECTS))
    assert read_rejects().count() == 2
    put(landing / "maiia/2021-12-16-maiia-rdv.csv", HEADER, LINE)
    process_bookings(spark, str(landing), out, "2021-12-17")
    assert read_rejects().count() == 0
    assert feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), "2021-12-17").count() == 2


def test_error_report_file(spark, landing, tmp_path):
    out = str(tmp_path / "sortie")
    process_bookings(spark, str(landing), out, "2021-12-17")
    (part,) = Path(layout.stored(out, layout.ERROR_REPORT)).glob("*/part-*")
    lines = part.read_text().splitlines()
    assert lines[0].startswith("date_traitement;operateur;tot_row;err_row") and len(lines) == 1 + len(OPERATORS)


def test_no_feed_at_all(spark, tmp_path):
    report = process_bookings(spark, str(tmp_path / "rien"), str(tmp_path / "sortie"), "2021-12-17")
    assert {(r.operateur, r.tot_row) for r in report.collect()} == {(name, 0) for name in OPERATORS}
    slots = process_slots(spark, str(tmp_path / "rien"), str(tmp_path / "sortie"), "2021-12-17")
    assert {(r.operateur, r.tot_row) for r in slots.collect()} == {(name, 0) for name in OPERATORS}


def test_slots_job(spark, tmp_path):
    out = str(tmp_path / "sortie")
    put(tmp_path / "c/keldoc/2021-12-10-keldoc-plages-horaires.csv",
        "date;id_centre;nom_centre;cp_centre;type_vaccin;nb_lignes;nb_creneaux;nb_heures",
        "01/02/2021;C1;N;2100;Pfizer;1; -   ;2", "demain;C1;N;;Pfizer;1;5;2")
    for _ in range(2):
        figures = {r.operateur: tuple(r)[1:] for r in process_slots(spark, str(tmp_path / "c"), out, "2021-12-17").collect()}
        assert figures == {"keldoc": (2, 1, 1), "maiia": (0, 0, 0), "doctolib": (0, 0, 0)}
        assert published_rows(spark, out, "creneaux")[0] == (
            "2021-01-02", "01/02/2021", "C1", "N", "02100", "02", "32", "HDF", "2", "1", None, "Pfizer", "keldoc",
        )


def test_ingest_reads_each_file_once(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "lots"), str(tmp_path / "suivi")
    run = lambda: ingest_new_drops(spark, str(landing), out, checkpoint)
    run()
    assert ingested_bookings(spark, out).count() == 6
    run()
    assert ingested_bookings(spark, out).count() == 6
    put(landing / "doctolib/17-12-2021_vaccination_appointments.csv", HEADER, LINE)
    run()
    assert ingested_bookings(spark, out).count() == 7
    assert ingested_centre_day(spark, out).agg(F.sum("nb")).first()[0] == 7
    # As full pictures: the earlier maiia file gives way to the later one.
    assert ingested_bookings(spark, out, "2021-12-17").count() == 6
    assert ingested_bookings(spark, out, "2021-12-05").count() == 1
    assert ingested_centre_day(spark, out, "2021-12-17").agg(F.sum("nb")).first()[0] == 6


def test_a_repeated_lot_replaces_itself(spark, landing, tmp_path):
    out = str(tmp_path / "lots")
    files = drops.list_paths(spark, str(landing))
    for _ in range(2):
        store_lot(files, out)
    assert ingested_bookings(spark, out).count() == 6
    assert spark.read.parquet(f"{out}/{CHECKED_LOTS}").select("lot").distinct().count() == 3


def test_a_corrected_file_replaces_its_lot(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "lots"), str(tmp_path / "suivi")
    run = lambda: ingest_new_drops(spark, str(landing), out, checkpoint)
    run()
    figures = {r.operateur: r for r in ingested_figures(spark, out, "2021-12-17").collect()}
    assert (figures["maiia"].tot_row, figures["maiia"].err_row, figures["maiia"].alerte) == (6, 2, True)
    assert ingested_rejects(spark, out, "2021-12-17").count() == 2
    path = landing / "maiia/2021-12-16-maiia-rdv.csv"
    put(path, HEADER, LINE)
    os.utime(path, (2_000_000_000, 2_000_000_000))
    run()
    assert ingested_bookings(spark, out, "2021-12-17").count() == 2
    assert ingested_rejects(spark, out).count() == 0
    assert ingested_centre_day(spark, out).agg(F.sum("nb")).first()[0] == 3


def test_one_drop_a_day_counts(spark, landing, tmp_path):
    put(landing / "doctolib/2021-12-17-doctolib-rdv.csv", HEADER, LINE)
    put(landing / "doctolib/17-12-2021_vaccination_appointments.csv", HEADER, LINE, LINE)
    out = str(tmp_path / "sortie")
    process_bookings(spark, str(landing), out, "2021-12-17")
    ingest_new_drops(spark, str(landing), f"{out}/lots", str(tmp_path / "suivi"))
    batch = feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), "2021-12-17")
    ingested = ingested_bookings(spark, f"{out}/lots", "2021-12-17")
    assert sorted(map(repr, batch.collect())) == sorted(map(repr, ingested.collect()))
