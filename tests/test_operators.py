"""Operators on small tables with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from calepin.model import ARS_REGIONS, BOOKING, CENTRE_DAY_KEYS, MEASURES, OPERATORS, RAW_BOOKING, TERRITORY
from calepin.operators import controls, quality, rollups, validation
from calepin.operators.normalization import (
    checked_bookings,
    normalize_bookings,
    normalize_slots,
    stored_rejects,
)
from calepin.operators.territory import (
    region_extract,
    territory_dimension,
    territory_from_tables,
    with_region,
)
from checks.fixtures import AS_OF, raw_bookings
from conftest import SF_DIR

D = dt.date
DEFAULTS = dict(
    date_creation=None, date_rdv="2021-03-01", id_centre="C1", nom_centre="N", cp_centre="75001",
    motif_rdv="dose", rang_vaccinal="1", parcours_rdv=None, annee_naissance="1950", honore=None,
    annule=None, type_vaccin="Pfizer", operateur="maiia",
)


@pytest.fixture
def raw(spark):
    schema = ", ".join(f"{name} string" for name in (*RAW_BOOKING, "operateur"))

    def make(*rows):
        full = [{**DEFAULTS, **row} for row in rows]
        return spark.createDataFrame([tuple(r[n] for n in (*RAW_BOOKING, "operateur")) for r in full], schema)

    return make


@pytest.fixture
def normalized(raw):
    return lambda *rows: normalize_bookings(validation.valid_rows(validation.tag_rejects(raw(*rows))))


def test_first_failure_wins(raw):
    tagged = validation.tag_rejects(raw(
        dict(honore="oui", cp_centre="1"), dict(annule="?"), dict(date_rdv="2021-02-30"), dict(date_rdv=None),
        dict(date_creation="hier"), dict(cp_centre=None), dict(), dict(date_rdv="01/03/21", operateur="keldoc"),
    ))
    assert [r.motif_rejet for r in tagged.collect()] == [
        "honore", "annule", "date_rdv", "date_rdv", "date_creation", "cp_centre", None, None,
    ]


def test_bad_and_missing_creation_date_together(raw):
    tagged = validation.tag_rejects(raw(dict(date_creation="hier"), dict(date_creation=None)))
    assert [r.motif_rejet for r in tagged.collect()] == ["date_creation", None]


def test_error_report(raw):
    tagged = validation.tag_rejects(raw(dict(), dict(cp_centre=None), dict(operateur="keldoc", date_rdv="01/03/21")))
    report = {r.operateur: r for r in validation.error_report(tagged, AS_OF, 0.4, OPERATORS).collect()}
    assert (report["maiia"].tot_row, report["maiia"].err_row, report["maiia"].alerte) == (2, 1, True)
    assert (report["keldoc"].tot_row, report["keldoc"].alerte) == (1, False)
    assert (report["doctolib"].tot_row, report["doctolib"].taux_erreur, report["doctolib"].alerte) == (0, None, False)


def test_valid_and_rejected_rows_partition_the_input(spark):
    raw = raw_bookings(spark, SF_DIR)
    tagged = validation.tag_rejects(raw)
    assert validation.valid_rows(tagged).count() + validation.rejected_rows(tagged, AS_OF).count() == raw.count()


def test_normalized_schema_and_values(normalized):
    df = normalized(dict(cp_centre="1234", id_centre=None, annee_naissance=None, motif_rdv=None, honore="VRAI"))
    assert df.schema.fieldNames() == BOOKING.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in BOOKING]
    row = df.first()
    assert (row.date_creation, row.date_rdv) == (D(2021, 3, 1), D(2021, 3, 1))
    assert (row.cp_centre, row.code_departement, row.code_region, row.region) == ("01234", "01", "84", "ARA")
    assert (row.id_centre, row.annee_naissance, row.motif_rdv) == ("NR", "NR", "NR")
    # maiia's own vaccine type is not used.
    assert (row.honore, row.annule, row.type_vaccin, row.parcours_rdv) == ("true", "NR", "NR", None)


def test_doctolib_fills(normalized):
    row = normalized(dict(operateur="doctolib", cp_centre="20100 Cedex")).first()
    assert (row.annee_naissance, row.parcours_rdv, row.type_vaccin) == ("NR", "NR", "Pfizer")
    assert (row.code_departement, row.code_region, row.region) == ("2A", "94", "COR")


def test_unknown_department_has_no_region(normalized):
    row = normalized(dict(cp_centre="97500")).first()
    assert (row.code_departement, row.code_region, row.region) == ("975", None, None)


def test_dimension(spark):
    rows = territory_dimension(spark).collect()
    assert len(rows) == len({r.code_departement for r in rows}) == 101
    assert len({name for _, _, name in TERRITORY}) == 18 and len(TERRITORY) == 101 and len(ARS_REGIONS) == 17 and "MAY" not in ARS_REGIONS


def test_delivered_dimension(spark):
    departments = spark.createDataFrame([("01", "84"), ("2A", "xx")], "dep string, reg string")
    regions = spark.createDataFrame([("84", "ARA")], "reg string, libelle3 string")
    dimension = territory_from_tables(departments, regions)
    df = spark.createDataFrame([("01",), ("2A",), ("99",)], "code_departement string")
    got = {r.code_departement: (r.code_region, r.region) for r in with_region(df, dimension).collect()}
    assert got == {"01": ("84", "ARA"), "2A": ("94", "COR"), "99": (None, None)}


def test_effective_keeps_blanks(spark):
    df = spark.createDataFrame(
        [("NR", "NR"), (None, None), ("false", "false"), ("true", "true"), ("true", "false")],
        "honore string, annule string",
    )
    assert {tuple(r) for r in rollups.effective(df).collect()} == {("NR", "NR"), (None, None), ("true", "false")}


def test_missing_keys_leave_the_tables(normalized):
    df = normalized(dict(nom_centre="a"), dict(nom_centre="a"), dict(nom_centre=None), dict(cp_centre="97500"))
    assert [r.nb for r in rollups.centre_day(df).collect()] == [2]
    row = rollups.excluded_rows(rollups.centre_day_with_gaps(df)).first()
    assert tuple(row) == (4, 2, 1, 1)
    # The same figures from single appointments.
    assert tuple(rollups.excluded_rows(rollups.measured(df)).first()) == (4, 2, 1, 1)


def test_window_and_dose_filters(normalized):
    df = normalized(
        dict(date_rdv="2021-01-17"), dict(date_rdv="2021-01-18"), dict(date_rdv="2022-01-16"),
        dict(date_rdv="2022-01-17"), dict(date_rdv="2021-01-18", rang_vaccinal=None),
    )
    weeks = rollups.weekly(rollups.measured(df), "national", AS_OF).orderBy("date_debut_semaine").collect()
    assert [(r.date_debut_semaine, r.nb) for r in weeks] == [(D(2021, 1, 18), 1), (D(2022, 1, 10), 1)]
    # The daily table knows neither filter.
    assert rollups.ars_daily(rollups.measured(df)).agg(F.sum("nb")).first()[0] == 5


@pytest.fixture(scope="module")
def derived(spark):
    raw = raw_bookings(spark, SF_DIR)
    return normalize_bookings(validation.valid_rows(validation.tag_rejects(raw))).cache()


def rows(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


def test_levels_add_up(derived):
    counted = rollups.centre_day(derived)
    totals = {
        level: rollups.weekly(counted, level, AS_OF).agg(F.sum("nb")).first()[0]
        for level in rollups.WEEKLY_KEYS
    }
    window = rollups.published_weeks(counted, AS_OF).agg(F.sum("nb")).first()[0]
    assert set(totals.values()) == {window}
    hierarchy = rollups.weekly_hierarchy(counted, AS_OF).groupBy("niveau").agg(F.sum("nb")).collect()
    assert {r[1] for r in hierarchy} == {window} and len(hierarchy) == 3


def test_rollups_agree_on_rows_and_partials(derived):
    measured, counted = rollups.measured(derived), rollups.centre_day_with_gaps(derived)
    for level, keys in rollups.WEEKLY_KEYS.items():
        assert rows(rollups.weekly(measured, level, AS_OF), *keys, "nb") == rows(
            rollups.weekly(counted, level, AS_OF), *keys, "nb"
        )
    daily = (*rollups.DAILY_KEYS, *MEASURES)
    assert rows(rollups.ars_daily(measured), *daily) == rows(rollups.ars_daily(counted), *daily)


def test_any_split_merges_to_the_whole(derived):
    whole = rows(rollups.centre_day(derived), *CENTRE_DAY_KEYS, *MEASURES)
    for split in (F.col("honore") == "true", F.col("date_creation") < "2021-06-01", F.col("motif_rdv").contains("E")):
        parts = [rollups.centre_day(derived.filter(side)) for side in (split, ~split)]
        assert rows(rollups.merge_rollup(*parts), *CENTRE_DAY_KEYS, *MEASURES) == whole


def test_daily_total_is_effective_less_excluded(derived):
    counted = rollups.centre_day_with_gaps(derived)
    excluded = rollups.excluded_rows(counted).first()
    assert excluded.nb_effectifs == rollups.effective(derived).count()
    total = rollups.ars_daily(counted).agg(F.sum("nb")).first()[0]
    assert total == excluded.nb_effectifs - excluded.nb_exclus_cle_nulle


def test_region_extract(derived):
    daily = rollups.ars_daily(rollups.measured(derived))
    assert {r.region for r in region_extract(daily, "IDF").select("region").collect()} == {"IDF"}
    with pytest.raises(ValueError):
        region_extract(daily, "MAY")
    with pytest.raises(ValueError):
        region_extract(daily, "nowhere")


def control_rows(spark, *rows_):
    return spark.createDataFrame(
        [(f"C{i}", "75001", *row) for i, row in enumerate(rows_)],
        "id_centre string, cp_centre string, num_semaine long, debut_semaine date,"
        " rdv_annul long, rdv_honore long, rdv_non_honore long",
    )


def test_rules(spark):
    table = control_rows(
        spark,
        (3, D(2021, 1, 18), 2, 1, 0),
        (3, D(2021, 1, 18), 0, 2, 2),
        (3, D(2021, 1, 18), 0, 1, 2),
        (50, D(2021, 12, 13), 0, 0, 1),
        (1, D(2022, 1, 3), 0, 0, 1),
    )
    ids = lambda df: {r.id_centre for r in df.collect()}
    assert ids(controls.rule_1(table)) == {"C0"}
    assert ids(controls.rule_2(table, AS_OF)) == {"C2"}
    # Bare week numbers take the first week of the next year for a past one.
    assert ids(controls.rule_2(table, AS_OF, week_number_only=True)) == {"C2", "C4"}
    assert tuple(controls.rule_summary(table, AS_OF).first()) == (1, 1, 1, 1, 1, 1)


def test_summary_without_breaches(spark):
    table = control_rows(spark, (3, D(2021, 1, 18), 0, 1, 0))
    assert tuple(controls.rule_summary(table, AS_OF).first()) == (0, 0, 0, 0, 0, 0)


def test_quality_warnings(raw):
    valid = validation.valid_rows(validation.tag_rejects(raw(
        dict(id_centre=None, annee_naissance=None), dict(date_rdv="2022-01-01"),
        dict(operateur="doctolib", annee_naissance=None), dict(cp_centre=None, id_centre=None),
    )))
    got = {r.operateur: tuple(r)[1:] for r in quality.quality_warnings(valid, AS_OF).collect()}
    assert got == {"maiia": (1, 1, 2022, True, True), "doctolib": (0, 0, 2021, False, True)}
    monday = quality.quality_warnings(valid, "2021-12-13").first()
    assert monday.publie_un_vendredi is False


def test_checked_table_serves_rejects_and_figures(raw):
    df = raw(dict(id_centre=None), dict(cp_centre=None, id_centre=None), dict(honore="oui", type_vaccin="x"))
    checked = checked_bookings(df)
    rejects = stored_rejects(checked, AS_OF).collect()
    assert [(r.motif_rejet, r.honore, r.type_vaccin, r.date_rdv) for r in rejects] == [
        ("cp_centre", None, "NR", "2021-03-01"), ("honore", "oui", "NR", "2021-03-01"),
    ]
    figures = quality.stored_figures(checked, AS_OF).first()
    assert (figures.tot_row, figures.err_row, figures.nb_id_centre_absent) == (3, 2, 1)


def test_slots(spark):
    columns = "operateur, date, id_centre, nom_centre, cp_centre, nb_heures, nb_lignes, nb_creneaux, type_vaccin"
    df = spark.createDataFrame(
        [
            ("keldoc", "01/02/2021", "C1", "N", "2100", " -   ", "1", " -   ", None),
            ("maiia", "2021-01-04", "C1", "N", " 1234", " -   ", "1", "NR", "NR"),
            ("doctolib", "x", "C1", "N", None, "2", "1", "3", "Pfizer"),
        ],
        columns.replace(",", " string,") + " string",
    )
    first, second, third = normalize_slots(df).collect()
    assert (first.date, first.nb_heures, first.nb_creneaux, first.cp_centre) == (D(2021, 1, 2), None, None, "02100")
    # The blank marker belongs to keldoc only.
    assert (second.nb_heures, second.cp_centre, second.region) == (" -   ", "01234", "ARA")
    assert (third.date, third.code_departement, third.region) == (None, None, None)


def test_unknown_operator():
    with pytest.raises(ValueError):
        validation.check_operator("autre")
