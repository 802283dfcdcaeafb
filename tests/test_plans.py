"""Shape of the physical plans over stored tables."""

import contextlib
import io
import re

import pytest

from calepin.operators import controls, rollups
from calepin.operators.normalization import checked_bookings, normalize_slots
from calepin.sources import feeds
from calepin.sources.sinks import write_partitions
from checks.fixtures import AS_OF, raw_bookings, raw_slots
from conftest import SF_DIR
from pyspark.sql import functions as F


def scan(df):
    """Pushed filters and columns of the scan, in full."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    lines = printed.getvalue().splitlines()
    return {
        name: next(line for line in lines if line.startswith(name))
        for name in ("PushedFilters", "ReadSchema", "PartitionFilters")
        if any(line.startswith(name) for line in lines)
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "rdv")
    checked = checked_bookings(raw_bookings(spark, SF_DIR))
    write_partitions(
        checked.withColumn("date_publication", F.lit(AS_OF).cast("date")), path, "date_publication", "operateur"
    )
    return path


def test_normalisation_needs_no_shuffle(spark):
    for df in (checked_bookings(raw_bookings(spark, SF_DIR)), normalize_slots(raw_slots(spark, SF_DIR))):
        text = plan(df)
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
        assert "BroadcastHashJoin" in text and "Python" not in text


def test_weekly_scan_reads_few_columns_and_one_publication(spark, stored):
    bookings = feeds.read_normalized(spark, stored, AS_OF)
    df = rollups.weekly(rollups.measured(bookings), "national", AS_OF)
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1
    # The publication's own folder is opened and no other.
    leaf = bookings._jdf.queryExecution().optimizedPlan().collectLeaves().head()
    assert leaf.relation().location().rootPaths().mkString(" ").endswith(f"date_publication={AS_OF}")
    found = scan(df)
    assert not any(name in found["ReadSchema"] for name in ("motif_rdv", "annee_naissance", "brut"))
    assert "GreaterThanOrEqual(date_rdv" in found["PushedFilters"]
    assert "IsNull(motif_rejet)" in found["PushedFilters"]


def test_aggregates_combine_before_the_shuffle(spark, stored):
    bookings = feeds.read_normalized(spark, stored, AS_OF)
    for df in (
        rollups.centre_day_with_gaps(bookings),
        rollups.ars_daily(rollups.measured(bookings)),
        controls.control_table(bookings),
    ):
        text = plan(df)
        assert "partial_" in text and text.count("Exchange hashpartitioning") == 1


def test_hierarchy_expands_the_department_table_only(spark, stored):
    text = plan(rollups.weekly_hierarchy(rollups.measured(feeds.read_normalized(spark, stored, AS_OF)), AS_OF))
    # Read upwards: scan, first aggregation, expand, second aggregation.
    assert text.index("Expand") < text.rindex("HashAggregate") < text.index("FileScan")
    assert text.count("FileScan") == 1


def test_rejects_read_only_their_columns(spark, stored):
    from calepin.operators.normalization import stored_rejects

    found = scan(stored_rejects(feeds.read_checked(spark, stored, AS_OF), AS_OF))
    assert "IsNotNull(motif_rejet)" in found["PushedFilters"]
    assert "rdv_rappel" not in found["ReadSchema"]


def test_generated_methods_stay_compilable(spark, tmp_path):
    # The JVM interprets methods of more than 8000 bytes for good.
    raw_bookings(spark, SF_DIR).write.parquet(str(tmp_path / "rdv"))
    raw_slots(spark, SF_DIR).write.parquet(str(tmp_path / "creneaux"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (
            checked_bookings(spark.read.parquet(str(tmp_path / "rdv"))),
            normalize_slots(spark.read.parquet(str(tmp_path / "creneaux"))),
        ):
            df.createOrReplaceTempView("genere")
            text = spark.sql("explain codegen select * from genere").first()[0]
            sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_each_published_table_is_aggregated_once(spark, tmp_path, monkeypatch):
    """Only the daily and the weekly centre table read the centre-day counts."""
    from calepin.plans import publication

    written = []
    monkeypatch.setattr(publication, "write_csv", lambda df, *a, **k: written.append(" ".join(df.inputFiles())))
    monkeypatch.setattr(publication, "write_by_region", lambda df, *a: written.append(" ".join(df.inputFiles())))
    counted = publication.store_counted(
        rollups.centre_day_with_gaps(checked_bookings(raw_bookings(spark, SF_DIR))), str(tmp_path), AS_OF
    )
    publication.write_published_tables(counted, str(tmp_path), AS_OF)
    assert len(written) == 7
    assert sum("centre_jour" in text for text in written) == 1  # the excluded rows
    assert sum("rdv_semaine" in text for text in written) == 4 and sum("rdv_jour" in text for text in written) == 2
