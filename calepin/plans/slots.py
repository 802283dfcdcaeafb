"""Files to normalised opening slots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from calepin.model import OPERATORS, SLOT
from calepin.operators.normalization import normalize_slots
from calepin.operators.quality import slot_quality
from calepin.plans import layout
from calepin.sources.drops import chosen_drops
from calepin.sources.feeds import read_publication, read_slots
from calepin.sources.sinks import write_csv, write_publication


def process_slots(
    spark: SparkSession,
    landing: str,
    out: str,
    as_of: str | dt.date,
    multi_line: bool = False,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Normalise each operator's newest slot drop, store and publish the rows.

    Returns the figures per operator, a missing feed having no rows.
    """
    raw = read_slots(spark, chosen_drops(spark, landing, as_of, slots=True), multi_line)
    slots = normalize_slots(raw, dimension=dimension)
    path = layout.stored(out, layout.SLOTS)
    write_publication(slots, path, as_of, "operateur")
    stored = read_publication(spark, path, slots.schema.add("date_publication", "date"), as_of)
    write_csv(stored.select(*SLOT), layout.published(out, as_of, "creneaux"))
    return slot_quality(stored, OPERATORS)
