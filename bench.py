"""Time the jobs and headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores, BENCH_COPIES multiplies
the derived feeds, each copy with centres of its own, so that groups grow with
the rows. The drops the jobs read are written before any timing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from calepin.model import OPERATORS  # noqa: E402
from calepin.operators import controls, rollups  # noqa: E402
from calepin.plans import layout  # noqa: E402
from calepin.plans.bookings import process_bookings  # noqa: E402
from calepin.plans.controls import control_bookings  # noqa: E402
from calepin.plans.publication import publish, publish_from_partials  # noqa: E402
from calepin.plans.slots import process_slots  # noqa: E402
from calepin.sources import feeds  # noqa: E402
from calepin.sources.workspace import work_folder  # noqa: E402
from calepin.streaming.ingest import ingest_new_drops  # noqa: E402
from checks.fixtures import AS_OF, FIRST_DAY, WEEKS  # noqa: E402
from checks.registry import QUERIES, deliver_bookings, deliver_slots  # noqa: E402

CPUS = os.environ.get("BENCH_CPUS", "8")
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))


def session(shared: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("calepin-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        # Methods above this size are never compiled by the JVM.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    shared = os.environ.get("BENCH_FOLDER") or tempfile.mkdtemp(prefix="calepin-bench-")
    spark = session(shared)
    out = work_folder(shared)
    bookings = deliver_bookings(spark, SF_DIR, COPIES)
    slots = deliver_slots(spark, SF_DIR, COPIES)
    landing = f"{bookings}/rdv"

    def stored():
        return feeds.read_normalized(spark, layout.stored(out, layout.CHECKED), AS_OF)

    def partials():
        return [
            rollups.centre_day_with_gaps(stored().filter(F.col("operateur") == name)) for name in OPERATORS
        ]

    steps = {
        "validate_normalize": lambda: process_bookings(spark, landing, out, AS_OF),
        "publication": lambda: publish(spark, out, AS_OF, FIRST_DAY, WEEKS),
        "publication_from_partials": lambda: publish_from_partials(
            partials(), out, AS_OF, FIRST_DAY, WEEKS
        ),
        "controls": lambda: control_bookings(spark, out, AS_OF)["resume"].collect(),
        "slots": lambda: process_slots(spark, f"{slots}/creneaux", out, AS_OF).collect(),
        "ingest": lambda: ingest_new_drops(spark, landing, work_folder(out), work_folder(out)),
        "centre_day": lambda: run(rollups.centre_day(stored())),
        "ars_daily": lambda: run(rollups.ars_daily(rollups.measured(stored()))),
        "weekly_hierarchy": lambda: run(rollups.weekly_hierarchy(rollups.measured(stored()), AS_OF)),
        "control_table": lambda: run(controls.control_table(stored())),
        "weekly_national_from_raw": lambda: run(QUERIES["weekly_national"](spark, SF_DIR)),
        "normalized_creneaux_from_raw": lambda: run(QUERIES["normalized_creneaux"](spark, SF_DIR)),
    }
    times, runs = {}, {}
    for name, step in steps.items():
        # The first run loads and compiles classes; the better of two counts.
        runs[name] = []
        for _ in range(2):
            start = time.perf_counter()
            step()
            runs[name].append(round(time.perf_counter() - start, 3))
        times[name] = min(runs[name])
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": runs,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "copies": COPIES,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
