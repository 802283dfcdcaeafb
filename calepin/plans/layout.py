"""Where the jobs keep their tables under the output folder."""

from __future__ import annotations

import datetime as dt

from calepin.functions.dates import as_day

CHECKED = "rdv_controles"
CENTRE_DAY = "centre_jour"
DAILY = "rdv_jour"
WEEKLY = "rdv_semaine"
REJECTS = "rejets"
ERROR_REPORT = "rapport_err"
SLOTS = "creneaux"


def stored(out: str, table: str) -> str:
    """Parquet or report table, partitioned by publication date."""
    return f"{out}/{table}"


def published(out: str, as_of: str | dt.date, *parts: str) -> str:
    """CSV folder of one publication."""
    return "/".join([out, "publication", as_day(as_of).isoformat(), *parts])
