"""Date rules.

A text is brought into ISO shape and cast, which is cheaper per row than a
pattern formatter and does not depend on the time zone. Each rule names its
input as rarely as possible: Spark pushes filters on a parsed date down to the
scan and then repeats the whole expression behind every use of the input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last day that a nanosecond timestamp can hold as a whole; dates
# beyond (9999-12-31 as a placeholder, say) are invalid.
DAY_BOUNDS = (dt.date(1677, 9, 22), dt.date(2262, 4, 11))
ISO_DAY = "^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})$"
NUMBER = "([0-9]{1,2})"
MARK = "[/.-]"
OLD_YEAR = "(69|[7-9][0-9])"


def as_day(value: str | dt.date) -> dt.date:
    """A calendar day from a date or an ISO text."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def monday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def publication_window(
    first_day: str | dt.date, as_of: str | dt.date, weeks: int
) -> tuple[dt.date, dt.date]:
    """First and last day (both included) of the published weeks."""
    last = monday(as_day(as_of)) + dt.timedelta(days=7 * int(weeks) - 1)
    return monday(as_day(first_day)), last


def iso_day(text: Column, bounds: tuple[dt.date, dt.date] = DAY_BOUNDS) -> Column:
    """``2021-01-08`` or ``2021-1-8`` from the first to the last of ``bounds``,
    both included; null for anything else."""
    # A text of another shape gives the empty string, which casts to null. The
    # one-element array keeps the expression single: it is named once.
    day = F.regexp_extract(text, ISO_DAY, 1).try_cast("date")
    low, high = (F.lit(bound) for bound in bounds)
    return F.get(F.filter(F.array(day), lambda d: d.between(low, high)), F.lit(0))


def _short_day_as_iso(text: Column) -> Column:
    """``08/01/21`` in ISO order, years 69 to 99 being 19xx; anything else in
    no valid shape."""
    without_dash = F.replace(text, F.lit("-"), F.lit("?"))
    old = F.regexp_replace(without_dash, f"^{NUMBER}/{NUMBER}/{OLD_YEAR}$", "19$3-$2-$1")
    return F.regexp_replace(old, f"^{NUMBER}/{NUMBER}/([0-9]{{2}})$", "20$3-$2-$1")


def booking_day(text: Column, operator: Column) -> Column:
    """Appointment date: day, month and short year for keldoc, else ISO.

    Leading zeros may be missing.
    """
    return iso_day(F.when(operator == "keldoc", _short_day_as_iso(text)).otherwise(text))


def free_day(text: Column) -> Column:
    """Day in any usual numeric form, month first where both readings fit. The
    time of day and what is not a date are not part of it: slots keep the
    delivered text beside the day."""
    day = F.substring_index(F.substring_index(text, " ", 1), "T", 1)
    iso = day
    for shape, form in (
        (f"^{NUMBER}{MARK}{NUMBER}{MARK}{OLD_YEAR}$", "$1/$2/19$3"),
        (f"^{NUMBER}{MARK}{NUMBER}{MARK}([0-9]{{2}})$", "$1/$2/20$3"),
        (f"^(0?[1-9]|1[0-2]){MARK}{NUMBER}{MARK}([0-9]{{4}})$", "$3-$1-$2"),
        (f"^{NUMBER}{MARK}{NUMBER}{MARK}([0-9]{{4}})$", "$3-$2-$1"),
    ):
        iso = F.regexp_replace(iso, shape, form)
    return F.coalesce(iso_day(day), iso_day(iso))


def strict_iso_day(text: Column, name: str) -> Column:
    """ISO date; a text that is not one fails the job, in any ANSI mode."""
    return or_fail(iso_day(text), text, f"{name} is not a date: ")


def or_fail(value: Column, text: Column, message: str) -> Column:
    """The value read from a text; a text without a value fails the job."""
    failure = F.raise_error(F.concat(F.lit(message), text))
    return F.when(text.isNotNull() & value.isNull(), failure).otherwise(value)


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def iso_week(day: Column) -> Column:
    """ISO week number."""
    return F.weekofyear(day).cast("long")
