"""Text rules: missing values, booleans, doses, vaccine types, reasons."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from calepin.model import BOOSTER_WORDS, FALSE_TEXTS, NOT_PROVIDED, NULL_TOKENS, SLOT_BLANK, TRUE_TEXTS


def missing_to_null(name: str) -> Column:
    """The named column, null for the texts that stand for a missing value."""
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    return F.expr(f"if(`{name}` in ({tokens}), null, `{name}`)").alias(name)


def or_not_provided(text: Column) -> Column:
    return F.coalesce(text, F.lit(NOT_PROVIDED))


def three_valued(text: Column) -> Column:
    """``true``, ``false``, or ``NR`` for a blank; null for any other text."""
    return (
        F.when(text.isin(*TRUE_TEXTS), F.lit("true"))
        .when(text.isin(*FALSE_TEXTS), F.lit("false"))
        .when(text.isNull(), F.lit(NOT_PROVIDED))
    )


def dose(text: Column) -> Column:
    """Dose number 1 to 6; a 3 anywhere beats a 4 anywhere."""
    return or_not_provided(
        F.when((text == "R") | text.contains("3"), F.lit("3"))
        .when(text.contains("4"), F.lit("4"))
        .when(text.isin("1", "2", "5", "6"), text)
    )


def vaccine(reason_lower: Column, delivered: Column) -> Column:
    """Vaccine named in the lower-cased reason, else the delivered one.

    Paediatric beats Pfizer beats Moderna beats Janssen beats AstraZeneca.
    """
    return (
        F.when(
            reason_lower.contains("pedia") | reason_lower.contains("pédia"),
            F.lit("Pfizer Pédiatrique"),
        )
        .when(reason_lower.contains("pfizer"), F.lit("Pfizer"))
        .when(reason_lower.contains("moderna"), F.lit("Moderna"))
        .when(reason_lower.contains("janssen"), F.lit("Janssen"))
        .when(reason_lower.contains("astrazeneca"), F.lit("AstraZeneca"))
        .otherwise(or_not_provided(delivered))
    )


def _as_text(condition: Column) -> Column:
    return F.when(condition, F.lit("true")).otherwise(F.lit("false"))


def insurer_flag(reason_upper: Column) -> Column:
    """``true`` where the upper-cased reason names the health insurer."""
    return _as_text(reason_upper.contains("CNAM"))


def booster_flag(reason_upper: Column) -> Column:
    """``true`` where the upper-cased reason speaks of a booster."""
    return _as_text(reduce(or_, map(reason_upper.contains, BOOSTER_WORDS)))


def slot_count(text: Column) -> Column:
    """Slot count as delivered, with the blank marker turned into null."""
    return F.when(text != SLOT_BLANK, text)
