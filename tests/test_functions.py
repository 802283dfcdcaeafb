"""Input and expected value of every column rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from calepin.functions import dates, postcodes, texts

D = dt.date


def check(evaluate, rule, pairs):
    assert evaluate(rule, *(given for given, _ in pairs)) == [expected for _, expected in pairs]


def test_three_valued(evaluate):
    check(evaluate, texts.three_valued, [
        ("t", "true"), ("VRAI", "true"), ("TRUE", "true"), ("true", "true"),
        ("F", "false"), ("f", "false"), ("FAUX", "false"), ("false", "false"), (None, "NR"),
        ("oui", None), ("?", None), ("True", None), ("NR", None),
    ])


def test_dose(evaluate):
    check(evaluate, texts.dose, [
        ("R", "3"), ("dose 3", "3"), ("34", "3"), ("43", "3"), ("14", "4"), ("4", "4"), ("10", "NR"),
        (" 1", "NR"), ("1", "1"), ("2", "2"), ("5", "5"), ("6", "6"), ("7", "NR"), (None, "NR"),
    ])


def test_vaccine(evaluate):
    check(evaluate, lambda motif, kind: texts.vaccine(F.lower(motif), kind), [
        (("astrazeneca puis Janssen", "Pfizer"), "Janssen"),
        (("Pfizer PÉDIATRIE", None), "Pfizer Pédiatrique"),
        (("pedia moderna", None), "Pfizer Pédiatrique"),
        (("moderna ou PFIZER", None), "Pfizer"),
        (("AstraZeneca", None), "AstraZeneca"),
        (("1ere dose", "Moderna"), "Moderna"),
        (("1ere dose", None), "NR"),
        ((None, None), "NR"),
    ])


def test_reason_flags(evaluate):
    check(evaluate, lambda m: texts.insurer_flag(F.upper(m)), [
        ("1ere CNAM", "true"), ("cnam", "true"), ("NR", "false"),
    ])
    check(evaluate, lambda m: texts.booster_flag(F.upper(m)), [
        ("Rappel", "true"), ("3e dose", "true"), ("13 ans", "true"), ("immunodeprime", "true"),
        ("dose trois", "true"), ("1ere dose", "false"),
    ])


def test_missing_values(evaluate):
    check(evaluate, lambda c: texts.missing_to_null("c0"), [
        ("NA", None), ("null", None), ("N/A", None), ("nan", None), ("None", None), ("", None),
        ("#N/A", None), ("<NA>", None), ("NR", "NR"), ("-", "-"), ("NAN", "NAN"), (None, None),
    ])


def test_slot_count(evaluate):
    check(evaluate, texts.slot_count, [(" -   ", None), ("-", "-"), ("12", "12"), (None, None)])


def test_booking_postcode_padding(evaluate):
    check(evaluate, postcodes.pad_booking_postcode, [
        ("1234", "01234"), ("0123", "0123"), ("12345", "12345"), ("1234 Cedex", "1234 Cedex"), (None, None),
    ])


def test_slot_postcode_padding(evaluate):
    check(evaluate, postcodes.pad_slot_postcode, [
        (" 1234", "01234"), (" 0123", "00123"), (" 75001", "75001"), ("1234", "01234"),
        ("  123", "0 123"), ("0123", "0123"), (None, None),
    ])


def test_department(evaluate):
    check(evaluate, postcodes.department, [
        ("75001", "75"), ("97133", "971"), ("20000", "2A"), ("20199", "2A"), ("20200", "2B"),
        ("20999", "2B"), ("21000", "21"), ("2010 Cedex", "20"), ("20100 Cedex", "2A"), ("1234 Cedex", "12"),
        ("98000", "98"), ("abc", "ab"), (None, None),
    ])


def test_postcode_check(evaluate):
    check(evaluate, postcodes.is_postcode, [
        ("1234", True), ("12345", True), ("12345 Cedex", True), ("1234 Cedex", True),
        ("123", False), ("123456", False), ("12345 CEDEX", False), (None, False), (" 12345", False),
    ])


def test_iso_day(evaluate):
    check(evaluate, dates.iso_day, [
        ("2021-01-08", D(2021, 1, 8)), ("2021-1-8", D(2021, 1, 8)), ("2021-02-30", None),
        ("2021-01", None), ("2021-01-08 10:00:00", None), (" 2021-01-08", None), ("2021-1-8 ", None),
        ("2021-01-08T", None), ("12021-1-1", None), ("9999-12-31", None), ("1678-01-01", D(1678, 1, 1)),
        ("2261-12-31", D(2261, 12, 31)), ("2262-12-31", None), ("1600-01-01", None), ("", None), (None, None),
    ])


def test_booking_day(evaluate):
    check(evaluate, lambda text, op: dates.booking_day(text, op), [
        (("08/01/21", "keldoc"), D(2021, 1, 8)), (("8/1/21", "keldoc"), D(2021, 1, 8)),
        (("08/01/2021", "keldoc"), None), (("2021-01-08", "keldoc"), None), (("8-1-21", "keldoc"), None),
        (("08/01/69", "keldoc"), D(1969, 1, 8)), (("08/01/68", "keldoc"), D(2068, 1, 8)),
        (("08/01/99", "keldoc"), D(1999, 1, 8)), (("31/02/21", "keldoc"), None), ((None, "keldoc"), None),
        (("2021-01-08", "maiia"), D(2021, 1, 8)), (("08/01/21", "doctolib"), None),
    ])


def test_free_day(evaluate):
    check(evaluate, dates.free_day, [
        ("01/02/2021", D(2021, 1, 2)), ("13/02/2021", D(2021, 2, 13)), ("02/30/2021", None),
        ("2021-03-04", D(2021, 3, 4)), ("2021-03-04 08:30:00", D(2021, 3, 4)),
        ("2021-03-04T08:30:00", D(2021, 3, 4)), ("1-2-2021", D(2021, 1, 2)), ("31.12.2021", D(2021, 12, 31)),
        ("01/02/21", D(2021, 1, 2)), ("01/02/70", D(1970, 1, 2)), ("32/13/2021", None), ("demain", None), (None, None),
    ])


def test_strict_day(evaluate):
    assert evaluate(lambda c: dates.strict_iso_day(c, "date_rdv"), "2021-01-08", None) == [D(2021, 1, 8), None]
    with pytest.raises(Exception, match="date_rdv is not a date: demain"):
        evaluate(lambda c: dates.strict_iso_day(c, "date_rdv"), "demain")


def test_week(evaluate):
    day = lambda c: c.cast("date")
    check(evaluate, lambda c: dates.week_start(day(c)), [
        ("2021-01-24", D(2021, 1, 18)), ("2021-01-18", D(2021, 1, 18)), ("2021-01-03", D(2020, 12, 28)),
    ])
    check(evaluate, lambda c: dates.iso_week(day(c)), [
        ("2021-01-24", 3), ("2021-01-03", 53), ("2022-01-03", 1),
    ])


def test_publication_window():
    assert dates.publication_window("2021-01-18", "2021-12-17", 5) == (D(2021, 1, 18), D(2022, 1, 16))
    assert dates.publication_window(D(2021, 1, 20), "2021-12-13", 1) == (D(2021, 1, 18), D(2021, 12, 19))
