"""Dates given relative to the time of reading, and the day a row is filed under."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions.text import _plain_digits

# The calendar starts at year 1, so many seconds before 1970.
_FIRST_SECOND = -62_135_596_800
# Numbers of more digits lead out of the calendar, whatever their unit.
_MOST_DIGITS = 20


def _seconds_back(text: Column) -> Column:
    """Seconds that 'il y a 3 jours' goes back, as a decimal; 0 without a number or a known unit.

    NULL if the number alone leads out of the calendar. Leading zeros don't count.
    """
    words = F.lower(text)
    digits = F.regexp_extract(_plain_digits(words), r"\d+", 0)
    step = F.lit(0)
    for unit, seconds in reversed(V.DATE_UNITS):
        step = F.when(words.contains(unit), F.lit(seconds)).otherwise(step)
    number = F.ltrim(digits, F.lit("0"))
    amount = F.when(number == "", F.lit(0)).when(F.length(number) <= _MOST_DIGITS, number.try_cast("decimal(20,0)"))
    return F.when((digits == "") | (step == 0), F.lit(0).cast("decimal(28,0)")).otherwise((amount * step).cast("decimal(28,0)"))


def _in_calendar(text: Column, seen_at: Column) -> Column:
    back = _seconds_back(text)
    return F.coalesce(back <= F.unix_seconds(seen_at.cast("timestamp")) - _FIRST_SECOND, F.lit(False))


def absolute_date(text: Column, seen_at: Column) -> Column:
    """'il y a 3 jours' seen at a time, as the formatted time it stands for.

    Without a number or a known unit it is the time of reading; without a text it
    is NULL, as it is for steps that lead out of the calendar (:func:`date_problem`).
    """
    back = F.when(_in_calendar(text, seen_at), _seconds_back(text).try_cast("bigint"))
    when = F.timestamp_add("SECOND", -back, seen_at)
    return F.when(text != "", F.date_format(when, V.DATE_FORMAT))


def published_time(text: Column) -> Column:
    """The time a formatted date stands for; NULL for any other text."""
    return F.try_to_timestamp(text, F.lit(V.DATE_FORMAT))


def date_problem(text: Column, seen_at: Column) -> Column:
    """What is wrong with a relative date that leads out of the calendar; NULL if nothing is."""
    return F.when((text != "") & seen_at.isNotNull() & ~_in_calendar(text, seen_at), F.lit("date value out of range"))


def utc_day(ts: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)
