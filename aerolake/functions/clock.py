"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000

# Weekday names, Sunday first.
WEEKDAYS = {
    "en": ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"),
    "pt": (
        "domingo",
        "segunda-feira",
        "terça-feira",
        "quarta-feira",
        "quinta-feira",
        "sexta-feira",
        "sábado",
    ),
}


# What Spark's cast to a time trims, and the signs of a year.
LEADING = " \t\n\x0b\x0c\r+-"


def has_date(value: Column) -> Column:
    """Whether a text that reads as a time names more of its date than a year.

    A date has a hyphen after its year, ahead of any colon; a bare time of day and a bare year, of which the
    cast would have to guess the rest, have none there. Plain searches, so no pattern runs per row.
    """
    return F.contains(F.ltrim(F.substring_index(value, ":", 1), F.lit(LEADING)), F.lit("-"))


def read_time(value: Column, formats: Sequence[str] = (), guess: bool = True) -> Column:
    """Timestamp from text, NULL on failure.

    Without formats this is Spark's lenient cast. It also reads a bare year, as its first moment, and a
    bare time of day as *today*; with ``guess=False`` these two become NULL, which is what a repeatable
    load needs. With formats only those layouts parse.
    """
    if not formats:
        read = value.try_cast("timestamp")
        return read if guess else F.when(has_date(value), read)
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(layout)) for layout in formats])


def hour_minute(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed minutes, truncated toward zero (bigint).

    With the session zone at UTC this is timestampdiff(MINUTE, ...), at a fraction of its cost.
    """
    elapsed = F.unix_micros(end) - F.unix_micros(start)
    return F.call_function("div", elapsed, F.lit(MICROS_PER_MINUTE))


def weekday(ts: Column, locale: str = "en") -> Column:
    """Lower-case weekday name; picked from a list, which costs a quarter of formatting the date."""
    if locale not in WEEKDAYS:
        raise ValueError(f"no weekday names for locale {locale!r}")
    # get() answers NULL for a NULL index; element_at() does not under code generation.
    return F.get(F.array(*[F.lit(day) for day in WEEKDAYS[locale]]), F.dayofweek(ts) - 1)
