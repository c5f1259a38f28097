"""Row-by-row typing and derived columns. None of these shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import clock, rules, text


def stamp(df: DataFrame, name: str, value: object = None) -> DataFrame:
    """A constant column: provenance, a discriminator, or (None) the time of the run."""
    return df.withColumn(name, F.current_timestamp() if value is None else F.lit(value))


def nullify(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Turn an exact sentinel text into NULL, column by column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(s)) for c, s in sentinels.items()})


def parse_timestamps(
    df: DataFrame, cols: Sequence[str], format: str | Sequence[str] | None = None, guess: bool = True
) -> DataFrame:
    """Text columns to timestamps; unparsable text becomes NULL, the row stays."""
    formats = (format,) if isinstance(format, str) else tuple(format or ())
    return df.withColumns({c: clock.read_time(F.col(c), formats, guess) for c in cols})


def split_time(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<col>_data`` (date) and ``<col>_hora`` (HH:mm) for each timestamp."""
    parts = {}
    for c in cols:
        parts[f"{c}_data"] = F.to_date(F.col(c))
        parts[f"{c}_hora"] = clock.hour_minute(F.col(c))
    return df.withColumns(parts)


def elapsed_minutes(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """Whole minutes from start to end; NULL if either is missing or the span overflows an int."""
    span = clock.minutes_between(F.col(start), F.col(end))
    return df.withColumn(out, span.try_cast("int"))


def regained_minutes(
    df: DataFrame, dep_pair: tuple[str, str], arr_pair: tuple[str, str], out: str
) -> DataFrame:
    """Departure delay less arrival delay, each truncated before the subtraction."""
    departure = clock.minutes_between(*map(F.col, dep_pair))
    arrival = clock.minutes_between(*map(F.col, arr_pair))
    return df.withColumn(out, (departure - arrival).try_cast("int"))


def decimal_comma(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, text.decimal_comma(F.col(col)))


def on_time(df: DataFrame, metric: str, out: str, threshold: int = 15) -> DataFrame:
    return df.withColumn(out, rules.on_time(F.col(metric), threshold))


def on_time_by_clock(df: DataFrame, planned: str, actual: str, out: str) -> DataFrame:
    return df.withColumn(out, rules.on_time_by_clock(F.col(planned), F.col(actual)))


def classify(
    df: DataFrame,
    col: str,
    labels: Mapping[str, Sequence[str]],
    out: str,
    default: str | None = None,
    by_prefix: bool = False,
) -> DataFrame:
    return df.withColumn(out, rules.classified(F.col(col), labels, default, by_prefix))


def calendar_parts(
    df: DataFrame,
    ts: str,
    locale: str = "en",
    hour: str = "hora_partida_prevista",
    weekday: str = "dia_semana",
    month: str = "mes_referencia",
) -> DataFrame:
    """Hour of day, weekday name and the month as a timestamp at its first midnight."""
    return df.withColumns(
        {
            hour: F.hour(F.col(ts)),
            weekday: clock.weekday(F.col(ts), locale),
            month: F.date_trunc("month", F.col(ts)),
        }
    )


def route(df: DataFrame, a: str, b: str, out: str, sep: str = " - ") -> DataFrame:
    return df.withColumn(out, text.joined(F.col(a), F.col(b), sep))
