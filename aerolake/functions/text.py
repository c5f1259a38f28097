"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(value: Column) -> Column:
    """True where a key is usable; never NULL."""
    return value.isNotNull() & (value != "")


def decimal_comma(value: Column) -> Column:
    """Number written with a decimal comma; NULL where it does not parse (a thousands point, say)."""
    return F.replace(value, F.lit(","), F.lit(".")).try_cast("double")


def joined(first: Column, second: Column, sep: str = " - ") -> Column:
    """Both texts with a separator; NULL when either is."""
    return F.concat(first, F.lit(sep), second)


def labelled(value: Column, label: str, code: Column) -> Column:
    """The value, or the label followed by the code it was looked up by."""
    return F.coalesce(value, F.concat(F.lit(label), code))


def or_label(value: Column, label: str) -> Column:
    """The value, or the label where it is blank or missing."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(label))
