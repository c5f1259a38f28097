"""Aggregate expressions; all of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def filled(column: str) -> Column:
    """Rows whose column is not NULL."""
    return F.count(F.col(column))


def hits(predicate: Column) -> Column:
    """Rows for which the predicate is true; 0 on empty input."""
    return F.count_if(predicate)


def hits_or_null(predicate: Column, among: Column | None = None) -> Column:
    """Rows (``among`` some) for which the predicate is true; NULL if there are none, as a plain SUM answers."""
    hit = F.when(predicate, 1).otherwise(0)
    return F.sum(hit if among is None else F.when(among, hit))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits)
