"""Business rules of a flight leg as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_time(metric: Column, threshold: int) -> Column:
    """Within the threshold; an unknown delay stays unknown, an early leg is on time."""
    return metric <= F.lit(threshold)


def on_time_by_clock(planned: Column, actual: Column) -> Column:
    """No later than planned. Unknown without an actual time, but FALSE without a planned one."""
    return F.when(actual.isNotNull(), F.coalesce(actual <= planned, F.lit(False)))


def classified(
    code: Column, labels: Mapping[str, Sequence[str]], default: str | None, by_prefix: bool = False
) -> Column:
    """The label of the set, or of the prefix list, a code belongs to."""
    answer = F.lit(default).cast("string")
    for label, values in reversed(labels.items()):
        if by_prefix:
            belongs = reduce(Column.__or__, [code.startswith(prefix) for prefix in values])
        else:
            belongs = code.isin(*values)
        answer = F.when(belongs, label).otherwise(answer)
    return answer


def outside(checks: Sequence[Column], low: int, high: int) -> Column:
    """True when any known value leaves [low, high]; never NULL."""
    return F.coalesce(reduce(Column.__or__, [~c.between(low, high) for c in checks]), F.lit(False))
