"""Quality rules and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions import measures, rules

AUDIT = ("_arquivo_origem", "_ingerido_em", "_transformado_em", "_processado_em")


def quarantine_range(
    df: DataFrame,
    checks: Sequence[str],
    metrics: Sequence[str],
    flag: str,
    low: int = -120,
    high: int = 1440,
) -> DataFrame:
    """Keep the row, but null all metrics and raise the flag when any check leaves [low, high]."""
    # Flag first: it must see the raw values.
    flagged = df.withColumn(flag, rules.outside([F.col(c) for c in checks], low, high))
    return flagged.withColumns({m: F.when(~F.col(flag), F.col(m)) for m in metrics})


def dedupe_exact(df: DataFrame, ignore: Sequence[str] = AUDIT) -> DataFrame:
    """One row per distinct business row; of the ignored audit columns the least value stays.

    An aggregate combines copies before the shuffle, so one row repeated a billion times travels as
    one row per task, and taking the least audit value gives the same answer on every attempt. Text
    among the audit columns turns the hash aggregate into a sorting one; drop it first if unused.
    """
    audit = [c for c in df.columns if c in set(ignore)]
    business = [c for c in df.columns if c not in set(ignore)]
    if not audit:
        return df.distinct()
    single = df.groupBy(*business).agg(*[F.min(c).alias(c) for c in audit])
    return single.select(*df.columns)


def profile(df: DataFrame, measured: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Named measures over the whole table or per group, in one pass."""
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in measured.items()])


def row_parity(
    parts: Mapping[str, DataFrame],
    target: str,
    actual: DataFrame,
    expected: str | None = None,
    difference: str | None = "diferenca",
    key: str | None = None,
    same_keys: str = "mesmas_chaves",
) -> DataFrame:
    """One row: the count of each part, their sum, the target's count, and what is missing.

    With a whole-number ``key`` also whether both sides hold the same keys equally often, by their sum
    and exclusive or. That makes the rows themselves be read; a bare count of a row-by-row result is
    answered from file footers and cannot show a row that was lost on the way.
    """
    tables = {**parts, target: actual}
    checks = [measures.rows().alias("n")]
    if key is not None:
        long_key = F.coalesce(F.col(key).cast("long"), F.lit(0))
        checks += [F.sum(long_key.cast("decimal(38,0)")).alias("s"), F.bit_xor(long_key).alias("x")]
    counted = [df.agg(*checks).withColumn("t", F.lit(name)) for name, df in tables.items()]
    on_target = F.col("t") == target
    both = reduce(DataFrame.unionByName, counted)
    sides = [F.sum(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in tables]
    if key is not None:
        sums = F.sum(F.when(on_target, -F.col("s")).otherwise(F.col("s")))
        sides.append(((sums == 0) & (F.bit_xor("x") == 0)).alias(same_keys))
    one_row = both.agg(*sides)
    total = reduce(Column.__add__, [F.col(name) for name in parts])
    columns = [F.col(name) for name in parts]
    if expected is not None:
        columns.append(total.alias(expected))
    columns.append(F.col(target))
    if difference is not None:
        columns.append((total - F.col(target)).alias(difference))
    if key is not None:
        columns.append(F.coalesce(F.col(same_keys), total == F.col(target)).alias(same_keys))
    return one_row.select(*columns)


def manifest(df: DataFrame, file_col: str, ts_col: str) -> DataFrame:
    """Rows and last ingest time of each source file."""
    return profile(
        df, {"linhas": measures.rows(), "ingerido_em": F.max(ts_col)}, by=(file_col,)
    ).orderBy(file_col)


def sample_by_keys(
    df: DataFrame, col: str, keys: Sequence[str], take: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of a few known keys, sorted.

    Give a tie-breaker in ``order`` when keys repeat: the range partitioner can then split a hot key.
    """
    return df.where(F.col(col).isin(*keys)).select(*take).orderBy(*order)


def earliest(df: DataFrame, order: str, n: int = 5, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first n rows, unknown times first; a top-k per task, never a full sort."""
    return df.orderBy(F.col(order).asc_nulls_first(), *tie_break).limit(n)
