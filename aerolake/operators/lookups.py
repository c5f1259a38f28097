"""Registries, key sets and left-outer lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import measures, text
from aerolake.session import broadcastable, small

MATCH = "__lookup_key"
SALT = "__salt"


def union_with_provenance(branches: Mapping[str, DataFrame], out: str) -> DataFrame:
    """UNION ALL of same-shape tables, each row marked with the branch it came from."""
    marked = [df.withColumn(out, F.lit(label)) for label, df in branches.items()]
    return reduce(DataFrame.unionByName, marked)


def key_set(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Distinct usable keys over several columns, in one scan of the table."""
    keys = df.select(F.explode(F.array(*map(F.col, cols))).alias(out))
    return keys.where(text.has_text(F.col(out))).distinct()


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    take: Mapping[str, str],
    domain: tuple[str, str] | None = None,
    fallback: Mapping[str, str] | None = None,
    present_flag: str | None = None,
    on_duplicate: str = "keep",
    salts: int = 1,
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Left-outer lookup that keeps every row of ``df``.

    A blank key names nobody and finds nothing. The lookup is broadcast if it is a literal list or its
    files are below Catalyst's threshold; beyond that the join shuffles and adaptive execution splits
    hot keys.

    take          lookup column -> output column
    domain        (column, value) the lookup rows must carry; unmatched rows of ``df`` still stay
    fallback      output column -> label; a missing value becomes the label followed by the key
    present_flag  output column telling whether the key was found
    on_duplicate  'keep' repeats a row for each lookup row of its key (plain SQL behaviour),
                  'error' fails the query on a key found twice, 'merge' takes the least row per key
    salts         spread each key over that many shuffle partitions, for clusters where adaptive
                  skew splitting is off; the lookup is repeated once per salt
    salt_by       columns of ``df`` that deal out the salts (default: all of them)
    """
    side = lookup
    if domain is not None:
        side = side.where(F.col(domain[0]) == F.lit(domain[1]))
    side = side.select(F.col(lookup_key).alias(MATCH), *[F.col(c).alias(o) for c, o in take.items()])
    side = _with_policy(side.where(text.has_text(F.col(MATCH))), on_duplicate)
    few = salts == 1 and broadcastable(side)

    condition = F.col(key) == F.col(MATCH)
    helpers = [MATCH]
    left = df
    if salts > 1:
        # The salt depends on the row alone, so a recomputed task deals out the same salts.
        dealt = F.xxhash64(*map(F.col, salt_by or df.columns))
        left = df.withColumn(SALT, F.pmod(dealt, F.lit(salts)))
        every_salt = F.array(*[F.lit(n).cast("long") for n in range(salts)])
        side = side.withColumn(SALT + "_side", F.explode(every_salt))
        condition = condition & (F.col(SALT) == F.col(SALT + "_side"))
        helpers += [SALT, SALT + "_side"]
    joined = left.join(F.broadcast(side) if few else side, condition, "left")

    settled = {
        out: text.labelled(F.col(out), label, F.col(key)) for out, label in (fallback or {}).items()
    }
    if present_flag is not None:
        settled[present_flag] = F.col(MATCH).isNotNull()
    if settled:
        joined = joined.withColumns(settled)
    return joined.drop(*helpers)


def _with_policy(side: DataFrame, on_duplicate: str) -> DataFrame:
    if on_duplicate == "keep":
        return side
    values = [c for c in side.columns if c != MATCH]
    packed = F.struct(*map(F.col, values)) if values else F.lit(0)
    single = side.groupBy(MATCH).agg(measures.rows().alias("__n"), F.min(packed).alias("__row"))
    key = F.col(MATCH)
    if on_duplicate == "error":
        complaint = F.concat(F.lit("lookup key found more than once: "), key.cast("string"))
        key = F.when(F.col("__n") == 1, key).otherwise(F.raise_error(complaint))
    elif on_duplicate != "merge":
        raise ValueError(f"on_duplicate must be keep, error or merge, not {on_duplicate!r}")
    return single.select(key.alias(MATCH), *[F.col("__row")[c].alias(c) for c in values])


def key_usage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(coluna, chave, linhas) for every usable key of the columns; one scan, combined before the shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("chave")) for c in cols])
    return (
        df.select(F.inline(cells))
        .where(text.has_text(F.col("chave")))
        .groupBy("coluna", "chave")
        .agg(measures.rows().alias("linhas"))
    )


def uncovered_keys(
    df: DataFrame,
    cols: Sequence[str],
    dim: DataFrame,
    key: str,
    domain: str | None = None,
) -> DataFrame:
    """Keys of ``df`` that the dimension lacks, with the rows that carry them.

    With ``domain`` the dimension holds several code lists and that column names the fact column.
    The fact is reduced to one row per key before it meets the dimension.
    """
    used = key_usage(df, cols)
    known = dim.select(F.col(key).alias("__known"), *([F.col(domain).alias("__domain")] if domain else []))
    condition = F.col("chave") == F.col("__known")
    if domain:
        condition = condition & (F.col("coluna") == F.col("__domain"))
    return used.join(small(known), condition, "left_anti")


def coverage(
    df: DataFrame, cols: Sequence[str], dims: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Uncovered keys against several dimensions, from one pass over ``df``: (alvo, coluna, chave, linhas)."""
    used = key_usage(df, cols)
    missing = []
    for target, (dim, key) in dims.items():
        flag = f"__in_{target}"
        known = dim.select(F.col(key).alias("__k_" + target)).distinct().withColumn(flag, F.lit(True))
        used = used.join(known, F.col("chave") == F.col("__k_" + target), "left")
        missing.append(F.when(F.col(flag).isNull(), F.lit(target)))
    targets = F.explode(F.array_compact(F.array(*missing))).alias("alvo")
    return used.select(targets, "coluna", "chave", "linhas")


def duplicate_keys(
    lookup: DataFrame, key: str, fact: DataFrame | None = None, fact_key: str | None = None
) -> DataFrame:
    """Lookup keys with more than one row and, given a fact, how many of its rows each would repeat."""
    repeated = (
        lookup.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("chave"))
        .agg(measures.rows().alias("linhas_cadastro"))
        .where(F.col("linhas_cadastro") > 1)
    )
    if fact is None:
        return repeated
    touched = fact.groupBy(F.col(fact_key or key).alias("__key")).agg(measures.rows().alias("__n"))
    return repeated.join(touched, F.col("chave") == F.col("__key"), "left").select(
        "chave", "linhas_cadastro", F.coalesce("__n", F.lit(0)).alias("linhas_fato")
    )
