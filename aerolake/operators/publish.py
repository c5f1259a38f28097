"""Writing tables: full refresh, kept loads, comments that travel with the schema, logs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolake.operators.governance import LOADS, edge_rows
from aerolake.sources.seed import seed_table

VERSION = "_versao"
# Between a table's name and the mark of one refresh, in names of folders and of tables in transit.
REFRESH = "__carga_"
# Whether the catalog keeps a list of a table's partitions; without one they are read off its folder.
LISTS_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


class KeptLoads(ValueError):
    """A plain refresh would erase the loads that a table keeps."""


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions as metadata; they survive every overwrite of the table."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )


def publish(
    df: DataFrame,
    target: str,
    comments: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    version: int | None = None,
    clustered: bool = False,
    log: str | None = None,
) -> int:
    """Replace ``target`` (a ``schema.table`` name, or a path) and return the rows it then holds.

    The rows are written to a folder of their own and the target is pointed there only when all of them
    are there, so a refresh that fails leaves the old ones as they were. Where columns and partitions stay
    the same that is one change in the catalog: a reader sees the old rows or the new ones. Where they
    change, a table made beside it takes over its name. The folder before the last is kept for queries
    that still read it, until the next refresh. Tables hold their files by location, so dropping one leaves
    them to its next refresh. Rows are counted by the write itself.

    partition_by  writes directories a later filter prunes. The rows are rebalanced by these columns
                  first: adaptive execution merges small partitions into one file and splits the one
                  that holds a third of the table, so files come out near the advisory size.
    clustered     the rows already come in the order of these directories (a row-by-row result of a
                  table stored the same way), so the shuffle is left out.
    version       keeps earlier loads: only this version's rows are replaced, so a retried load
                  leaves no copies. Columns that the table lacks are added, NULL in older loads;
                  columns that the load lacks are NULL in it. A later publish without a version is
                  an error. Read the history with load_ledger and snapshot_compare.
    log           table to which (table, version, time, operation, rows) of this write is appended
    """
    spark = df.sparkSession
    described = with_comments(df, comments or {})
    existed = _exists(spark, target)
    held = existed and VERSION in stored(spark, target).columns
    if held and version is None:
        raise KeptLoads(f"{target} keeps loads by version; publish with a version or drop it first")
    directories = list(partition_by)
    if version is not None:
        described = described.withColumn(VERSION, F.lit(version))
        directories = [VERSION, *directories]
    if partition_by and not clustered:
        described = described.hint("rebalance", *partition_by)
    # Above the shuffle, in the stage that writes: a task done again there is counted once.
    written = Observation()
    described = described.observe(written, F.count(F.lit(1)).alias("rows"))
    if held:
        _add_load(described, target, directories)
    elif _is_path(target):
        _refresh_path(described, target, directories)
    else:
        _refresh_table(described, target, directories)
    rows = written.get["rows"]
    if log is not None:
        operation = "load" if version is not None else "refresh" if existed else "create"
        log_load(spark, log, target, version, operation, rows)
    return rows


def stored(spark: SparkSession, target: str) -> DataFrame:
    """A published table or path; the files of a path may have grown columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(target) if _is_path(target) else spark.table(target)


def _is_path(target: str) -> bool:
    return "/" in target


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    store, where = _hadoop(spark, target)
    return store.exists(where)


def _location(spark: SparkSession, what: str) -> str:
    rows = spark.sql(f"DESCRIBE {what}").collect()
    return next(row[1] for row in rows if row[0] == "Location")


def _refresh_table(df: DataFrame, target: str, directories: Sequence[str]) -> None:
    """Write a new folder, then point the table there; only the catalog changes, no file moves."""
    spark = df.sparkSession
    schema, _, name = target.rpartition(".")
    schema = schema or spark.catalog.currentDatabase()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    beside, mark = _location(spark, f"SCHEMA {schema}").rstrip("/"), uuid.uuid4().hex
    folder = f"{beside}/{name}{REFRESH}{mark}"
    df.write.partitionBy(*directories).parquet(folder)

    before = None
    if spark.catalog.tableExists(target):
        before = _location(spark, f"TABLE EXTENDED {target}")
    if before is not None and _same_shape(df, target, directories):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
    else:
        _create(spark, coming := f"{schema}.{name}{REFRESH}{mark}", df.schema, directories, folder)
        if before is not None:
            spark.sql(f"ALTER TABLE {target} RENAME TO {schema}.{name}{REFRESH}{mark}_antes")
        spark.sql(f"ALTER TABLE {coming} RENAME TO {target}")
        if before is not None:
            spark.sql(f"DROP TABLE {schema}.{name}{REFRESH}{mark}_antes")
    spark.catalog.refreshTable(target)
    _drop_folders(spark, f"{beside}/{name}{REFRESH}*", keep=(folder, before))


def _same_shape(df: DataFrame, target: str, directories: Sequence[str]) -> bool:
    """Whether a table has these columns, comments and partitions, and reads its partitions off its folder."""
    spark = df.sparkSession
    described = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()]
    names = [name for name, _ in described]
    parts = names[names.index("# col_name") + 1 : names.index("# Detailed Table Information")] if "# col_name" in names else []
    columns = [f for f in df.schema if f.name not in directories] + [df.schema[d] for d in directories]
    known = spark.table(target).schema
    same = [(f.name, f.dataType, f.metadata) for f in known] == [(f.name, f.dataType, f.metadata) for f in columns]
    return same and [p for p in parts if p] == list(directories) and ("Partition Provider", "Catalog") not in described


def _create(spark: SparkSession, table: str, schema: StructType, directories: Sequence[str], folder: str) -> None:
    """A table over a folder of files."""

    def told(comment: str) -> str:
        return comment.replace("\\", "\\\\").replace("'", "\\'")

    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{told(f.metadata['comment'])}'" if "comment" in f.metadata else "")
        for f in schema
    )
    by = f" PARTITIONED BY ({', '.join(f'`{d}`' for d in directories)})" if directories else ""
    with _set(spark, LISTS_PARTITIONS, "false"):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{by} LOCATION '{folder}'")


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that a command takes from the session only, for that command."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drop_folders(spark: SparkSession, pattern: str, keep: Sequence[str | None]) -> None:
    store, where = _hadoop(spark, pattern)
    kept = {store.makeQualified(_hadoop(spark, k)[1]).toString() for k in keep if k}
    for found in store.globStatus(where) or ():
        if found.getPath().toString() not in kept:
            store.delete(found.getPath(), True)


def _refresh_path(df: DataFrame, target: str, directories: Sequence[str]) -> None:
    """Write a new folder beside the path, then let it take over the path's name."""
    spark = df.sparkSession
    target = target.rstrip("/")
    mark = uuid.uuid4().hex
    coming, leaving = f"{target}{REFRESH}{mark}", f"{target}{REFRESH}{mark}_antes"
    df.write.partitionBy(*directories).parquet(coming)
    store, place = _hadoop(spark, target)
    if store.exists(place) and not store.rename(place, _hadoop(spark, leaving)[1]):
        raise OSError(f"could not set {target} aside")
    if not store.rename(_hadoop(spark, coming)[1], place):
        store.rename(_hadoop(spark, leaving)[1], place)
        raise OSError(f"could not put {coming} in place")
    _drop_folders(spark, f"{target}{REFRESH}*", keep=())


def _add_load(df: DataFrame, target: str, directories: Sequence[str]) -> None:
    """Replace one version's rows; the other versions' files are not touched, the schema only grows."""
    spark = df.sparkSession
    if _is_path(target):
        writer = df.write.mode("overwrite").format("parquet").partitionBy(*directories)
        writer.option("partitionOverwriteMode", "dynamic").save(target)
        return
    known = spark.table(target).schema
    added = [f for f in df.schema.fields if f.name not in known.names]
    if added:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({listed})")
    # insertInto goes by position, and the stored table has its directory columns last.
    wanted = spark.table(target).schema.fields
    ordered = df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )
    with _set(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.write.insertInto(target, overwrite=True)


def _append(rows: DataFrame, table: str) -> None:
    schema, _, _ = table.rpartition(".")
    if schema:
        rows.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    rows.write.mode("append").format("parquet").saveAsTable(table)


def log_load(
    spark: SparkSession, log: str, target: str, version: int | None, operation: str, rows: int
) -> None:
    """Append one write to the load log."""
    entry = seed_table(spark, [(target, version, operation, rows)], LOADS)
    _append(entry.withColumn("instante", F.current_timestamp()), log)


def log_edges(
    spark: SparkSession, target: str, sources: Sequence[str], log: str, run_date: dt.date
) -> None:
    """Append the lineage edges of one write to the log table; repeats collapse in the report."""
    _append(edge_rows(spark, target, sources, run_date), log)
