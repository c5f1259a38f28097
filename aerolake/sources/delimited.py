"""Delimited text with a preamble line, read by column name and without losing a row."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote as quote_uri
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aerolake.session import broadcast_bytes

# A character no file holds: as the quote it switches quoting off, as the separator it keeps a line whole.
NO_QUOTE = "\u0000"
NO_SEPARATOR = "\u0001"

PREAMBLE = r"^Atualizado em:"
HEADER_READERS = 16
TOP_BYTES = 1 << 14
LINE_END = re.compile(r"\r\n|\r|\n")
# A row of the table of files, beside its path.
ROW_BYTES = 64
# Layouts named in an error message.
SHOWN = 10
BOM = "\ufeff"


class MissingColumns(ValueError):
    """Source files lack columns the load is defined on."""


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str],
    sep: str = ";",
    quote: str | None = '"',
    escape: str | None = None,
    encoding: str = "UTF-8",
    preamble: str = PREAMBLE,
    file_column: str | None = None,
) -> DataFrame:
    """Land ``columns`` (source name -> target name) as text, whatever order each file has them in.

    Rows are never dropped: short rows are padded with NULL, surplus fields are cut, and a data row
    that repeats the header text stays. The paths are scanned once, as given, by position; where files
    have several layouts each row meets its file's layout in a small table.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    tops, layouts, few = _layouts(spark, listed, columns, sep, quote, encoding, preamble)
    options = {
        "sep": sep,
        "quote": NO_QUOTE if quote is None else quote,
        "encoding": encoding,
        "mode": "PERMISSIVE",
        "header": "true",  # the reader skips the first line of each file: preamble or header
        **({"escape": escape} if escape is not None else {}),
    }
    positions = [f"_{i}" for i in range(max((len(header) for header, _ in layouts), default=0))]
    schema = StructType([StructField(p, StringType()) for p in positions])
    rows = spark.read.schema(schema).options(**options).csv(listed)
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    if any(has_preamble for _, has_preamble in layouts):
        # Only a number for each row goes through Python: the file's, in its first block.
        in_first = F.when(F.col("_metadata.file_block_start") == 0, F.xxhash64(path))
        rows = rows.select("*", path.alias(PATH), name.alias(NAME), _opens_file(in_first).alias(FIRST))
    else:
        rows = rows.select("*", path.alias(PATH), name.alias(NAME), F.lit(False).alias(FIRST))
    if len(layouts) > 1:
        of_file = tops.select(F.col("uri").alias(PATH), F.col("layout").alias(LAYOUT))
        rows = rows.join(F.broadcast(of_file) if few else of_file, PATH, "left")
        unknown = F.raise_error(F.concat(F.lit("file came after its layout was read: "), PATH)).cast("int")
        rows = rows.withColumn(LAYOUT, F.coalesce(LAYOUT, unknown))
    else:
        rows = rows.withColumn(LAYOUT, F.lit(0))
    return _of_layouts(rows, layouts, columns, file_column)


# Helper columns beside the fields; no source column can have such names, fields go by position.
PATH, NAME, FIRST, LAYOUT = "__path", "__name", "__first", "__layout"


def _of_layouts(
    rows: DataFrame, layouts: Sequence[tuple[tuple[str, ...], bool]], columns: Mapping[str, str], file_column: str | None
) -> DataFrame:
    """The wanted columns of each row, by its file's layout, without the headers that follow a preamble."""

    def by_layout(answers: Sequence[Column]) -> Column:
        if len(answers) == 1:
            return answers[0]
        chosen = F.when(F.col(LAYOUT) == 0, answers[0])
        for number, answer in enumerate(answers[1:], 1):
            chosen = chosen.when(F.col(LAYOUT) == number, answer)
        return chosen

    def is_header(header: Sequence[str], has_preamble: bool) -> Column:
        if not has_preamble:
            return F.lit(False)
        named = [F.col(f"_{header.index(s)}").eqNullSafe(F.lit(s)) for s in columns]
        return F.col(FIRST) & reduce(Column.__and__, named)

    kept = rows.where(~by_layout([is_header(*layout) for layout in layouts]))
    taken = [by_layout([F.col(f"_{header.index(s)}") for header, _ in layouts]).alias(t) for s, t in columns.items()]
    return kept.select(*taken, *([F.col(NAME).alias(file_column)] if file_column else []))


def _opens_file(file: Column) -> Column:
    """Whether a row is the first of its file, by the file's number (NULL beyond the first block).

    A task reads the rows of a block in their order, one block after the other, so a new number opens a
    file. Filters must not pass below this, or another row would seem the first: hence nondeterministic.
    """

    @F.arrow_udf("boolean")
    def opens(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last = None
        for part in parts:
            numbers = part.to_numpy(zero_copy_only=False)
            known = part.is_valid().to_numpy(zero_copy_only=False)
            before = np.append(np.nan if last is None else last, numbers[:-1]) if len(numbers) else numbers
            yield pa.array(known & ~(numbers == before))
            last = numbers[-1] if len(numbers) else last

    # A double tells 2^53 numbers apart and has a value for none.
    return opens.asNondeterministic()(F.pmod(file, F.lit(1 << 53)).cast("double"))


def _layouts(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Mapping[str, str],
    sep: str,
    quote: str | None,
    encoding: str,
    preamble: str,
) -> tuple[DataFrame, list[tuple[tuple[str, ...], bool]], bool]:
    """The files (uri, layout), the layouts (header fields, has a preamble), and whether the files are few enough
    for a broadcast; fails on any missing column.

    The first lines are read inside tasks over the file listing, a few kilobytes of each file, once, and
    grouped there: only the distinct layouts reach the driver, not the files.
    """

    def layout(lines: Sequence[str]) -> tuple[list[str], bool]:
        has_preamble = bool(lines) and re.search(preamble, lines[0].lstrip(BOM)) is not None
        rest = lines[1:] if has_preamble else lines
        return list(_fields(rest[0].lstrip(BOM), sep, quote)) if rest else [], has_preamble

    def read_tops(batches):
        for batch in batches:
            found = [layout(_top_lines(path, encoding)) for path in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([header for header, _ in found], pa.list_(pa.string())),
                    pa.array([has for _, has in found], pa.bool_()),
                ],
                names=["uri", "header", "has_preamble"],
            )

    listing = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("uri"), "path")
    schema = "uri string, header array<string>, has_preamble boolean"
    first = listing.first()
    if first is not None and _store_of(first["path"]) is None:
        # A store that only Spark can read: two lines of each file by a job of its own.
        found = [(uri, *layout(lines)) for uri, lines in _lines_by_jobs(spark, listing, encoding)]
        tops = spark.createDataFrame(found, schema)
    else:
        # The listing itself is small, so its rows are spread before the files are opened.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tops = listing.repartition(tasks, "path").mapInArrow(read_tops, schema).persist()
    wanted = F.array(*[F.lit(name) for name in columns])
    by_layout = tops.groupBy("header", "has_preamble").agg(
        F.count("*").alias("files"), F.min("uri").alias("example"), F.sum(F.octet_length("uri") + ROW_BYTES).alias("size")
    )
    layouts = by_layout.withColumn("missing", F.array_except(wanted, "header")).orderBy("header", "has_preamble").collect()
    bad = [row for row in layouts if row["missing"]]
    if bad:
        listed = "; ".join(f"{unquote(r['example'])} ({r['files']} files): {r['missing']}" for r in bad[:SHOWN])
        total = sum(r["files"] for r in bad)
        raise MissingColumns(f"expected columns not found in {total} files, such as {listed}")
    known = [(tuple(row["header"]), row["has_preamble"]) for row in layouts]
    numbers = [
        F.when((F.col("header") == F.array(*map(F.lit, header))) & (F.col("has_preamble") == has), number)
        for number, (header, has) in enumerate(known)
    ]
    few = sum(row["size"] for row in layouts) <= broadcast_bytes(spark)
    return tops.select("uri", F.coalesce(*numbers, F.lit(None).cast("int")).alias("layout")), known, few


def _store_of(path: str) -> tuple[FileSystem, str] | None:
    """The file system of a listed path and the path in it; None where only Spark knows the store."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return FileSystem.from_uri(f"{scheme}:{quote_uri(rest)}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _top_lines(path: str, encoding: str) -> list[str]:
    """The first two lines with text, which are the ones that Spark's reader counts."""
    store, place = _store_of(path)
    held = b""
    with store.open_input_stream(place) as file:
        while True:
            more = file.read(TOP_BYTES)
            held += more
            lines = [x for x in LINE_END.split(held.decode(encoding, "replace")) if x.strip()]
            if not more or len(lines) > 2:  # a third line has begun, so the second is whole
                return lines[:2]


def _lines_by_jobs(spark: SparkSession, listing: DataFrame, encoding: str) -> list[tuple[str, list[str]]]:
    def lines(path: str) -> list[str]:
        reader = spark.read.schema("line string")
        top = reader.options(sep=NO_SEPARATOR, quote=NO_QUOTE, encoding=encoding).csv(_literal(path)).take(2)
        return [r["line"] for r in top]

    files = listing.orderBy("uri").collect()
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        return list(zip([f["uri"] for f in files], readers.map(lambda f: lines(f["path"]), files)))


def _literal(path: str) -> str:
    """The path with its glob characters escaped, so that it names one file."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _fields(line: str, sep: str, quote: str | None) -> tuple[str, ...]:
    if quote is None:
        return tuple(line.split(sep))
    return tuple(next(csv.reader([line], delimiter=sep, quotechar=quote)))


def parse_delimited(
    df: DataFrame,
    text_col: str,
    columns: Sequence[str],
    sep: str = ";",
    quote: str | None = '"',
    escape: str | None = None,
) -> DataFrame:
    """Split a text column into text fields under the same rules as a file scan."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {
        "sep": sep,
        "quote": NO_QUOTE if quote is None else quote,
        "mode": "PERMISSIVE",
        **({"escape": escape} if escape is not None else {}),
    }
    parsed = df.withColumn("__fields", F.from_csv(F.col(text_col), schema, options))
    kept = [c for c in df.columns if c != text_col]
    return parsed.select(*kept, *[F.col("__fields")[c].alias(c) for c in columns])
