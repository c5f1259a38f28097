"""What the corpus operators share: shared folders, Arrow passes over texts, tables by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import keep, shared_folder

__all__ = [
    "by_block", "first_in_order", "in_order", "keep", "per_text", "read", "shared_folder", "slices", "text_or_empty", "unused",
]

# Texts handed to a Python step at a time; keeps a step's memory flat whatever an Arrow batch holds.
BLOCK_BYTES = 8 << 20
TEXTS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def in_order(key: Column) -> Column:
    """A fixed pseudo-random order of rows, for bounded samples that are the same on every run."""
    return F.xxhash64(key.cast("string"), F.lit("order"))


def first_in_order(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows, the first by ``in_order`` of a key.

    A bound on the hash drops most rows where they lie, so tasks send about ``2 * most`` rows to the last sort
    together, not ``most`` each. Where keys repeat so much that the bound leaves too few, all rows are sorted.
    """
    total = rows.count()
    if total > 4 * most:
        bound = -(1 << 63) + int((1 << 64) * (2 * most + 1000) / total)
        below = rows.where(in_order(key) <= F.lit(min(bound, (1 << 63) - 1)))
        if below.count() >= most:
            rows = below
    return rows.orderBy(in_order(key), key).limit(most)


def unused(columns: Iterable[str], name: str) -> str:
    """The name, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, sizes: Iterable[int], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose sizes add up to ``most`` at most, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def per_text(make: Callable[[], Callable[[str], list[float]]], text: Column) -> Column:
    """An array of doubles for each text, by a reader that every task makes for itself.

    Texts become Python strings a few at a time, whatever an Arrow batch holds.
    """

    @F.arrow_udf("array<double>")
    def read(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = make()
        for part in parts:
            rows = []
            for at in range(0, len(part), TEXTS):
                rows += map(reader, part.slice(at, TEXTS).to_pylist())
            yield pa.array(rows, pa.list_(pa.float64()))

    return read(F.coalesce(text, F.lit("")))


def by_block(
    column: str, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], size: int = BLOCK_BYTES
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that applies ``step`` to bounded blocks of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
            for block in slices(batch, lengths, size):
                made = step(block)
                if made is not None and made.num_rows:
                    yield made

    return run
