"""Session settings the operators rely on."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Times are wall-clock readings, so UTC keeps daylight-saving gaps from shifting them.
# Lookup joins beyond the broadcast threshold lean on adaptive execution: a partition that one hot
# airline or airport fills is split at run time, also where the split costs a further exchange.
# HotSpot leaves methods above 8,000 bytes uncompiled; a stage that would need one runs operator by operator.
HUGE_METHOD = 8000
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": str(HUGE_METHOD),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Raw text is several times wider than its Parquet form once it is decoded into rows.
DECODED_WIDTH = 4
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built; they stay set.

    All of them are about how times, numbers and shuffles of a query are treated. Nothing that decides
    what a write replaces is among them.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "aerolake", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        # Call-site capture costs a stack walk per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin(spark)


def stored_bytes(spark: SparkSession, paths: str | Iterable[str], pattern: str = "*") -> int:
    """Bytes below the paths, from the file listing alone (no content is read)."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load([paths] if isinstance(paths, str) else list(paths))
    )
    return listing.agg(F.sum("length").alias("n")).first()["n"] or 0


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files below a query, as its optimised plan knows them; no job, no content."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]
    return sum(int(str(size)) for size in sizes)


def broadcastable(df: DataFrame) -> bool:
    """Whether a side is small by measure: a literal list, or files below Catalyst's own threshold.

    Catalyst multiplies the sizes of joined tables, so a small registry that is itself a join looks
    large to it. A registry joined to smaller lists stays near the size of its files.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    if all(leaves.apply(i).nodeName() == "LocalRelation" for i in range(leaves.size())):
        return True
    return input_bytes(df) * DECODED_WIDTH <= broadcast_bytes(df.sparkSession)


def broadcast_bytes(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def small(df: DataFrame) -> DataFrame:
    """The frame, hinted for a broadcast if it is small by measure."""
    return F.broadcast(df) if broadcastable(df) else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; on a cluster that is an error, since
    executors do not see one another's disks.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def keep(df: DataFrame) -> DataFrame:
    """The rows, computed once and stored in the shared folder; a lost executor loses none of them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_small(df: DataFrame) -> DataFrame:
    """The rows stored, and hinted for a broadcast if what was stored is below Catalyst's threshold."""
    stored = keep(df)
    width = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    held = stored.agg(F.sum(reduce(Column.__add__, width))).first()[0] or 0
    return F.broadcast(stored) if held <= broadcast_bytes(df.sparkSession) else stored


def partitions_for(stored: int, at_least: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
    """Shuffle partitions that keep one partition near ``partition_bytes`` of decoded rows.

    No upper bound: on a cluster with large executors, larger partitions keep the number down.
    """
    return max(at_least, math.ceil(stored * DECODED_WIDTH / partition_bytes))


def size_shuffles(
    spark: SparkSession, stored: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES
) -> int:
    """Raise the initial shuffle width to fit the input; adaptive execution merges what is too small."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = partitions_for(stored, floor, partition_bytes)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted
