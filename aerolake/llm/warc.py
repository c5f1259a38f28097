"""WARC fixity audit: Merkle trees over records and ordered offset ranges, and a descent to the damage.

Records lie in archive order and have positions from 0. A leaf is a record's SHA-256 and length; a node
of level ``l`` covers ``FANOUT ** l`` consecutive positions, its digest is taken over its children's
places and digests, its length is their sum. Two replicas are compared from the top level down; only
children of differing nodes are looked at, and a child's byte offset is its parent's plus the lengths
of the siblings before it. So the work after hashing follows the damage, not the archive.

Above ``FANOUT ** HEIGHT`` records the top level has several roots, each compared on its own. Equal
records (same key and content) are one leaf with a number of copies. Null keys, urls and payloads count
as empty text and sort first. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm import common

FANOUT = 64
HEIGHT = 4
END = "\r\n\r\n"


def record(key: Column, url: Column, payload: Column) -> Column:
    """A response record as text, without the two line ends that close it in a file."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(key.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
    )
    return F.concat(head, F.lit(END), body)


def write(records: DataFrame, path: str) -> None:
    """WARC files of a frame's ``record`` column, one for each partition."""
    records.select("record").write.option("lineSep", END).text(path)


def digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


# --- archive order ---------------------------------------------------------------------------


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with their number from 0 in the order of the named columns, nulls first.

    Range partitions are sorted and stored; the number of rows in each is all that the driver sees.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = common.keep(rows.repartitionByRange(width, *order).sortWithinPartitions(*order))
    placed = placed.withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    counts = dict(placed.groupBy("_part").count().collect())
    starts, total = [], 0
    for part in sorted(counts):
        starts.append((part, total))
        total += counts[part]
    # One row for each partition.
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part int, _start long"))
    return placed.join(first, "_part").withColumn("position", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


# --- trees -----------------------------------------------------------------------------------


def trees(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> list[DataFrame]:
    """Levels 0 to ``height`` of (replica, node, digest, length), from (replica, position, digest, length)."""
    levels = [leaves.select("replica", F.col("position").alias("node"), "digest", "length")]
    for _ in range(height):
        child = F.struct((F.col("node") % fanout).alias("place"), "digest")
        listed = F.transform(
            F.array_sort(F.collect_list(child)), lambda c: F.concat(c["place"].cast("string"), F.lit(":"), c["digest"])
        )
        up = levels[-1].groupBy("replica", F.expr(f"node div {fanout}").alias("node"))
        made = up.agg(digest(F.array_join(listed, ",")).alias("digest"), F.sum("length").alias("length"))
        levels.append(common.keep(made))
    return levels


def _sides(level: DataFrame, first: str, second: str) -> DataFrame:
    """One row for each node with both replicas' digest and length."""

    def of(replica: str, column: str) -> Column:
        return F.max(F.when(F.col("replica") == replica, F.col(column)))

    return level.groupBy("node").agg(
        of(first, "digest").alias("digest_a"),
        of(second, "digest").alias("digest_b"),
        F.coalesce(of(first, "length"), F.lit(0).cast("long")).alias("length_a"),
        F.coalesce(of(second, "length"), F.lit(0).cast("long")).alias("length_b"),
    )


def audit(levels: list[DataFrame], first: str, second: str, fanout: int = FANOUT) -> DataFrame:
    """Differing nodes of every level: level, node, first position, offset in the first replica, lengths.

    ``damage`` is ``lost`` or ``extra`` for a record that one replica lacks, ``resized`` or ``altered``
    for one whose content differs, and ``branch`` above the records.
    """
    roots = _sides(levels[-1], first, second)
    ahead = Window.orderBy("node").rowsBetween(Window.unboundedPreceding, -1)  # one row in fanout ** height
    offset = F.coalesce(F.sum("length_a").over(ahead), F.lit(0).cast("long"))
    differing = ~F.col("digest_a").eqNullSafe(F.col("digest_b"))
    found = roots.withColumn("offset", offset).where(differing).withColumn("level", F.lit(len(levels) - 1))
    out = found
    for level in range(len(levels) - 2, -1, -1):
        parents = found.select(F.col("node").alias("parent"), F.col("offset").alias("start"))
        nodes = levels[level].withColumn("parent", F.expr(f"node div {fanout}"))
        # Both replicas' children of a differing node; at most 2 * fanout rows for each.
        met = nodes.join(parents, "parent")
        sides = _sides(met, first, second).withColumn("parent", F.expr(f"node div {fanout}")).join(parents, "parent")
        siblings = Window.partitionBy("parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.col("start") + F.coalesce(F.sum("length_a").over(siblings), F.lit(0).cast("long"))
        found = common.keep(
            sides.withColumn("offset", offset).where(differing).withColumn("level", F.lit(level)).select(*out.columns)
        )
        out = out.unionByName(found)
    damage = (
        F.when(F.col("level") > 0, "branch")
        .when(F.col("digest_b").isNull(), "lost")
        .when(F.col("digest_a").isNull(), "extra")
        .when(F.col("length_a") != F.col("length_b"), "resized")
        .otherwise("altered")
    )
    span = F.pow(F.lit(fanout), F.col("level")).cast("long")
    return out.select(
        "level", "node", (F.col("node") * span).alias("first_position"), "offset", "length_a", "length_b",
        "digest_a", "digest_b", damage.alias("damage"),
    )
