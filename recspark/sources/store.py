"""Node tables on disk, sorted by object and number.

``write_nodes`` writes plain Parquet folders by hash bucket, readable by anything. ``save_nodes_table`` writes a
bucketed table: joins of its node frames by object need no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64
_PART_BITS = 20  # an object beyond a million nodes is written by several tasks


def bucket_of(*key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _arranged(nodes: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows sorted by (bucket, key, num), whole objects in one task; a shuffle only if they do not lie by object already.

    A window asks for rows of one group in one task, which rows that lie by object fulfil, while ``repartition`` would
    move them all once more. Its own sort is the one the files need. Objects that are moved and very large are split.
    """
    rows = nodes.withColumns({"bucket": bucket_of(*[F.col(k) for k in key], buckets=buckets), "_part": F.shiftright("num", _PART_BITS)})
    numbered = F.row_number().over(Window.partitionBy("bucket", *key, "_part").orderBy("num"))
    rows = rows.withColumn("_row", numbered).filter("_row > 0")  # always: without a use the window would be left out
    return rows.sortWithinPartitions("bucket", *key, "_part", "num").drop("_part", "_row")


def write_nodes(
    nodes: DataFrame, path: str, key: Sequence[str] = ("vo_id",), buckets: int = BUCKETS, mode: str = "overwrite"
) -> None:
    """Write node rows of many objects in one job.

    A task writes whole objects, and one file for each bucket that they lie in; nodes that already lie by object are not
    shuffled for it, others are, by bucket and object, very large objects over several tasks. Files are sorted by
    (key, num), so that footer statistics skip row groups of other objects.
    """
    _arranged(nodes, key, buckets).write.mode(mode).partitionBy("bucket").parquet(path)


def read_nodes(spark: SparkSession, path: str, key: Sequence[str] = ("vo_id",), ids: Sequence | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Read a node table; for given object ids only their buckets are opened."""
    nodes = spark.read.parquet(path)
    if ids is not None:
        (name,) = key
        kind = nodes.schema[name].dataType
        lits = [F.lit(i).cast(kind) for i in ids]
        nodes = nodes.filter(F.col(name).isin(lits) & F.col("bucket").isin([bucket_of(x, buckets=buckets) for x in lits]))
    return nodes.drop("bucket")


def save_nodes_table(nodes: DataFrame, table: str, path: str, key: Sequence[str] = ("vo_id",), buckets: int = BUCKETS) -> DataFrame:
    """Write a table bucketed by the object key and read it back.

    For tables whose objects are small (``objects_fit``): one bucket holds whole objects, and joins by object
    (``blocks=False``) run bucket by bucket.
    """
    name, *more = key
    rows = nodes.repartition(buckets, *key)
    writer = rows.write.mode("overwrite").bucketBy(buckets, name, *more).sortBy(name, *more, "num")
    writer.option("path", path).saveAsTable(table)
    return nodes.sparkSession.table(table)
