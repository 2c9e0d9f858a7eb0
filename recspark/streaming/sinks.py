"""Exactly-once folders for micro-batches, and running a stream over all data that is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch; a retried batch overwrites its own folder, so rows never double."""
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def complete_batches(spark: SparkSession, path: str, name: str = "batch") -> list[int]:
    """Numbers of the finished sub-folders of ``path`` (a name listing, no data is read)."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in (found or []))


def child_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the sub-folders ``name=N`` of ``path``."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getName().split("=")[1]) for s in (found or []))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a state that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, after: int = -1
) -> DataFrame:
    """Rows of the finished batches between ``after`` and ``before`` (both exclusive)."""
    ids = [b for b in complete_batches(spark, path) if b > after and (before is None or b < before)]
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[batch_path(path, b) for b in ids])


def read_last_batch(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished batch, for sinks that hold the whole result in every batch."""
    return spark.read.parquet(batch_path(path, complete_batches(spark, path)[-1]))


def run_to_end(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything that has arrived, then stop; a later call goes on from the checkpoint."""
    query = (
        stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
