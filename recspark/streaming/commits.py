"""Commits arriving as a stream.

The state is a folder of accepted versions, one sub-folder per micro-batch, and the latest version per object (slim
rows, no payload) in buckets of objects. A micro-batch reads the buckets that its objects lie in and writes those
anew; all others stay as they are. It is applied with the same joins and aggregations as a batch of commits, so an
object with very many changes does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recspark.operators.commits import chain_commits
from recspark.operators.versions import latest_version
from recspark.streaming.sinks import child_numbers, complete_batches, read_batches, remove_folder, run_to_end, write_batch

LATEST_COLUMNS = ["vo_id", "ehr_id", "sys_version", "sys_period_lower", "sys_deleted"]


def _accepted_schema(changes: T.StructType) -> T.StructType:
    time = changes["committed_at"].dataType
    return T.StructType(
        [
            *changes.fields,
            T.StructField("sys_version", T.IntegerType()),
            T.StructField("sys_period_lower", time),
            T.StructField("sys_period_upper", time),
            T.StructField("sys_deleted", T.BooleanType()),
        ]
    )


def _latest_schema(accepted: T.StructType) -> T.StructType:
    return T.StructType([accepted[c] for c in LATEST_COLUMNS])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("vo_id"), F.lit(buckets)).cast("int")


def _generations(spark: SparkSession, state_path: str, bucket: int, before: int) -> list[int]:
    """Batches before ``before`` that wrote this bucket, oldest first (names of folders only)."""
    return [b for b in child_numbers(spark, f"{state_path}/latest/bucket={bucket}", "upto") if b < before]


def read_latest(spark: SparkSession, state_path: str, schema: T.StructType, buckets: Sequence[int], batch_id: int) -> DataFrame:
    """Latest version per object of some buckets before a batch: the newest files of each bucket, nothing else."""
    paths = []
    for bucket in buckets:
        known = _generations(spark, state_path, bucket, batch_id)
        if known:
            paths.append(f"{state_path}/latest/bucket={bucket}/upto={known[-1]}")
    if not paths:
        return spark.createDataFrame([], _latest_schema(schema))
    return spark.read.schema(_latest_schema(schema)).parquet(*paths)


def _apply(batch: DataFrame, batch_id: int, state_path: str, buckets: int, max_delay: str | None) -> None:
    spark = batch.sparkSession
    schema = _accepted_schema(batch.schema)
    rejects = None
    if max_delay is not None:
        # too late: older than the newest commit of earlier batches by more than the delay
        kind = batch.schema["committed_at"].dataType
        times = T.StructType([T.StructField("newest", kind)])
        earlier = [b for b in complete_batches(spark, f"{state_path}/times") if b < batch_id]
        limit = read_batches(spark, f"{state_path}/times", times, batch_id, earlier[-1] - 1).first()["newest"] if earlier else None
        newest = batch.agg(F.max("committed_at").alias("newest"))
        if limit is not None:
            known = F.lit(limit).cast(kind)
            late = F.col("committed_at") < known - F.expr(f"INTERVAL {max_delay}")
            newest = newest.select(F.greatest("newest", known).alias("newest"))
            rejects = batch.filter(late).withColumn("reason", F.lit("too late"))
            batch = batch.filter(F.coalesce(~late, F.lit(True)))
        write_batch(newest, f"{state_path}/times", batch_id)
    touched = sorted(r["b"] for r in batch.select(_bucket(buckets).alias("b")).distinct().collect())  # at most ``buckets`` numbers
    known = read_latest(spark, state_path, schema, touched, batch_id)
    accepted, refused = chain_commits(known.join(batch.select("vo_id").distinct(), "vo_id", "left_semi"), batch)
    write_batch(accepted.select(*schema.fieldNames()), f"{state_path}/versions", batch_id)
    write_batch(refused if rejects is None else refused.unionByName(rejects), f"{state_path}/rejects", batch_id)
    new = read_batches(spark, f"{state_path}/versions", schema, batch_id + 1, batch_id - 1).select(*LATEST_COLUMNS)
    latest = latest_version(known.unionByName(new)).select(*LATEST_COLUMNS, _bucket(buckets).alias("bucket"), F.lit(batch_id).alias("upto"))
    # a retried batch replaces its own generation of a bucket; the generations before stay readable until the next one
    latest.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "upto").parquet(f"{state_path}/latest")
    for bucket in touched:
        for old in _generations(spark, state_path, bucket, batch_id)[:-1]:
            remove_folder(spark, f"{state_path}/latest/bucket={bucket}/upto={old}")


def stream_apply_commits(
    changes: DataFrame, state_path: str, buckets: int = 64, max_delay: str | None = None
) -> StreamingQuery:
    """Apply a stream of changes to the versioned table at ``state_path``, then stop.

    ``buckets`` must stay the same for a table; a micro-batch costs what its buckets hold. A commit older than its object's newest version starts 1 microsecond after it; one older than the newest
    commit of the earlier micro-batches by more than ``max_delay`` (e.g. ``'2 DAYS'``) is refused.
    """
    return run_to_end(
        changes, lambda batch, i: _apply(batch, i, state_path, buckets, max_delay), f"{state_path}/checkpoint"
    )


def read_versions(spark: SparkSession, state_path: str, changes: T.StructType) -> DataFrame:
    """All versions with their validity; the end of a batch's last version is the start of the next batch's first."""
    rows = read_batches(spark, f"{state_path}/versions", _accepted_schema(changes)).drop("sys_period_upper")
    after = rows.select("vo_id", (F.col("sys_version") - 1).alias("sys_version"), F.col("sys_period_lower").alias("sys_period_upper"))
    rows = rows.join(after, ["vo_id", "sys_version"], "left")
    return rows.withColumn("is_head", F.col("sys_period_upper").isNull() & ~F.col("sys_deleted"))


def read_rejects(spark: SparkSession, state_path: str, changes: T.StructType) -> DataFrame:
    schema = T.StructType([*changes.fields, T.StructField("reason", T.StringType())])
    return read_batches(spark, f"{state_path}/rejects", schema)


def stream_dedup(changes: DataFrame, delay: str, time: str = "committed_at", key: str = "contribution_id") -> DataFrame:
    """A contribution id passes once; repeats within ``delay`` of event time are dropped."""
    return changes.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
