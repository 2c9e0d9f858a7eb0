"""Checks, rates and filters on streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recspark.operators.flatten import flatten_documents, with_value_columns
from recspark.streaming.sinks import batch_path, run_to_end, write_batch


def stream_validate(
    changes: DataFrame, rules: Callable[[DataFrame], DataFrame], key: Sequence[str], ok: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """Rows without violation go to the folder ``ok``, violations to ``rejects``; then stop.

    ``rules`` maps a frame to violations that carry ``key``; it may join static frames.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(rules(batch), rejects, batch_id)
        violations = batch.sparkSession.read.parquet(batch_path(rejects, batch_id))  # the rules run once
        write_batch(batch.join(violations.select(*key).distinct(), list(key), "left_anti"), ok, batch_id)

    return run_to_end(changes, each, checkpoint)


def stream_commit_rate(
    audit: DataFrame, size: str | None = None, slide: str | None = None, gap: str | None = None, delay: str = "1 hour",
    time: str = "time_committed", keys: Sequence[str] = ("change_type",),
) -> DataFrame:
    """Commits per change type and time window: tumbling ``size``, sliding ``size``/``slide``, or sessions by ``gap``.

    Works on batch frames too; rows later than ``delay`` are dropped by a stream.
    """
    if (size is None) == (gap is None):
        raise ValueError("give either a window size or a session gap")
    at = F.session_window(time, gap) if gap else F.window(time, size, slide or size)
    name = "session_window" if gap else "window"
    counts = audit.withWatermark(time, delay).groupBy(at, *keys).agg(F.count(F.lit(1)).alias("commits"))
    return counts.select(F.col(f"{name}.start").alias("start"), F.col(f"{name}.end").alias("end"), *keys, "commits")


def stream_closed_windows(audit: DataFrame, out: str, checkpoint: str, **window) -> StreamingQuery:
    """Write every window of ``stream_commit_rate`` once, when the watermark has passed its end; then stop.

    A window that is written leaves the state, so the state holds the windows of the last ``delay`` only. Windows that
    are still open stay in the state for a later call.
    """
    return run_to_end(stream_commit_rate(audit, **window), lambda batch, i: write_batch(batch, out, i), checkpoint)


def stream_contains(
    docs: DataFrame, id_col: str, doc_col: str, pattern: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, max_depth: int | None = None
) -> StreamingQuery:
    """Keep arriving documents that satisfy a containment pattern; they go to the folder ``out``.

    ``pattern`` maps the node rows of a micro-batch to rows that carry ``id_col``.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        # a few files would be flattened by as many tasks; the pattern's frames and the result share the shuffle
        cores = batch.sparkSession.sparkContext.defaultParallelism
        docs = batch.repartition(cores) if batch.rdd.getNumPartitions() < cores else batch
        nodes = with_value_columns(flatten_documents(docs, id_col, doc_col, max_depth))
        hits = pattern(nodes).select(id_col).distinct()
        write_batch(docs.join(hits, id_col, "left_semi"), out, batch_id)

    return run_to_end(docs, each, checkpoint)
