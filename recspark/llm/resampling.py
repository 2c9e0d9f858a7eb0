"""Importance resampling of documents towards a target distribution, ranked by parallel sorting by regular sampling."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.license_scan import words
from recspark.llm.shared import run_dir, written

BUCKETS = 10_000
WIDTH = 1  # words in the longest feature
PERCENT = 10  # of the eligible documents
MIN_WORDS = 20
SEED = 2024
MAX_RUNS = 1024  # sorted runs: their splitters are a bounded table
KNOWN = 1 << 20  # features whose bucket a task remembers


class _Buckets(dict):
    """Bucket of a feature; remembers a bounded number of them."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def _features(ws: list[bytes], width: int) -> list[bytes]:
    out = ws
    for n in range(2, width + 1):
        out = out + [b" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    return out


def bucket_counts(texts: DataFrame, text: str, width: int = WIDTH, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; a task hands on one number per bucket that it met."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for frame in frames:
            for t in frame["text"]:
                if t:
                    ids = [bucket[f] for f in _features(words(t), width)]
                    total += np.bincount(np.array(ids, np.int64), minlength=buckets)
        met = np.flatnonzero(total)
        if len(met):
            yield pd.DataFrame({"bucket": met.astype(np.int64), "n": total[met]})

    found = texts.select(F.col(text).alias("text")).mapInPandas(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and source shares, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _scored(gain: np.ndarray, width: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = _Buckets(len(gain))
        for frame in frames:
            n, total, n_words = (np.zeros(len(frame), np.int64) for _ in range(3))
            for i, t in enumerate(frame["text"]):
                if t:
                    ws = words(t)
                    ids = [bucket[f] for f in _features(ws, width)]
                    n_words[i], n[i] = len(ws), len(ids)
                    total[i] = gain[np.array(ids, np.int64)].sum()
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)})

    return work


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def document_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", width: int = WIDTH, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score (null without an id)."""
    gain = gains(bucket_counts(docs, text, width, buckets), bucket_counts(target, target_text, width, buckets))
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"))  # a text: pandas has no null among integers
    out = base.mapInPandas(_scored(gain, width), "doc_id string, n_words long, n_features long, weight long")
    out = out.withColumn("doc_id", F.col("doc_id").cast(kind))
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _segment(key: Column, splitters: list[Column]) -> Column:
    """Number of splitters that are not above the key: a binary search by halving steps."""
    if not splitters:
        return F.lit(0)
    held = F.array(*splitters)
    steps = [1 << k for k in reversed(range(len(splitters).bit_length()))]

    def step(low: Column, by: Column) -> Column:
        return F.when((low + by <= len(splitters)) & (F.get(held, low + by - 1) <= key), low + by).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def draw_ranks(rows: DataFrame, score: str, tie: str, percent: int, folder: str) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by descending score (ties: ascending ``tie``), null beyond ``percent`` of the rows.

    Each partition is sorted by itself and written as a run. Every run gives as many regular samples as there are runs,
    every so many-th sample is a splitter, and the segments between them hold at most about twice their share of the
    rows, whatever the distribution: rows that are equal in everything still differ by their number. Segments are
    counted before anything moves; those that the draw reaches are exchanged and merged, the rest stays where it is.
    """
    order = [F.col("_down"), F.col(tie), F.col("_row")]
    numbered = written(rows.withColumns({"_down": -F.col(score), "_row": F.monotonically_increasing_id()}), folder, "numbered")
    # joining partitions moves nothing
    runs = numbered.coalesce(MAX_RUNS).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    runs = runs.withColumns({"_run": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND((1 << 33) - 1)}).drop("_place")
    runs = written(runs, folder, "runs")
    sizes = {r["_run"]: r["n"] for r in runs.groupBy("_run").agg(F.count("*").alias("n")).collect()}  # at most MAX_RUNS rows
    total, p = sum(sizes.values()), len(sizes)
    quota = percent * total // 100
    if not quota:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    splitters = []
    if p > 1:
        step = F.broadcast(rows.sparkSession.createDataFrame([(r, -(-n // p)) for r, n in sizes.items()], "_run long, _step long"))
        key = F.struct("_down", F.col(tie).alias("_tie"), "_row")
        samples = runs.join(step, "_run").where(F.col("_at") % F.col("_step") == 0).select(key.alias("key"))
        samples = samples.agg(F.sort_array(F.collect_list("key")).alias("all"))  # at most MAX_RUNS squared
        every = F.transform(F.sequence(F.lit(p), F.size("all") - 1, F.lit(p)), lambda i: F.get("all", i))
        found = samples.where(F.size("all") > p).select(F.inline(every)).collect()
        kind = rows.schema[tie].dataType
        splitters = [F.struct(F.lit(r["_down"]).cast("long").alias("_down"), F.lit(r["_tie"]).cast(kind).alias("_tie"), F.lit(r["_row"]).cast("long").alias("_row")) for r in found]
    runs = runs.withColumn("_segment", _segment(F.struct("_down", F.col(tie).alias("_tie"), "_row"), splitters))
    counts = sorted(tuple(r) for r in runs.groupBy("_segment").agg(F.count("*")).collect())  # as many rows as splitters
    before, start = {}, 0
    for segment, n in counts:
        before[segment] = start
        start += n
    reached = {s: b for s, b in before.items() if b < quota}
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in reached.items() for x in pair]), F.col("_segment").cast("long"))
    inside = F.row_number().over(Window.partitionBy("_segment").orderBy(*order))
    last = max(reached)
    rank = F.col("_offset") + inside
    drawn = runs.where(F.col("_segment") <= last).withColumn("_offset", offset).withColumn("rank", rank)
    drawn = drawn.select(*rows.columns, F.when(F.col("rank") <= quota, F.col("rank")).cast("long").alias("rank"))
    return drawn.unionByName(runs.where(F.col("_segment") > last).select(*rows.columns, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", width: int = WIDTH,
    buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank; ``rank`` is null for rows that are not drawn.

    Features (runs of 1 to ``width`` words) are hashed into buckets, counted over all documents and over the target, and
    each bucket gets its gain; a row's weight is the floored mean of its features' gains (0 without features), its score
    the weight plus noise that is fixed by seed and id. Of the rows with an id and at least ``min_words`` words, the given
    percentage with the highest scores is drawn, ties going to the smaller id. Null texts have no features. Rows without
    an id count as text but have neither score nor rank. Repeated rows are rows of their own. An empty target leaves the
    smoothed share of the documents as the only signal; an empty table gives no rows.
    """
    folder = run_dir(docs.sparkSession, "resampling")
    scored = written(document_scores(docs, target, id_col, text, target_text, width, buckets, seed), folder, "scored")
    eligible = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    ranked = draw_ranks(scored.where(eligible), "score", "doc_id", percent, folder)
    rest = scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
