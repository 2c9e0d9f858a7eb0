"""Line de-duplication that returns compressed keep bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.shared import run_dir, written
from recspark.llm.text import WHITE, ascii_lower

MIN_CHARS = 10
PARTS = 1024  # parts that the ids of a line are dealt over


def lines_of(text: Column) -> Column:
    """A null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _streamed(lines: DataFrame) -> DataFrame:
    """``lines`` with their part of a hash's ids and the part's first id, found in one pass over sorted ranges.

    The range partitioning serves the window as it is: a partition is sorted by hash, part, id and position, and its rows
    stream past the first one of their hash and part. Ids are dealt over ``PARTS`` parts, so a line that is found
    everywhere is many small runs in many partitions.
    """
    ranged = lines.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int")).repartitionByRange("h1", "h2", "part")
    ahead = Window.partitionBy("h1", "h2", "part").orderBy("id", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumn("first", F.first("id").over(ahead))


def _repeated(lines: DataFrame, folder: str) -> DataFrame:
    """(id, version, at) of the lines that a smaller id has as well.

    A line behind the first id of its part is repeated whatever the other parts hold. The lines of first ids, the heads,
    are settled among themselves: a hash has ``PARTS`` heads at most, but for lines that one document repeats.
    """
    streamed = written(_streamed(lines), folder, "streamed")
    heads = streamed.where("id = first")
    first = F.min("id").over(Window.partitionBy("h1", "h2"))
    late = heads.withColumn("first", first)
    return streamed.where("id > first").union(late.where("id > first").select(streamed.columns)).select("id", "version", "at")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, version, bitmap) for the texts that lose lines.

    The bitmap is run-length coded: numbers of lines kept and dropped in turn, from the first line on; lines after the
    last run stay. ``version`` is a hash of the text, as an id may come in several rows. A line is dropped if its key
    (ends stripped, A-Z lower-cased, at least ``min_chars`` code points) is found in a smaller id as well; lines of
    rows without an id stay and count for nothing.

    Lines travel as (128-bit hash, id, version, position) only, see ``_repeated``.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "line-dedup")
    raw = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"),
        F.posexplode(lines_of(F.col(text))).alias("at", "line"),
    )
    key = raw.withColumn("key", F.btrim("line", F.lit(WHITE))).where(F.char_length("key") >= min_chars).withColumn("key", ascii_lower(F.col("key")))
    lines = written(key.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "version", "at"), folder, "lines")
    # dealt by text once: the steps up to the bitmap keep that partitioning
    dropped = _repeated(lines, folder).repartition("id", "version").distinct()
    by_text = Window.partitionBy("id", "version")
    runs = dropped.withColumn("run", F.col("at") - F.row_number().over(by_text.orderBy("at"))).groupBy("id", "version", "run").agg(F.min("at").alias("start"), F.count("*").cast("int").alias("n"))
    runs = runs.withColumn("gap", F.col("start") - F.coalesce(F.lag(F.col("start") + F.col("n")).over(by_text.orderBy("start")), F.lit(0)))
    bitmap = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", "gap", "n"))), lambda r: F.array(r["gap"], r["n"])))
    return written(runs.groupBy("id", "version").agg(bitmap.alias("bitmap")), folder, "bitmaps")


def kept_lines(lines: Column, bitmap: Column) -> Column:
    """The lines that a bitmap keeps (all for a null bitmap)."""
    flags = F.flatten(F.transform(F.coalesce(bitmap, F.array().cast("array<int>")), lambda n, i: F.array_repeat(i % 2 == 1, n)))
    return F.filter(F.zip_with(lines, flags, lambda x, drop: F.when(F.coalesce(drop, F.lit(False)), F.lit(None)).otherwise(x)), lambda x: x.isNotNull())


def _joined(docs: DataFrame, bitmaps: DataFrame, id_col: str, text: str) -> tuple[DataFrame, Column]:
    """Texts (alias d) with their bitmaps (alias b, null: all lines stay), and the text that stays."""
    d, b = docs.alias("d"), bitmaps.alias("b")
    own = F.col(f"d.`{text}`")
    joined = d.join(b, (F.col(f"d.`{id_col}`") == F.col("b.id")) & (F.xxhash64(F.coalesce(own, F.lit(""))) == F.col("b.version")), "left")
    return joined, F.array_join(kept_lines(lines_of(own), F.col("b.bitmap")), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with their columns, the text without its repeated lines. A null text becomes an empty one."""
    joined, kept = _joined(docs, keep_bitmaps(docs, id_col, text), id_col, text)
    return joined.select(*[kept.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])


def line_dedup_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    joined, kept = _joined(slim, keep_bitmaps(slim), "doc_id", "text")
    runs = F.coalesce(F.col("b.bitmap"), F.array().cast("array<int>"))
    dropped = F.aggregate(F.transform(runs, lambda n, i: F.when(i % 2 == 1, n).otherwise(0)), F.lit(0).cast("long"), lambda s, x: s + x)
    return joined.select("d.doc_id", F.size(lines_of(F.col("d.text"))).cast("long").alias("n_lines"), dropped.alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"))
