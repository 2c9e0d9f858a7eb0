"""Connected components by alternating large-star and small-star steps, and single contractions of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.shared import written

MAX_ROUNDS = 60  # the steps converge in O(log² n) rounds; beyond that something is wrong
JUMPS = 2  # times that a contraction follows its labels to the labels of those
SPREAD = 16  # tasks over which the rows of one component are dealt when it gets another label


def components(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Every step is an aggregation (combined on the map side, so a hub costs no more than its links) and an equi join.
    Self links and repeated links are harmless; an empty frame gives an empty frame. Nothing is collected but one row of
    counts per round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = written(edges, folder, "edges-0")
    before = None
    for step in range(1, MAX_ROUNDS):
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).groupBy("node").agg(F.min("component").alias("component"))
        before = state
        # large star: larger neighbours of u are hung on the smallest node around u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # a link gives one row at most, so repeated ones can wait for the next step
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = written(edges, folder, f"edges-{step}a")
        # small star: u and its smaller neighbours are hung on the smallest of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(edges.select("e.u", "e.v").where("u > v").distinct(), folder, f"edges-{step}b")
    raise RuntimeError("components did not converge")


def relabelled(df: DataFrame, merged: DataFrame, label: str = "c", by: str = "id") -> DataFrame:
    """``df`` with new labels from ``merged`` (node, component); the rows of one label are dealt over tasks by column ``by``."""
    part = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_part")
    to = merged.select(F.col("node").alias(label), F.col("component").alias("_to"), part)
    rows = df.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int")).join(to, [label, "_part"], "left")
    return rows.withColumn(label, F.coalesce("_to", label)).select(*df.columns)


def contracted(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> tuple[DataFrame, DataFrame]:
    """(merged, rest): a label for every node of ``links``, and the links (a, b) between labels that still differ.

    A node's label is the smallest node next to it or itself, followed ``JUMPS`` times. Nodes of one label are connected;
    the labels together with the rest connect what the links connect, so the rest goes on to the next contraction. That
    takes two jobs, where components take several for each of their steps. ``merged`` has the columns of ``components``.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    merged = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("node"), F.col("m").alias("component"))
    for _ in range(JUMPS):
        merged = relabelled(merged, merged, "component", "node")
    merged = written(merged, folder, "contracted")
    rest = relabelled(relabelled(edges, merged, "u", "v"), merged, "v", "u").where("u != v")
    return merged, written(rest.select(F.col("u").alias(a), F.col("v").alias(b)).distinct(), folder, "rest")
