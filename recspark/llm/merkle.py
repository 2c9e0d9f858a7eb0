"""Merkle manifest of a dataset: a hash tree per group, a tree of the groups' roots, and a proof for every row.

A tree's nodes are addressed by rank. The lowest octal digits of the rank are columns; a block of 8**4 leaves is brought
together once and its digits are grouped away one after the other, so that each step nests the structs of the last one
under their common parent. Blocks are the leaves of the next tower of digits. On the way back every nested struct is
taken apart again, each child with what stands left and right of it: that is its proof inside the block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.shared import run_dir, written
from recspark.llm.text import ascii_lower

FANOUT = 8  # nodes in a run
DIGITS = 4  # digits grouped away within a block: 4,096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left: string, right: string>"


def leaf_of(*values: Column) -> Column:
    """Hash of the values: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def dense_ranks(rows: DataFrame, group: str, order: Sequence[str], folder: str, name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order`` within ``group``) and ``total`` (rows of the group).

    Rows are dealt into sorted ranges and written; a row's rank is its place in the range plus the rows of its group in
    the ranges before. A group may have any share of all rows: it then lies in many ranges.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    at = ranged.withColumn("_at", F.monotonically_increasing_id())
    at = written(at.withColumn("_range", F.shiftright("_at", 33)), folder, f"{name}-ranges")
    counts = at.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # one entry per range that the group lies in, in order
    parts = counts.groupBy(group).agg(F.sum("_n").alias("total"), F.sort_array(F.collect_list(F.struct("_range", "_first", "_n"))).alias("p"))
    before = F.transform("p", lambda x, i: F.struct(x["_range"].alias("_range"), x["_first"].alias("_first"), F.aggregate(F.slice("p", 1, i), F.lit(0).cast("long"), lambda s, y: s + y["_n"]).alias("_before")))
    starts = written(parts.select(group, "total", F.inline(before)), folder, f"{name}-starts")
    placed = at.join(starts, [group, "_range"])
    return placed.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_range", "_first", "_before", "_at")


def _hash_of(kids: Column) -> Column:
    return F.sha2(F.array_join(F.transform(kids, lambda k: k["h"]), ""), 256)


def _rolled(nodes: DataFrame) -> DataFrame:
    """(grp, rank, total, h, kid) to (grp, rank, total, h, kids) of the blocks: rank and total now count blocks.

    ``kid`` is what a leaf carries. ``total`` is the number of leaves of the group, so a level where one node remains is
    known, and that node stays as it is.
    """
    digit = [F.pmod(F.floor(F.col("rank") / F.lit(FANOUT**i)), F.lit(FANOUT)).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    block = F.floor(F.col("rank") / F.lit(FANOUT**DIGITS))
    keys = ["grp", "block", "total"]
    rows = nodes.select("grp", block.alias("block"), "total", *digit, F.struct("h", "kid").alias("node"))
    rows = rows.repartition("grp", "block")  # the only shuffle: all groupings below refine it
    for i in range(DIGITS):
        above = [f"d{k}" for k in range(i + 1, DIGITS)]
        runs = rows.groupBy(*keys, *above).agg(F.sort_array(F.collect_list(F.struct(f"d{i}", "node.h", "node.kid"))).alias("kids"))
        h = F.when(F.col("total") > FANOUT**i, _hash_of(F.col("kids"))).otherwise(F.col("kids")[0]["h"])
        rows = runs.select(*keys, *above, F.struct(h.alias("h"), F.col("kids").alias("kid")).alias("node"))
    blocks = F.ceil(F.col("total") / F.lit(FANOUT**DIGITS))
    return rows.select("grp", F.col("block").alias("rank"), blocks.alias("total"), F.col("total").alias("leaves"), "node.h", F.col("node.kid").alias("kids"))


def _apart(blocks: DataFrame) -> DataFrame:
    """The inverse of ``_rolled`` for blocks that have the ``path`` above them and the columns ``top`` of their tree."""
    rows = blocks.select("grp", "rank", "leaves", "path", "top", "kids")
    for i in reversed(range(DIGITS)):
        rows = rows.select("grp", "rank", "leaves", "path", "top", "kids", F.posexplode("kids").alias("at", "node"))

        def hashes(part: Column) -> Column:
            return F.array_join(F.transform(part, lambda k: k["h"]), "")

        own = F.struct(hashes(F.slice("kids", 1, F.col("at"))).alias("left"), hashes(F.slice("kids", F.col("at") + 2, F.lit(FANOUT))).alias("right"))
        path = F.when(F.col("leaves") > FANOUT**i, F.concat(F.array(own), F.col("path"))).otherwise(F.col("path"))
        rank = F.col("rank") * FANOUT + F.col(f"node.d{i}")
        rows = rows.select("grp", rank.alias("rank"), "leaves", path.alias("path"), "top", F.col("node.h").alias("h"), F.col("node.kid").alias("kids"))
    return rows.withColumnRenamed("kids", "kid")


def _towers(leaves: DataFrame, folder: str, name: str) -> list[DataFrame]:
    """The blocks of every height, written, until each group is one block. ``leaves``: grp, rank, total, h, kid."""
    towers, nodes = [], leaves
    while True:
        blocks = written(_rolled(nodes), folder, f"{name}-{len(towers)}")
        towers.append(blocks)
        most = blocks.agg(F.max("total").alias("most")).first()["most"]
        if most is None or most <= 1:
            return towers
        nodes = blocks.select("grp", "rank", "total", "h", F.lit(True).alias("kid"))


def _paths(towers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Rows of the lowest blocks with their paths up to the root. ``tops``: grp, path and top of the group's root."""
    rows = _apart(towers[-1].join(tops, "grp"))
    for blocks in reversed(towers[:-1]):
        # the way above a block meets the block: one row on either side
        above = rows.select("grp", "rank", "path", "top")
        rows = _apart(blocks.join(above, ["grp", "rank"]))
    return rows


def merkle_manifest(
    docs: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, path, and the columns of ``carry``.

    ``path``: what stands left and right of the row's node in every run from its leaf up to the root, as concatenated
    hashes; a row alone in its run has two empty strings there. ``folded`` computes a root from it. Rows of a group stand
    in ascending order of id (null first; rows of one id by their leaf, so that equal rows are interchangeable), groups in
    ascending order bytewise (null first, a group of its own). Null fields hash as ``-``, an empty text as ``0:``. An
    empty table has no rows. Columns outside ``fields`` are not read.

    Within a block of 4,096 rows proofs need no join; the path above a block is attached to it by an equi join of one row
    with one row. Only counts are read by the driver.
    """
    folder = run_dir(docs.sparkSession, "merkle")
    carry = carry or {}
    grp = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))  # null first, then bytewise
    rows = docs.select(grp.alias("grp"), F.struct(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in carry.items()]).alias("kid"), leaf_of(*[F.col(f) for f in fields]).alias("h"))
    rows = rows.withColumn("id", F.col("kid.doc_id"))
    ranked = dense_ranks(written(rows, folder, "leaves"), "grp", ["id", "h"], folder, "leaves")
    low = _towers(ranked.select("grp", "rank", "total", "h", "kid"), folder, "blocks")

    subroots = low[-1].select(F.lit(0).alias("all"), "grp", "h")
    over = dense_ranks(subroots, "all", ["grp"], folder, "groups")
    over = over.select(F.col("all").cast("string").alias("grp"), "rank", "total", "h", F.col("grp").alias("kid"))
    high = _towers(over, folder, "groups")
    root = high[-1].select("grp", F.array().cast(f"array<{STEP}>").alias("path"), F.col("h").alias("top"))
    tops = _paths(high, root).select(F.col("kid").alias("grp"), "path", F.struct(F.col("h").alias("subroot"), F.col("top").alias("root")).alias("top"))
    tops = written(tops, folder, "tops")
    out = _paths(low, tops)
    return out.select("kid.doc_id", F.col("h").alias("leaf"), "top.subroot", "top.root", "path", *[F.col(f"kid.{n}").alias(n) for n in carry])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest_report(docs: DataFrame, id_col: str = "doc_id", group: str = "lang", text: str = "text", fields: Sequence[str] = FIELDS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Every row is verified against its proof; where 3 divides the CRC-32 of the decimal id, the text is lower-cased (A-Z)
    first, which must be found out if it had capitals. Rows without an id are not tampered with.
    """
    tampered = leaf_of(*[ascii_lower(F.col(text)) if f == text else F.col(f) for f in fields])
    chosen = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))
    rows = merkle_manifest(docs, id_col, group, fields, {"tampered": F.when(chosen, tampered)})
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    out = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
