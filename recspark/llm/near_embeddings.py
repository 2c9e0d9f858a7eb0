"""Near-duplicate vectors of one label by a pigeonhole join over rotated subspaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.graph import components
from recspark.llm.shared import run_dir, written

COSINE = 0.98
BLOCK_DIMS = 8  # dimensions of a block
GRID_DIMS = 2  # of which so many lay out the cells of the range join
TILE = 2_000  # rows of a cell that one task compares with so many others at once
SLACK = 1e-9  # for rounding in the rotation; candidates are verified exactly


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[slice]:
    cuts = np.linspace(0, dims, max(1, round(dims / BLOCK_DIMS)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vector: Column) -> Column:
    """The vector times a power of two, which is exact, so that its largest component is about 1: no product overflows."""
    largest = F.aggregate(vector, F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
    factor = F.pow(F.lit(2.0), -F.greatest(F.lit(-1000), F.least(F.floor(F.log2(largest)), F.lit(1000))).cast("double"))
    return F.transform(F.array(F.struct(vector.alias("v"), factor.alias("f"))), lambda x: F.transform(x["v"], lambda v: v * x["f"]))[0]


def _cells(cosine: float):
    """Every vector in every block: its home cell and the cells within the block's radius, with its coordinates there."""
    budget = 2 - 2 * cosine + SLACK

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (label, dims), part in frame.groupby(["label", "dims"], sort=False):
                x = np.stack([np.asarray(v, np.float64) for v in part["vector"]])
                x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(dims)
                for b, cut in enumerate(blocks_of(dims)):
                    y = x[:, cut]
                    radius = np.sqrt(budget * y.shape[1] / dims)  # squared distances add up, so one block is within its share
                    g = y[:, :GRID_DIMS]
                    low, high = (np.floor((g + s * radius) / (2 * radius)).astype(np.int64) for s in (-1, 1))
                    home = np.floor(g / (2 * radius)).astype(np.int64)
                    seen = []
                    for corner in range(2 ** g.shape[1]):
                        cell = np.stack([(high if corner >> k & 1 else low)[:, k] for k in range(g.shape[1])], axis=1)
                        new = np.ones(len(cell), bool)
                        for other in seen:
                            new &= (cell != other).any(axis=1)
                        seen.append(cell)
                        yield pd.DataFrame({
                            "label": label, "dims": dims, "block": b, "cell": [c.tobytes() for c in cell[new]], "id": part["id"].to_numpy()[new],
                            "home": (cell == home).all(axis=1)[new], "at": list(y[new]),
                        })

    return work


def _candidates(cosine: float):
    """Pairs of a tile whose distance in the block is within the block's share; one of a pair is at home in the cell."""
    budget = 2 - 2 * cosine + SLACK

    def work(tile: pd.DataFrame) -> pd.DataFrame:
        dims, x, ids, home = int(tile["dims"].iloc[0]), np.stack(tile["at"].to_numpy()), tile["id"].to_numpy(), tile["home"].to_numpy()
        first, second = tile["part"].to_numpy() == tile["i"].to_numpy(), tile["part"].to_numpy() == tile["j"].to_numpy()
        a, b = np.flatnonzero(first), np.flatnonzero(second)
        share, norms, found = budget * x.shape[1] / dims, (x * x).sum(axis=1), []
        for rows in np.array_split(a, max(1, len(a) // 500)):
            d = norms[rows][:, None] + norms[b][None, :] - 2 * (x[rows] @ x[b].T)
            p, q = np.nonzero((d <= share + SLACK) & (home[rows][:, None] | home[b][None, :]))
            p, q = ids[rows[p]], ids[b[q]]
            found.append(np.stack([np.minimum(p, q), np.maximum(p, q)])[:, p != q])
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]})

    return work


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. Vectors are compared where labels and dimensions are equal.

    Unit vectors of cosine c are 2 - 2c apart (squared). After a rotation every block of dimensions gets its share of
    that, and a pair must be within the share of one block at least: a range join over a grid in each block finds the
    candidates, and the cosine of the whole vectors in double precision decides. Equal vectors of a label are one class
    first. A cell with more rows than a tile is compared tile by tile in as many tasks. Vectors that are null, empty,
    zero or hold null or non-finite components, and rows without label or id, are linked with nothing (component: the
    row's id). Rows that repeat an id count as rows of their own.
    """
    folder = run_dir(df.sparkSession, "near-vectors")
    base = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    base = base.withColumn("use", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    base = written(base.withColumn("h1", F.xxhash64("label", "vector")).withColumn("h2", F.xxhash64(F.lit(1), "label", "vector")), folder, "rows")
    classes = base.where("use").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
    classes = classes.withColumn("vector", scaled(F.col("vector")))
    # an id of the class, as one vec_id may stand in several rows
    classes = written(classes.withColumn("id", F.xxhash64("h1", "h2")).withColumn("dims", F.size("vector")), folder, "classes")
    cells = classes.select("id", "label", "dims", "vector").mapInPandas(_cells(cosine), "label string, dims int, block int, cell binary, id long, home boolean, at array<double>")
    cells = written(cells, folder, "cells")
    key = ["label", "dims", "block", "cell"]
    sizes = cells.groupBy(*key).agg(F.count("*").alias("m"), F.count_if("home").alias("homes")).where("m > 1 AND homes > 0")
    parts = written(sizes.select(*key, F.ceil(F.col("m") / F.lit(TILE)).cast("int").alias("parts")), folder, "cell-sizes")
    tiled = cells.join(parts, key).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("part")).alias("i"), F.greatest(o, F.col("part")).alias("j")))
    tiled = tiled.withColumn("tile", F.explode(others)).select(*key, "id", "home", "at", "part", "tile.i", "tile.j")
    pairs = tiled.groupBy(*key, "i", "j").applyInPandas(_candidates(cosine), "a long, b long").distinct()
    pairs = written(pairs, folder, "candidates")
    a = classes.select(F.col("id").alias("a"), F.col("vector").alias("va"), F.col("n").alias("n_a"))
    b = classes.select(F.col("id").alias("b"), F.col("vector").alias("vb"), F.col("n").alias("n_b"))
    links = written(pairs.join(a, "a").join(b, "b").where(cosine_of(F.col("va"), F.col("vb")) >= cosine).select("a", "b", "n_a", "n_b"), folder, "links")
    both = links.select(F.col("a").alias("id"), F.col("n_b").alias("n")).union(links.select(F.col("b"), F.col("n_a")))
    counts = both.groupBy("id").agg(F.sum("n").alias("others"))
    found = components(links, folder).withColumnRenamed("node", "id")
    slim = classes.select("id", "h1", "h2", "n", "least").join(counts, "id", "left").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = slim.groupBy("component").agg(F.min("least").alias("component_id"))
    result = written(slim.join(least, "component").select("h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), folder, "result")
    out = base.select("vec_id", "use", F.when(F.col("use"), F.col("h1")).alias("h1"), "h2").join(result, ["h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))


def cosine_of(x: Column, y: Column) -> Column:
    """Cosine of two scaled vectors."""

    def dot(p: Column, q: Column) -> Column:
        return F.aggregate(F.zip_with(p, q, lambda i, j: i * j), F.lit(0.0), lambda s, v: s + v)

    return dot(x, y) / F.sqrt(dot(x, x)) / F.sqrt(dot(y, y))
