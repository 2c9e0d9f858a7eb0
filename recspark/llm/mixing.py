"""Mixing sources by temperature: weights from token shares, realised as block permutations within budgets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.shared import run_dir, written
from recspark.llm.text import words

BLOCK_ROWS = 10_000  # documents expected in a block
SECTIONS, PASSES = 16, 8  # 16 ** 8 steps of the exponent


def exponent(sources: DataFrame, entropy: float | None, repeats: float | None) -> float:
    """The largest exponent a in [0, 1] of weights ~ tokens ** a that meets the target entropy (a share of the entropy of
    equal weights), or a larger one if some source were repeated more than ``repeats`` times as often as another.

    Both sides move one way with the exponent, so intervals are cut again and again; a pass tries all cuts in one
    aggregation over the sources, which are never collected.
    """

    def solve(wanted, target: float) -> float:
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            tried = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
            values = sources.agg(F.count("*"), *[c for a in tried for c in wanted(a)]).first()[1:]
            met = [bool(v is not None and v >= target) for v in values]
            last = max((k for k, m in enumerate(met) if m), default=0)
            low, high = tried[last], tried[min(last + 1, SECTIONS)]
            if low == high:
                break
        return low

    log = F.log("tokens")
    facts = sources.agg(F.count("*").alias("n"), F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if facts.n < 2 or facts.least == facts.most:
        return 1.0
    out = 1.0
    if entropy is not None:
        total = lambda a: F.sum(F.exp(a * log))
        out = solve(lambda a: [(F.log(total(a)) - a * F.sum(F.exp(a * log) * log) / total(a))], entropy * math.log(facts.n))
    if repeats is not None:
        # least tokens are repeated (most / least) ** (1 - a) times as often as most tokens
        spread = math.log(facts.most / facts.least)
        out = max(out, 1 - math.log(repeats) / spread)
    return min(max(out, 0.0), 1.0)


def _order(seed: int, epoch: Column, key: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, key)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", entropy: float | None = 0.95, repeats: float | None = 4.0,
    budget: int | None = None, seed: int = 17,
) -> DataFrame:
    """One row per draw: doc_id, source, n_tokens, weight, epoch, block, draw (its order within the block), row (the drawn
    row as a struct). Tokens are words without white space.

    A source's budget is its weight of ``budget`` tokens; without one, the smallest total that gives every source a whole
    pass, so no document is lost. Whole passes draw every document once; the last pass draws blocks in the order of a
    permutation of its own, and documents of the last block in theirs, while the budget holds. Blocks are hash buckets of
    documents, so a large source is as many blocks as it needs. Only block sums and one block of each source are ordered.
    A null source is a source; a source without tokens is drawn once. Equal rows are drawn alike.
    """
    folder = run_dir(docs.sparkSession, "mixing")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), F.size(words(F.col(text))).cast("long").alias("n_tokens"), own)
    slim = written(base.select("doc_id", "source", "n_tokens"), folder, "rows")
    sources = written(slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), folder, "sources")
    full = sources.where("tokens > 0")
    a = exponent(full, entropy, repeats)
    facts = full.agg(F.sum(F.pow("tokens", F.lit(a))).alias("z"), F.max(F.col("tokens") / F.pow("tokens", F.lit(a))).alias("most")).first()
    weight = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a)) / F.lit(facts.z or 1.0)).otherwise(0.0)
    given = F.lit(float(budget)) if budget is not None else F.lit((facts.most or 0.0) * (facts.z or 0.0))
    epochs = F.when(F.col("tokens") > 0, F.round(weight * given / F.col("tokens"), 9)).otherwise(1.0)
    shares = sources.withColumn("weight", weight).withColumn("epochs", epochs).withColumn("last", F.floor("epochs").cast("long"))
    shares = shares.withColumn("rest", F.floor((F.col("epochs") - F.col("last")) * F.col("tokens")).cast("long")).withColumn("blocks", F.ceil(F.col("docs") / F.lit(BLOCK_ROWS)).cast("long"))
    shares = written(shares.withColumnRenamed("source", "of"), folder, "shares")

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.join(shares, F.col("source").eqNullSafe(F.col("of")))
        key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), key), F.col("blocks")))
        return rows.withColumn("at", _order(seed, F.col("last"), F.col("block"))).withColumn("draw", _order(seed, F.col("last"), key))

    sums = placed(slim).groupBy("of", "block", "at", "rest").agg(F.sum("n_tokens").alias("tokens"))
    by_source = Window.partitionBy("of").orderBy("at", "block")
    sums = sums.withColumn("done", F.sum("tokens").over(by_source) - F.col("tokens"))
    # the block in which the budget ends; blocks before it are drawn whole
    ends = written(sums.where("done < rest").groupBy("of").agg(F.max(F.struct("at", "block", "done")).alias("end")), folder, "ends")
    inside = placed(slim).join(ends.withColumnRenamed("of", "e"), F.col("source").eqNullSafe(F.col("e"))).where("block = end.block")
    steps = inside.groupBy("of", "draw", "rest", "end").agg(F.sum("n_tokens").alias("tokens"))
    steps = steps.withColumn("done", F.sum("tokens").over(Window.partitionBy("of").orderBy("draw")) + F.col("end.done"))
    limits = written(ends.join(steps.where("done <= rest").groupBy(F.col("of").alias("o")).agg(F.max("draw").alias("to")), F.col("of").eqNullSafe(F.col("o")), "left").select(F.col("of").alias("e"), "end", "to"), folder, "limits")
    drawn = placed(base).join(limits, F.col("source").eqNullSafe(F.col("e")), "left")
    before = (F.col("at") < F.col("end.at")) | ((F.col("at") == F.col("end.at")) & (F.col("block") < F.col("end.block")))
    more = F.coalesce(before | ((F.col("block") == F.col("end.block")) & (F.col("draw") <= F.col("to"))), F.lit(False))
    times = F.col("last") + F.when(more, 1).otherwise(0)
    epoch = F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("epoch")
    out = drawn.where(times > 0).select("doc_id", "source", "n_tokens", "weight", "block", "row", epoch)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return out.select("doc_id", "source", "n_tokens", "weight", "epoch", "block", _order(seed, F.col("epoch"), key).alias("draw"), "row")
