"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.text import WHITE, windows, words

SAMPLE_ROWS = 1000  # rows expected in the sample that costs and selectivities are measured on
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words inside repeated three-word windows

SYMBOLS = r"[#*$%&|<>]"


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")


def word_chars(ws: Column) -> Column:
    return F.char_length(F.array_join(ws, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = _lines(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more; windows are compared by 64-bit hash.

    The windows of one text are sorted with their positions, so that equal ones are neighbours: n log n per text, no
    explode and no shuffle. Positions of repeated windows cover three words each, less where they overlap.
    """
    hashed = F.transform(windows(ws, 3), lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i")))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = F.sort_array(F.concat(hashed.cast("array<struct<h:bigint,i:int>>"), nothing))

    def covered(s: Column) -> Column:
        h = s["h"]
        around = F.arrays_zip(
            s["i"].alias("i"), h.alias("h"), F.concat(F.array(F.lit(None).cast("long")), h).alias("p"), F.slice(h, 2, F.greatest(F.size(h), F.lit(1))).alias("n")
        )
        at = F.sort_array(F.transform(F.filter(around, lambda x: x["i"].isNotNull() & (x["h"].eqNullSafe(x["p"]) | x["h"].eqNullSafe(x["n"]))), lambda x: x["i"]))
        return _cover(at)

    # a one-element array binds the sorted windows once
    return F.transform(F.array(ordered), covered)[0]


def _cover(at: Column) -> Column:
    def total(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    return F.transform(F.array(at), total)[0]


def default_rules(text: Column, ws: Column) -> dict[str, Column]:
    """Rule -> condition under which a text fails it. Every rule stands alone, so their order cannot change a verdict."""
    n = F.size(ws)
    return {
        "short": n < MIN_WORDS,
        "word_length": (word_chars(ws) < 2 * n) | (word_chars(ws) > 25 * n),
        "symbols": symbol_count(text) * 10 > n,
        "duplicate_lines": duplicate_lines(text) * 10 > F.size(_lines(text)) * 6,
        "repeated_words": repeated_words(ws) * 100 > F.size(ws) * MAX_REPEATED,
    }


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """About ``rows`` rows of ``docs`` (all if it has fewer); the one count reads no column."""
    n = docs.count()
    return docs if n <= rows else docs.sample(fraction=rows / n, seed=seed)


def order_rules(sample: DataFrame, rules: Mapping[str, Column]) -> list[str]:
    """Rule names by rejection rate per second on ``sample`` (a bounded frame), best first; ties by name.

    Each rule is timed alone over the persisted sample, less the time of a pass that evaluates nothing.
    """
    sample = sample.persist()
    try:
        # an aggregate over no rows gives nulls
        seen = sample.agg(F.count("*").alias("_n"), *[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(k) for k, c in rules.items()]).first()

        def seconds(c: Column) -> float:
            start = time.perf_counter()
            sample.select(c.alias("x")).agg(F.sum(F.col("x").cast("long"))).collect()
            return time.perf_counter() - start

        idle = seconds(F.lit(True))
        cost = {k: max(seconds(c) - idle, 1e-4) for k, c in rules.items()}
        rate = {k: (seen[k] or 0) / max(seen["_n"], 1) for k in rules}
        return sorted(rules, key=lambda k: (-rate[k] / cost[k], cost[k], k))
    finally:
        sample.unpersist()


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """The first failed rule in ``order``, null for a text that passes; later rules are not evaluated then."""
    out = None
    for name in order:
        failed = F.coalesce(rules[name], F.lit(False))
        out = F.when(failed, F.lit(name)) if out is None else out.when(failed, F.lit(name))
    return F.lit(None).cast("string") if out is None else out


def with_words(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_words", words(F.col(text)))


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass all rules, with their columns. A null or empty text has no words and fails."""
    slim = docs.select(F.col(text).alias("_text"))
    order = order_rules(with_words(sample_of(slim), "_text"), default_rules(F.col("_text"), F.col("_words")))
    # a one-element array binds the words once; a column of their own would be put into every rule when the filter is pushed down
    failed = F.transform(F.array(words(F.col(text))), lambda ws: cascade(default_rules(F.col(text), ws), order))[0]
    return docs.where(failed.isNull())


def quality_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts behind the rules, ``base_failed`` and ``kept``.

    A null text counts as no words. Ids are passed on as they are (null, repeated); other columns are ignored. The
    counts are wanted for every text here, so only the verdict is short-circuited.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    order = order_rules(with_words(sample_of(slim.select("_text")), "_text"), default_rules(F.col("_text"), F.col("_words")))
    counted = with_words(slim, "_text").select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        word_chars(F.col("_words")).alias("word_chars"),
        symbol_count(F.col("_text")).alias("n_symbols"),
        duplicate_lines(F.col("_text")).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(_lines(F.col("_text"))).cast("long").alias("n_lines"),
    )
    n = F.col("n_words")
    rules = {
        "short": n < MIN_WORDS,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 25 * n),
        "symbols": F.col("n_symbols") * 10 > n,
        "duplicate_lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 6,
        "repeated_words": F.col("n_repeat_words") * 100 > n * MAX_REPEATED,
    }
    base = rules["short"] | rules["repeated_words"]
    return counted.withColumn("base_failed", base).withColumn("kept", ~base & cascade(rules, order).isNull())
