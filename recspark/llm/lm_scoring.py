"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, scored by mapping them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm import hashstore
from recspark.llm.shared import as_id, mounted, run_dir, written
from recspark.llm.spans import chunks, mix, unmix, word_hashes

END = np.uint64(0x5EED0FE0D0C5E17D)  # the end token's place among the word hashes
HELD = 1 << 22  # distinct keys a task sums up before it hands them on
RANGE = 1 << 20  # words of one file of word statistics
STATS = ["total", "n1", "n2", "n3", "before"]


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all words."""

    folder: str
    word_bits: int
    pair_bits: int
    first_id: tuple[int, ...]  # of each bucket of words; ids follow the sorted hashes
    tokens: int
    words: int
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    pairs: int  # distinct
    word_rest: float  # share of the uniform distribution in the lower order


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """For counts 1, 2 and 3 or more, from the numbers of entries seen 1, 2, 3 and 4 times; fixed ones where these do not do."""
    n1, n2, n3, n4 = counts
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 <= x <= k for k, x in enumerate(d, 1)):
            return d
    return 0.5, 1.0, 1.5


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every text with an end token after each, and the number of tokens of each text."""
    words, n = word_hashes(texts)
    return np.insert(words, np.cumsum(n), END), n + 1


def _count(keys_of: Callable[[list[str]], np.ndarray], bits: int):
    """Keys of the texts with their counts, summed up in the task, as packed rows by bucket."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for _, texts in chunks(frames, "text"):
            parts.append(np.unique(keys_of(texts), return_counts=True))
            size += len(parts[-1][0])
            if size > HELD:
                parts = [hashstore.summed(*map(np.concatenate, zip(*parts, strict=True)))]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield hashstore.packed(parts[0][0], [parts[0][1]], bits)
                    parts, size = [], 0
        if parts:
            keys, counts = hashstore.summed(*map(np.concatenate, zip(*parts, strict=True)))
            yield hashstore.packed(keys, [counts], bits)

    return work


def _ids(keys: np.ndarray, folder: str, bits: int, first: tuple[int, ...]) -> np.ndarray:
    """Ids of word hashes, -1 for unknown ones."""
    distinct, back = np.unique(keys, return_inverse=True)
    found, place, _ = hashstore.store(folder, bits).find(distinct, [])
    ids = np.where(found, place + np.array(first, np.int64)[hashstore.bucket_of(distinct, bits)], -1)
    return ids[back]


def _contexts(ids: np.ndarray, n: np.ndarray, start: int) -> np.ndarray:
    """The id before every token; ``start`` before the first one of a text."""
    before = np.concatenate([[start], ids[:-1]])
    before[np.cumsum(n) - n] = start
    return before


def _times(counts: np.ndarray) -> dict[str, list[int]]:
    return {f"s{k}": [int((counts == k).sum())] for k in (1, 2, 3, 4)} | {"s5": [len(counts)], "s6": [int(counts.sum())]}


_ROW = "bucket int, blob binary, s1 long, s2 long, s3 long, s4 long, s5 long, s6 long"


def _write_words(folder: str):
    def work(part: pd.DataFrame) -> pd.DataFrame:
        keys, c = hashstore.merged(part["blob"])
        bucket = int(part["bucket"].iloc[0])
        hashstore.write_bucket(folder, bucket, keys, c=c)
        return pd.DataFrame({"bucket": [bucket], "blob": [None], **_times(c)})

    return work


def _write_pairs(folder: str):
    """Write a bucket of pairs, and hand on what it says about their words, by ranges of ids."""

    def work(part: pd.DataFrame) -> pd.DataFrame:
        keys, c = hashstore.merged(part["blob"])
        hashstore.write_bucket(folder, int(part["bucket"].iloc[0]), keys, c=c)
        ids = unmix(keys)
        u, v = ids >> np.uint64(32), ids & np.uint64(0xFFFFFFFF)
        one, zero = np.ones(len(c), np.uint64), np.zeros(len(c), np.uint64)
        seen = [c, *[np.where(x, one, zero) for x in (c == 1, c == 2, c >= 3)], zero]
        k, *columns = hashstore.summed(np.concatenate([u, v]), *[np.concatenate([x, y]) for x, y in zip(seen, [zero] * 4 + [one], strict=True)])
        ranges = (k // np.uint64(RANGE)).astype(np.int64)
        out = [{"bucket": int(r), "blob": hashstore.pack(k[m := ranges == r], *[x[m] for x in columns])} for r in np.unique(ranges)]
        out.append({"bucket": -1} | {name: x[0] for name, x in _times(c).items()})
        return pd.DataFrame(out, columns=["bucket", "blob", "s1", "s2", "s3", "s4", "s5", "s6"])

    return work


def _write_stats(folder: str):
    def work(part: pd.DataFrame) -> pd.DataFrame:
        bucket = int(part["bucket"].iloc[0])
        k, *columns = hashstore.merged(part["blob"])
        at = (k - np.uint64(bucket * RANGE)).astype(np.int64)
        dense = {}
        for name, values in zip(STATS, columns, strict=True):
            dense[name] = np.zeros(RANGE, np.uint64)
            dense[name][at] = values
        hashstore.write_bucket(folder, bucket, k, **dense)
        before = columns[-1]
        return pd.DataFrame({"bucket": [bucket], "blob": [None], **_times(before[before > 0])})

    return work


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all words and pairs of neighbouring words of ``docs`` and write the model's arrays.

    Every text is ``<start> words... <end>``; the start is a context only. Tasks sum up what they read and hand on
    compressed runs of sorted keys, one for each bucket of hashes; buckets, and so tasks, follow the size of the input.
    Ids are 32 bits wide, enough for 4 billion different words.
    """
    folder = run_dir(docs.sparkSession, "lm")
    files = mounted(folder)
    base = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    guess = (base.agg(F.sum(F.octet_length("text") + 6)).first()[0] or 0) // 6
    word_bits, pair_bits = hashstore.bits_for(guess // 8), hashstore.bits_for(guess // 2)
    counted = base.mapInPandas(_count(lambda texts: tokens_of(texts)[0], word_bits), "bucket int, blob binary")
    words = written(counted.groupBy("bucket").applyInPandas(_write_words(f"{files}/words"), _ROW), folder, "word-buckets")
    sizes = {r.bucket: (r.s5, r.s6) for r in words.collect()}  # a row per bucket
    n = [sizes.get(b, (0, 0))[0] for b in range(1 << word_bits)]
    first = tuple(np.concatenate([[0], np.cumsum(n)[:-1]]).astype(int).tolist())
    total, distinct = sum(s[1] for s in sizes.values()), sum(n)
    if distinct >= 2**32 - 1:
        raise ValueError("more words than 32-bit ids")

    def pair_keys(texts: list[str]) -> np.ndarray:
        tokens, counts = tokens_of(texts)
        ids = _ids(tokens, f"{files}/words", word_bits, first)
        return mix(_contexts(ids, counts, distinct).astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))

    counted = base.mapInPandas(_count(pair_keys, pair_bits), "bucket int, blob binary")
    pairs = written(counted.groupBy("bucket").applyInPandas(_write_pairs(f"{files}/pairs"), _ROW), folder, "pair-buckets")
    sums = [F.coalesce(F.sum(f"s{k}"), F.lit(0)) for k in range(1, 7)]
    seen = pairs.where("bucket = -1").agg(*sums).first()
    ranges = written(pairs.where("bucket >= 0").groupBy("bucket").applyInPandas(_write_stats(f"{files}/stats"), _ROW), folder, "ranges")
    lower = ranges.agg(*sums).first()
    d = discounts(list(lower[:4]))
    rest = (d[0] * lower[0] + d[1] * lower[1] + d[2] * (lower[4] - lower[0] - lower[1])) / lower[5] if lower[5] else 1.0
    return Model(files, word_bits, pair_bits, first, total, distinct, discounts(list(seen[:4])), d, lower[5], rest)


def _discount(counts: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def _score(model: Model):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stats = hashstore.store(f"{model.folder}/stats", 1)
        pairs = hashstore.store(f"{model.folder}/pairs", model.pair_bits)
        words = hashstore.store(f"{model.folder}/words", model.word_bits)

        def about(ids: np.ndarray, names: list[str]) -> list[np.ndarray]:
            out = [np.zeros(len(ids), np.int64) for _ in names]
            edges = np.flatnonzero(np.diff(ids // RANGE, prepend=-2, append=-2))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if ids[a] >= 0:
                    for o, name in zip(out, names, strict=True):
                        held = stats.column(int(ids[a] // RANGE), name)
                        if held is not None:
                            o[a:b] = held[ids[a:b] % RANGE]
            return out

        for rows, texts in chunks(frames, "text"):
            tokens, n = tokens_of(texts)
            keys, back = np.unique(tokens, return_inverse=True)
            found, place, (c,) = words.find(keys, ["c"])
            ids = np.where(found, place + np.array(model.first_id, np.int64)[hashstore.bucket_of(keys, model.word_bits)], -1)
            contexts = _contexts(ids[back], n, model.words)
            base = np.log10((c + 1) / (model.tokens + model.words + 1))[back]
            order = np.argsort(ids)
            before = np.zeros(len(ids), np.int64)
            (before[order],) = about(ids[order], ["before"])
            low = np.full(len(ids), model.word_rest / (model.words + 1))
            if model.pairs:
                low += np.maximum(before - _discount(before, model.word_discounts), 0) / model.pairs
            u, which = np.unique(contexts, return_inverse=True)
            total, n1, n2, n3 = about(u, ["total", "n1", "n2", "n3"])
            d = model.pair_discounts
            known = total > 0
            rest = np.where(known, (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(total, 1), 1.0)
            both = (contexts >= 0) & (ids[back] >= 0)
            pair = mix(np.where(both, contexts, 0).astype(np.uint64) << np.uint64(32) | np.where(both, ids[back], 0).astype(np.uint64))
            asked, again = np.unique(pair, return_inverse=True)
            _, _, (times,) = pairs.find(asked, ["c"])
            times = np.where(both, times[again], 0)
            p = np.maximum(times - _discount(times, d), 0) / np.maximum(total, 1)[which] + rest[which] * low[back]
            row = np.repeat(np.arange(len(texts)), n)
            add = lambda x: np.bincount(row, weights=x, minlength=len(texts))  # noqa: E731, B023
            yield pd.DataFrame({
                "doc_id": rows["doc_id"], "held_out": rows["held_out"], "n_tokens": n, "n_known": add(found[back]).astype(np.int64), "train_tokens": model.tokens,
                "base_score": add(base), "score": add(np.log10(p)),
            })

    return work


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    The model learns from the rows that are not held out, by their id (a null id counts as an empty text and is not
    held out). A null or empty text is its end token. Unknown words share one place in the uniform distribution at the
    bottom, so the probabilities after any context sum to one.
    """
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"), held_out(id_col).alias("held_out"))
    model = train(base.where("NOT held_out"))
    out = base.mapInPandas(_score(model), "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("doc_id", as_id(docs, id_col, "doc_id"))
