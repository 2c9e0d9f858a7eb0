"""Token counts: pieces are counted once per distinct pre-token."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm import hashstore
from recspark.llm.shared import as_id, mounted, run_dir, written
from recspark.llm.spans import chunks, pretokens, span_hashes

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
SEEN = 1 << 20  # hashes a task remembers, so as to hand a pre-token on once


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _distinct(path: str):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, seen = pretokens(path), np.zeros(0, np.uint64)
        for _, texts in chunks(frames, "text"):
            joined, codes, starts, ends, _ = cutter.spans(texts)
            keys, first = np.unique(span_hashes(codes, starts, ends), return_index=True)
            at = np.searchsorted(seen, keys)
            new = np.ones(len(keys), bool) if not len(seen) else seen[np.minimum(at, len(seen) - 1)] != keys
            keys, first = keys[new], first[new]
            seen = np.sort(np.concatenate([seen if len(seen) < SEEN else seen[:0], keys]))
            if len(keys):  # pandas has no type for an empty column of texts
                yield pd.DataFrame({"key": keys.view(np.int64), "piece": [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]})

    return work


def _pieces(path: str):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = pretokens(path).tokenizer.encode_batch
        for frame in frames:
            ids = encode(frame["piece"].tolist(), add_special_tokens=False)
            yield pd.DataFrame({"key": frame["key"], "n": np.array([len(i.ids) for i in ids], np.int64)})

    return work


def _totals(path: str, folder: str, bits: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = pretokens(path)
        for rows, texts in chunks(frames, "text"):
            _, codes, starts, ends, counts = cutter.spans(texts)
            row = np.repeat(np.arange(len(texts)), counts)
            keys, back = np.unique(span_hashes(codes, starts, ends), return_inverse=True)
            found, _, (n,) = hashstore.store(folder, bits).find(keys, ["n"])
            if not found.all():
                raise RuntimeError("a pre-token without a count: the texts changed between two reads")
            total = np.bincount(row, weights=n[back], minlength=len(texts)).astype(np.int64) if len(row) else np.zeros(len(texts), np.int64)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": total})

    return work


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit; a null text is empty and has no tokens.

    Ids are handed through as they are, null, repeated or of any type; repeated rows have a row each.

    Texts are cut into pre-tokens without making ids. Distinct pre-tokens (by 64-bit hash) are shuffled once, cut into
    pieces by the library once each and stored as sorted hash arrays; the frequencies of every text are joined with
    these arrays where the text is, so nothing per text is shuffled. Only an order of distinct pre-tokens is written.
    """
    path = tokenizer or tokenizer_path()
    folder = run_dir(docs.sparkSession, "token-counts")
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"))
    distinct = base.select("text").mapInPandas(_distinct(path), "key long, piece string").dropDuplicates(["key"])
    pieces = written(distinct.mapInPandas(_pieces(path), "key long, n long"), folder, "pieces")
    bits = hashstore.bits_for(pieces.count())
    held = f"{mounted(folder)}/store"
    hashstore.write_rows(pieces, "key", ["n"], held, bits)
    out = base.mapInPandas(_totals(path, held, bits), "doc_id string, n_bytes long, n_tokens long")
    out = out.withColumn("doc_id", as_id(docs, id_col, "doc_id"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
