"""Sorted hash arrays in the shared folder, memory-mapped by the workers that look values up."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.shared import put

BUCKET_ROWS = 1 << 20  # rows expected in a bucket; the number of buckets follows the data


def bits_for(rows: int) -> int:
    return max(1, int(np.ceil(np.log2(max(rows, 1) / BUCKET_ROWS))))


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int32)


def small(values: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type that holds them all."""
    return values.astype(np.min_scalar_type(int(values.max()) if values.size else 0))


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys as differences, by byte planes, with columns of counts; compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    parts = [np.array([len(keys), len(columns)], "<u8").tobytes(), steps.view(np.uint8).reshape(-1, 8).T.tobytes()]
    parts += [c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, columns = np.frombuffer(data, "<u8", 2).astype(int)
    planes = np.frombuffer(data, np.uint8, offset=16).reshape(columns + 1, 8, n)
    out = [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, each column summed over equal keys."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return [keys[first], *[np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns]]


def packed(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> pd.DataFrame:
    """One row (bucket, blob) for every bucket that sorted ``keys`` reach."""
    cuts = np.searchsorted(bucket_of(keys, bits), np.arange((1 << bits) + 1))
    full = [b for b in range(1 << bits) if cuts[b] < cuts[b + 1]]
    return pd.DataFrame({"bucket": full, "blob": [pack(keys[cuts[b] : cuts[b + 1]], *[c[cuts[b] : cuts[b + 1]] for c in columns]) for b in full]})


def merged(blobs: Iterator[bytes]) -> list[np.ndarray]:
    """The blobs of one bucket summed up."""
    parts = [unpack(b) for b in blobs]
    return summed(*[np.concatenate(c) for c in zip(*parts, strict=True)])


def write_bucket(folder: str, bucket: int, keys: np.ndarray, **columns: np.ndarray) -> None:
    put(f"{folder}/{bucket}.keys", keys.astype("<u8").tobytes())
    for name, values in columns.items():
        values = small(values)
        put(f"{folder}/{bucket}.{name}", values.dtype.str.encode().ljust(8) + values.tobytes())


def write_rows(rows: DataFrame, key: str, columns: list[str], folder: str, bits: int) -> int:
    """Write distinct keys (long, taken as unsigned) with their columns; returns the number of rows written."""
    tagged = rows.select(F.shiftrightunsigned(key, 64 - bits).cast("int").alias("bucket"), F.col(key).alias("key"), *columns)
    tagged = tagged.repartition("bucket").sortWithinPartitions("bucket", "key")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, now = [], None

        def close() -> pd.DataFrame:
            part = pd.concat(open_)
            write_bucket(folder, now, part["key"].to_numpy().view(np.uint64), **{c: part[c].to_numpy() for c in columns})
            return pd.DataFrame({"n": [len(part)]})

        for frame in frames:
            for bucket, part in frame.groupby("bucket", sort=True):
                if open_ and bucket != now:
                    yield close()
                    open_ = []
                open_.append(part)
                now = bucket
        if open_:
            yield close()

    return tagged.mapInPandas(work, "n long").agg(F.sum("n")).first()[0] or 0


class HashStore:
    """Reader of one store; arrays are mapped on first use, and pages are shared by all workers of a machine."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.open = folder, bits, {}

    def column(self, bucket: int, name: str) -> np.ndarray | None:
        if (bucket, name) not in self.open:
            path = f"{self.folder}/{bucket}.{name}"
            try:
                if name == "keys":
                    self.open[bucket, name] = np.memmap(path, "<u8", "r")
                else:
                    with open(path, "rb") as f:
                        kind = f.read(8).decode().strip()
                    self.open[bucket, name] = np.memmap(path, kind, "r", offset=8)
            except FileNotFoundError:
                self.open[bucket, name] = None  # no key fell into this bucket
        return self.open[bucket, name]

    def find(self, keys: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For sorted ``keys``: whether each is there, its place in its bucket, and the named columns (0 where it is not)."""
        found, place = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        out = [np.zeros(len(keys), np.int64) for _ in names]
        buckets = bucket_of(keys, self.bits)
        edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            held = self.column(int(buckets[a]), "keys")
            if held is None:
                continue
            at = np.searchsorted(held, keys[a:b])
            at[at == len(held)] = 0
            hit = held[at] == keys[a:b]
            found[a:b], place[a:b] = hit, at
            for o, name in zip(out, names, strict=True):
                o[a:b][hit] = self.column(int(buckets[a]), name)[at[hit]]
        return found, place, out


@functools.lru_cache(maxsize=4)
def store(folder: str, bits: int) -> HashStore:
    return HashStore(folder, bits)
