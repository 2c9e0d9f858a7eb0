"""Vectorised cutting and hashing of words and pre-tokens, for use inside tasks."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd

CHUNK_CHARS = 1 << 20  # texts handled at a time; a longer text is a chunk of its own
TABLE_LIMIT = 0x3000  # code points with a class table; texts with higher ones take the library's own pre-tokenizer

_ODD = 0x9E3779B97F4A7C15
_A, _B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_B)
    x ^= x >> np.uint64(31)
    return x


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = x.astype(np.uint64, copy=True)
    x ^= (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x *= np.uint64(pow(_B, -1, 1 << 64))
    x ^= (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x *= np.uint64(pow(_A, -1, 1 << 64))
    x ^= (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _ODD, np.uint64)
    down = np.full(n + 1, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span ``codes[start:end]``; equal spans have equal hashes wherever they stand."""
    size = 1 << max(int(len(codes)).bit_length(), 20)
    up, down = _powers(size)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(_ODD)) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_A))


def chunks(frames: Iterator[pd.DataFrame], text: str) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Rows with their texts (null: empty), so many at a time that arrays over their characters stay small."""
    for frame in frames:
        texts = ["" if t is None else t for t in frame[text]]
        ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0)
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, "right")))
            yield frame.iloc[at:to], texts[at:to]
            at = to


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order (A-Z lower-cased), and the number of words of each text."""
    data = [t.encode().lower() for t in texts]
    sizes = np.array([len(d) + 1 for d in data], np.int64)
    codes = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    solid = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edges = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    row = np.searchsorted(np.cumsum(sizes), starts, "right")
    return span_hashes(codes, starts, ends), np.bincount(row, minlength=len(texts))


class PreTokens:
    """Pre-tokens as the byte-level pre-tokenizer of a ``tokenizers`` file cuts them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.path, self.tokenizer = path, Tokenizer.from_file(path)
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    @functools.cached_property
    def classes(self) -> np.ndarray:
        """0 white space, 1 letter, 2 number, 3 other: asked from the library, by what a character joins with."""
        out = np.zeros(TABLE_LIMIT, np.uint8)
        for c in range(TABLE_LIMIT):
            for k, with_ in ((1, "a"), (2, "1"), (3, "!")):
                if len(self.cut(with_ + chr(c))) == 1:
                    out[c] = k
        return out

    def spans(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined text, its code points, start and end of every pre-token, and the number of pre-tokens of each text."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        high = np.flatnonzero(codes >= TABLE_LIMIT)
        slow = set((np.searchsorted(offsets, high, "right") - 1).tolist())
        if self.added:
            slow |= {i for i, t in enumerate(texts) if self.added.search(t)}
        start = self._starts(np.where(codes < TABLE_LIMIT, codes, 0), offsets[:-1][lengths > 0])
        for i in slow:
            a = offsets[i]
            start[a : offsets[i + 1]] = False
            start[[a + s for s in self._library(texts[i])]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(codes))
        return joined, codes, starts, ends, np.diff(np.searchsorted(starts, offsets))

    def _library(self, text: str) -> list[int]:
        at, out = 0, []
        for found in [*(self.added.finditer(text) if self.added else ()), None]:
            end = found.start() if found else len(text)
            out += [at + s for _, (s, e) in self.cut(text[at:end]) if e > s] if end > at else []
            if found:
                out.append(end)
                at = found.end()
        return sorted(set(out))

    def _starts(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Where a pre-token starts: at a change of class, a single space going with what follows it."""
        n = len(codes)
        start = np.zeros(n, bool)
        if not n:
            return start
        kind = self.classes[codes]
        first = np.zeros(n + 1, bool)
        first[texts] = first[n] = True
        change = first[:n].copy()
        change[1:] |= kind[1:] != kind[:-1]
        a = np.flatnonzero(change)
        b = np.append(a[1:], n)
        k = kind[a]
        start[a] = True
        more = ~first[b]  # a run of the same text follows
        white = np.flatnonzero((k == 0) & more)
        joins = codes[b[white] - 1] == 32
        start[b[white] - 1] = True
        start[b[white][joins]] = False
        # contractions: a lone apostrophe that starts a pre-token, then letters
        lone = np.flatnonzero((k == 3) & (b - a == 1) & (codes[a] == 39) & more & start[a])
        lone = lone[(lone + 1 < len(a))]
        lone = lone[k[lone + 1] == 1]
        c = codes[a[lone] + 1]
        long = b[lone + 1] - a[lone + 1] >= 2
        d = np.where(long, codes[np.minimum(a[lone] + 2, n - 1)], 0)
        one = np.isin(c, [ord(x) for x in "stmd"])
        two = ((c == ord("r")) & (d == ord("e"))) | ((c == ord("v")) & (d == ord("e"))) | ((c == ord("l")) & (d == ord("l")))
        takes = np.where(one, 1, np.where(two, 2, 0))
        at, takes, end = a[lone][takes > 0], takes[takes > 0], b[lone + 1][takes > 0]
        start[at + 1] = False
        inside = at + 1 + takes < end
        start[(at + 1 + takes)[inside]] = True
        return start


@functools.cache
def pretokens(path: str) -> PreTokens:
    """One per worker process and file."""
    return PreTokens(path)
