"""Packing of token sequences by column generation for the cutting-stock problem."""

from __future__ import annotations

import functools
import sys
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.shared import as_id, run_dir, written
from recspark.llm.spans import chunks, pretokens, span_hashes
from recspark.llm.token_counts import tokenizer_path

CAPACITY = 2048
END_ID = 1
CLASSES = 256  # length classes of the linear program; a class is as long as its longest piece
GAP = 0.002  # the program is solved when its value is this near to its lower bound
ROUNDS, PIVOTS = 60, 600  # of pricing, and of the simplex after each; the patterns found by then are used
CENTRED = 0.7
CACHE = 300_000  # pre-tokens whose ids a worker keeps
RANKED = 100_000  # pieces that are numbered together

_ids: dict[int, bytes] = {}


def _letters() -> np.ndarray:
    """What byte-level models write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    out = np.arange(256)
    other = (out < 33) | ((out > 126) & (out < 161)) | (out == 173)
    out[other] = 256 + np.arange(other.sum())
    return out.astype("<u2")


@functools.cache
def _encoder(path: str):
    """Function from pre-tokens to the bytes of their ids; one per worker process and file.

    The model alone is asked where the library's pre-tokenizer does no more than write bytes as letters, which is tried
    out on many characters; it is several times faster than a whole encoding for each pre-token.
    """
    cutter, letters = pretokens(path), _letters()
    tokenizer, tokenize = cutter.tokenizer, cutter.tokenizer.model.tokenize
    tried = "".join(map(chr, [*range(1, 0x500), *range(0x3000, 0x3100), *range(0x1F600, 0x1F620)]))

    def written_out(pieces: list[str]) -> list[str]:
        data = [p.encode() for p in pieces]
        text = letters[np.frombuffer(b"".join(data), np.uint8)].tobytes().decode("utf-16-le")
        ends = np.cumsum([len(d) for d in data]).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def of(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def whole(pieces: list[str]) -> list[bytes]:
        return [of(e.ids) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    cut = cutter.cut(tried)
    if tokenizer.normalizer is not None or written_out([tried[a:b] for _, (a, b) in cut]) != [name for name, _ in cut]:
        return whole

    def by_model(pieces: list[str]) -> list[bytes]:
        out = [array("I", [t.id for t in tokenize(p)]).tobytes() for p in written_out(pieces)]
        if cutter.added:
            for i, p in enumerate(pieces):
                if cutter.added.search(p):
                    out[i] = whole([p])[0]
        return out

    return by_model if array("I").itemsize == 4 and sys.byteorder == "little" else whole


def _encode(cutter, joined: str, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Ids of the distinct pre-tokens, encoded once while they stay in the worker's cache."""
    if len(_ids) > CACHE:
        _ids.clear()
    names = keys.tolist()
    new = [i for i, k in enumerate(names) if k not in _ids]
    at, to = starts[new].tolist(), ends[new].tolist()
    for i, ids in zip(new, _encoder(cutter.path)([joined[a:b] for a, b in zip(at, to, strict=True)]), strict=True):
        _ids[names[i]] = ids
    return [_ids[k] for k in names]


def token_ids(cutter, texts: list[str]) -> list[np.ndarray]:
    """Ids of every text as the library gives them."""
    joined, codes, starts, ends, counts = cutter.spans(texts)
    keys, first, back = np.unique(span_hashes(codes, starts, ends), return_index=True, return_inverse=True)
    parts = _encode(cutter, joined, keys, starts[first], ends[first])
    flat = np.frombuffer(b"".join(parts), "<u4")
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    offsets = np.cumsum(sizes) - sizes
    n = sizes[back]
    done = np.cumsum(n) - n
    ids = flat[np.repeat(offsets[back] - done, n) + np.arange(n.sum())] if len(n) else flat
    cuts = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)]
    return np.split(ids, cuts[:-1])


def _pieces(path: str, capacity: int, end_id: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, end = pretokens(path), np.array([end_id], "<u4")
        for rows, texts in chunks(frames, "text"):
            out = defaultdict(list)
            for doc, ids in zip(rows["doc_id"], token_ids(cutter, texts), strict=True):
                ids = np.concatenate([ids, end])
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    for k, v in (("doc_id", doc), ("start", at), ("length", len(piece)), ("ids_crc32", zlib.crc32(piece.tobytes())), ("doc_tokens", len(ids))):
                        out[k].append(v)
            yield pd.DataFrame(out)

    return work


def classes_of(histogram: dict[int, int], limit: int = CLASSES) -> dict[int, int]:
    """Length -> class size (the longest length of its class); classes hold about equally many pieces."""
    lengths = sorted(histogram)
    if len(lengths) <= limit:
        return {x: x for x in lengths}
    counts = np.array([histogram[x] for x in lengths], float)
    group = np.floor((np.cumsum(counts) - counts / 2) * limit / counts.sum()).astype(int)
    longest = {g: x for g, x in zip(group.tolist(), lengths, strict=True)}
    return {x: longest[g] for g, x in zip(group.tolist(), lengths, strict=True)}


def price(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The worth of the best pattern, and the best patterns with each of the classes, best first.

    An unbounded knapsack by dynamic programming over the capacity answers for all of them.
    """
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            gain = best[c - sizes[:k]] + worth[:k]
            i = int(gain.argmax())
            if gain[i] > best[c] + 1e-12:
                best[c], take[c] = gain[i], i
    out = np.zeros((len(sizes), len(sizes)))
    order = np.argsort(-(worth + best[capacity - sizes]), kind="stable")
    for pattern, first in zip(out, order, strict=True):
        pattern[first] = 1
        c = capacity - sizes[first]
        while c > 0:
            if take[c] < 0:
                c -= 1
            else:
                pattern[take[c]] += 1
                c -= sizes[take[c]]
    return best[capacity], out


def generate_columns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns (pieces of each class) and how often each is used, by the revised simplex method.

    Columns are priced at a mean of the program's dual values and the best ones so far (those with the highest lower
    bound, at first the sizes themselves), which keeps the values from swinging; then the program is solved over all
    columns found. Those are kept once, in whole numbers, and as floats for the round they are priced in.
    """
    full = capacity // sizes
    columns, inverse, used = list(np.diag(full).astype(float)), np.diag(1.0 / full), demand / full
    centre, known, pool = sizes / capacity, set(), None
    bound = centre @ demand
    # bytes of unsigned big-endian numbers compare as the numbers do
    kind = np.min_scalar_type(capacity).newbyteorder(">")
    for _ in range(ROUNDS):
        if used.sum() <= bound * (1 + GAP):
            break
        dual = inverse.sum(axis=0)
        for share in (CENTRED, 0.0):
            worth = share * centre + (1 - share) * dual
            value, found = price(sizes, worth, capacity)
            if value > 0 and worth @ demand / value > bound:
                centre, bound = worth / value, worth @ demand / value
            if (found @ dual).max() > 1 + 1e-7:
                break
        else:
            break  # no column improves the program
        known.update(row.tobytes() for row in found.astype(kind))
        pool = None  # the rows of the round before go first
        pool = np.frombuffer(b"".join(sorted(known)), kind).reshape(-1, len(sizes)).astype(float)
        for _ in range(PIVOTS):
            gain = pool @ inverse.sum(axis=0)
            pattern = pool[int(gain.argmax())]
            if gain.max() <= 1 + 1e-7:
                break
            direction = inverse @ pattern
            rises = np.flatnonzero(direction > 1e-9)
            row = rises[np.argmin(used[rises] / direction[rises])]
            step = used[row] / direction[row]
            used = np.maximum(used - step * direction, 0)
            used[row] = step
            pivot = inverse[row] / direction[row]
            inverse -= np.outer(direction, pivot)
            inverse[row] = pivot
            columns[row] = pattern.copy()  # a view would hold this round's whole pool
    return list(zip(columns, used, strict=True))


def plan(histogram: dict[int, int], capacity: int = CAPACITY, limit: int = CLASSES) -> tuple[dict[int, int], list[tuple[dict[int, int], int]]]:
    """Class of every length, and patterns {class: pieces} with the number of sequences each is used for.

    Uses are rounded down; the few pieces left over are put best-fit, longest first.
    """
    if not histogram:
        return {}, []
    klass = classes_of(histogram, limit)
    left = Counter()
    for x, n in histogram.items():
        left[klass[x]] += n
    sizes = np.array(sorted(left))
    out = []
    for column, used in sorted(generate_columns(sizes, np.array([left[s] for s in sizes.tolist()], float), capacity), key=lambda p: -p[1]):
        pattern = {int(s): int(a) for s, a in zip(sizes, column, strict=True) if a}
        n = int(min(np.floor(used + 1e-6), min(left[s] // a for s, a in pattern.items())))
        if n > 0:
            out.append((pattern, n))
            for s, a in pattern.items():
                left[s] -= n * a
    bins: dict[int, list[Counter]] = defaultdict(list)
    for s in sorted(left, reverse=True):
        for _ in range(left[s]):
            room = next((r for r in range(s, capacity + 1) if bins.get(r)), None)
            held = bins[room].pop() if room is not None else Counter()
            held[s] += 1
            bins[(capacity if room is None else room) - s].append(held)
    rest = Counter(tuple(sorted(b.items())) for held in bins.values() for b in held)
    return klass, out + [(dict(p), n) for p, n in sorted(rest.items())]


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and an end id (a null text: the end id alone); longer ones are cut into full sequences and a
    rest. Only the histogram of lengths, at most ``capacity`` rows, comes to the driver; the patterns, at most a few
    thousand, go out as a broadcast table. Pieces of a class are numbered in parts of about ``RANKED``, so a frequent length
    spreads over many tasks, and a number says sequence and slot. Rows that repeat an id are packed each.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "packing")
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = written(base.mapInPandas(_pieces(tokenizer or tokenizer_path(), capacity, end_id), schema), folder, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    klass, patterns = plan(histogram, capacity)
    rows, ranks, sequence = [], Counter(), 0
    for pattern, n in patterns:
        for s, a in pattern.items():
            rows.append((s, ranks[s], ranks[s] + a * n, sequence, a))
            ranks[s] += a * n
        sequence += n
    lengths = spark.createDataFrame(sorted(klass.items()), "length long, class long")
    slots = spark.createDataFrame(rows, "class long, low long, high long, first long, each long")
    parts = max(1, -(-sum(histogram.values()) // RANKED))
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts))
    tagged = pieces.join(F.broadcast(lengths), "length").withColumn("part", part)
    sizes = tagged.groupBy("class", "part").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("class").orderBy("part")) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("class", "part").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = tagged.withColumn("number", number).join(sizes, ["class", "part"]).withColumn("rank", F.col("before") + F.col("number"))
    s = F.broadcast(slots.withColumnRenamed("class", "of"))
    placed = ranked.join(s, (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each")).cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")
    return placed.select(as_id(docs, id_col, "doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"))
