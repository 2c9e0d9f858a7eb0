"""Plain Python versions of the operators, and documents with awkward cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def documents(sf_dir):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]


def odd_documents(first=10_000):
    line = "The same long passage stands here, word for word, in many documents of this table. " * 2
    texts = [
        None, "", " \t\n", "one", "a b c d", "A B C D E", "a b c d e", "\n\n\n", "x\r\n" + line + "\n" + line, line.upper() + "\nÉ " + line,
        " nbsp  stays\x1c in a word\x85", "Ärger ÄRGER ärger\n" * 30, "w " * 60, " ".join(f"word{i}" for i in range(70_000)), "# * $ % & | < >\n" * 20,
        line + "\n" + "\n".join(f"line number {i} of this text" for i in range(50)), "'s 't it's we'll  <|endoftext|> 中文 字 1234 ½ ٣", "MIT License cc by",
    ]
    rows = [(first + i, t, "en", f"s{i % 3}" if i % 5 else None, None) for i, t in enumerate(texts)]
    rows += [(first + 9, f"{line} again, with other words {i} at its end " * 3, "en", "s1", None) for i in range(3)]  # texts of one id
    return rows + [rows[8], rows[8], (None, line, None, None, None), (None, None, None, None, None), (first + 100, line.strip(), "en", "s0", 1), (first + 101, line.strip(), "en", "s0", 1)]


def words(s):
    return WORD.findall(s or "")


def quality(text):
    ws, t = words(text), text or ""
    lines = [x for x in t.split("\n") if words(x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    seen, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            inside |= {i, i + 1, i + 2}
    n = len(ws)
    return n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n, len(lines)


def line_dedup(rows):
    def key(x):
        return lower(x.strip(WHITE))

    first, many = {}, defaultdict(set)
    for d, t, *_ in rows:
        if d is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    many[key(x)].add(d)
    first = {k: min(v) for k, v in many.items() if len(v) > 1}
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or first.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def shingles(text):
    ws = words(lower(text or ""))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def near_duplicates(rows):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    holders = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        if d is not None:
            for g in s:
                holders[g].append(i)
    parent, common = list(range(len(sets))), Counter()
    for ids in holders.values():
        common.update((a, b) for j, a in enumerate(ids) for b in ids[j + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[find(parent, a)] = find(parent, b)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            r = find(parent, i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), None if d is None else least[find(parent, i)], d is None or least[find(parent, i)] == d) for i, (d, s) in enumerate(sets)]


def crc(text):
    return zlib.crc32(str(text).encode())


def fails_quality(text):
    n, chars, symbols, repeated_lines, inside, base_failed, lines = quality(text)
    return base_failed or chars < 2 * n or chars > 25 * n or 10 * symbols > n or 10 * repeated_lines > 6 * lines


def without_repeated_lines(rows):
    """(id, text, ...) with the lines that ``line_dedup`` keeps."""
    def key(x):
        return lower(x.strip(WHITE))

    first = {}
    for d, t, *_ in rows:
        for x in (t or "").split("\n") if d is not None else ():
            if len(key(x)) >= 10:
                first[key(x)] = min(d, first.get(key(x), d))
    return [(d, "\n".join(x for x in (t or "").split("\n") if d is None or first.get(key(x), d) == d), *more) for d, t, *more in rows]


def hashed(*values):
    """Spark's ``xxhash64``: an int is 4 bytes, a tuple of one int a long of 8 bytes; signed."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v[0].to_bytes(8, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little")
        h = xxhash.xxh64_intdigest(data, seed=h)
    return h - 2**64 if h >= 2**63 else h


def target_exponent(tokens, entropy, repeats):
    """The largest exponent that meets the entropy, by plain bisection, or the larger one that the repetition limit asks for."""
    if len(tokens) < 2 or min(tokens) == max(tokens):
        return 1.0

    def share(a):
        z = sum(t**a for t in tokens)
        return -sum(t**a / z * math.log(t**a / z) for t in tokens) / math.log(len(tokens))

    low, high = 0.0, 1.0
    if share(1.0) >= entropy:
        low = 1.0
    for _ in range(60 if low < 1 else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if share(middle) >= entropy else (low, middle)
    return min(max(low, 1 - math.log(repeats) / math.log(max(tokens) / min(tokens)), 0.0), 1.0)


def mixture(rows, entropy, repeats, block_rows, seed=17):
    """(row, weight, epoch) of every draw of the rows (id, text, lang, source, ...)."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((r, len(words(r[1]))))
    tokens = {s: sum(n for _, n in of) for s, of in sources.items()}
    a = target_exponent([t for t in tokens.values() if t], entropy, repeats)
    z = sum(t**a for t in tokens.values() if t)
    given = max((t / t**a for t in tokens.values() if t), default=0.0) * z
    out = []
    for s, of in sources.items():
        t = tokens[s]
        weight = t**a / z if t else 0.0
        epochs = round(weight * given / t, 9) if t else 1.0
        last = math.floor(epochs)
        rest, n_blocks = math.floor((epochs - last) * t), -(-len(of) // block_rows)
        blocks = defaultdict(lambda: defaultdict(list))
        for r, n in of:
            key = "" if r[0] is None else str(r[0])
            blocks[hashed(seed, key) % n_blocks][hashed(seed, (last,), key)].append((r, n))
        spent, more = 0, []
        for b in sorted(blocks, key=lambda b: (hashed(seed, (last,), (b,)), b)):
            if spent >= rest:
                break
            for draw in sorted(blocks[b]):  # equal rows are drawn alike
                spent += sum(n for _, n in blocks[b][draw])
                if spent > rest:
                    break
                more += [r for r, _ in blocks[b][draw]]
        out += [(r, weight, e) for r, _ in of for e in range(last)] + [(r, weight, last) for r in more]
    return out
