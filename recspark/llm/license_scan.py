"""Licence scans with a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.shared import as_id

# Phrases that give a label by themselves.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of well-known licences with the phrases that must stand in a match.
TEMPLATES = {
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted"]),
    "apache-2.0": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ["apache license"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source"]),
    "gpl": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["general public license"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["released into the public domain"]),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    "cc-by-sa": ("this work is licensed under a creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
}

# Short notices, by the label they give.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("gpl", "licensed under the gnu general public license version 3", ["general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("bsd", "released under the bsd license", ["bsd license"]),
    ("mpl-2.0", "licensed under the mozilla public license version 2 0", ["mozilla public license"]),
]

SHARE = 0.6  # of a template's weight that a match must hold
SLACK = 3  # words inserted or left out that a match may shift by

# A-Z become a-z; digits, a-z and everything beyond ASCII stay; the rest separates words
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _split(text: str) -> list[bytes]:
    return [w.encode() for w in text.split()]


class Index:
    """Postings of the templates' words, with the words' weights."""

    def __init__(self, weights: dict[str, float]):
        self.weights = {w.encode(): x for w, x in weights.items()}
        known = [(label, t, keys) for label, (t, keys) in TEMPLATES.items()] + NOTICES
        self.labels = [label for label, _, _ in known]
        self.templates = [_split(t) for _, t, _ in known]
        self.phrases = [[_split(p) for p in keys] for _, _, keys in known]
        self.base = [(_split(p), label) for p, label in BASE.items()]
        self.vocabulary = {w for t in self.templates for w in t} | {w for p, _ in self.base for w in p}
        self.postings = defaultdict(list)
        for name, t in enumerate(self.templates):
            # the rarer half of each template's words, so that a licence found everywhere has entries too
            ranked = sorted(set(t), key=lambda w: (-self.weights.get(w, 0.0), w))
            rare = set(ranked[: -(-len(ranked) // 2)])
            for at, w in enumerate(t):
                if w in rare:
                    self.postings[w].append((name, at))
        self.total = [sum(self.weights.get(w, 0.0) for w in t) for t in self.templates]

    def scan(self, ws: list[bytes]) -> tuple[int, int | None, int | None, str, str, float]:
        at = [i for i, w in enumerate(ws) if w in self.vocabulary]
        places, labels, base = [], set(), set()
        for phrase, label in self.base:
            for i in at:
                if ws[i] == phrase[0] and ws[i : i + len(phrase)] == phrase:
                    places.append(i)
                    base.add(label)
        score = 1.0 if places else 0.0
        votes = defaultdict(Counter)
        for i in at:
            for name, pos in self.postings.get(ws[i], ()):
                votes[name][i - pos] += 1
        for name, offsets in votes.items():
            template = self.templates[name]
            near = {o: sum(offsets.get(x, 0) for x in range(o - SLACK, o + SLACK + 1)) for o in offsets}
            for offset in sorted(near, key=lambda o: (-near[o], -offsets[o], o)):
                if near[offset] < 2:
                    break  # one word alone in place
                window = ws[max(offset - SLACK, 0) : max(offset, 0) + len(template) + SLACK]
                held = sum(self.weights.get(w, 0.0) for pos, w in enumerate(template) if w in ws[max(offset + pos - SLACK, 0) : max(offset + pos + SLACK + 1, 0)])
                share = held / self.total[name] if self.total[name] else 0.0
                if share >= SHARE and all(self._holds(window, p) for p in self.phrases[name]):
                    labels.add(self.labels[name])
                    score = max(score, min(share, 1.0))
                    break
        return len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score

    @staticmethod
    def _holds(ws: list[bytes], phrase: list[bytes]) -> bool:
        return any(ws[i : i + len(phrase)] == phrase for i in range(len(ws) - len(phrase) + 1))


def vocabulary() -> set[str]:
    return {w for t in [*(t for t, _ in TEMPLATES.values()), *(t for _, t, _ in NOTICES)] for w in t.split()}


def _frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known, seen = {w.encode() for w in vocabulary()}, Counter()
    for frame in frames:
        for text in frame["text"]:
            if text is not None:
                seen.update(known & set(words(text)))
    if seen:  # pandas has no type for an empty column of texts
        yield pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())})


def word_weights(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Inverse document frequency of the licence words over all rows; the vocabulary is fixed, so this is a small table."""
    texts = docs.select(F.col(text).alias("text"))
    found = {r.word: r.n for r in texts.mapInPandas(_frequencies, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = docs.count()
    return {w: math.log((rows + 1) / (found.get(w, 0) + 1)) + 1e-6 for w in vocabulary()}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    One pass counts in how many texts each licence word stands; a second one looks up every text's rare licence words in
    the index, adds up relative positions, and verifies the best ones by share of weight and by key phrases. A null text
    is empty. Texts stay where they are. Ids are handed through as they are; repeated rows have a row each.
    """
    weights = word_weights(docs, text)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(weights)
        for frame in frames:
            out = []
            for doc, t in zip(frame["doc_id"], frame["text"], strict=True):
                ws = words(t or "")
                out.append((doc, len(ws), *index.scan(ws)))
            part = pd.DataFrame(out, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
            yield part.astype({"first_word": "Int64", "last_word": "Int64"})

    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return base.mapInPandas(work, schema).withColumn("doc_id", as_id(docs, id_col, "doc_id"))
