"""Operator 7: license scans by an exact set-similarity join.

A block contains a template when it has at least THRESHOLD of the template's
distinct words. Blocks are word windows twice as long as the template, one
template length apart, so that any run of a template's length lies whole in
some block. All template words are ordered by their frequency over all
documents (rarest first), and an index leads from each template's first
``size - need + 1`` words to the template and the word's place in it: a block
that meets the threshold holds one of these (prefix filter). A block is the
ordered set of its template words. It is dropped, before anything is counted,
if it has fewer than ``need`` of them (length filter), or if too few are left
behind the first shared word in the block or in the template (positional
filter). The survivors are counted in order, and the count stops once the
rest can't reach ``need``. Every block that passes is given out.

Next to the method, ``base`` labels mark places where a phrase's words stand
consecutively.

Edge cases: null or empty texts have no words, no labels and score 0; rows
are scanned one by one (repeated rows alike); an empty table gives no rows;
extra columns are never read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

THRESHOLD = 0.8

#: label, template text (public license headers and notices).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("mit-notice", "Released under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License"),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double, blocks string")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 text."""
    return WORD.findall(text.lower())


class Template:
    """``order``: the distinct words by global rank, rarest first."""

    def __init__(self, label: str, text: str, rank: dict[bytes, int], threshold: float):
        words = words_of(text.encode())
        self.label, self.span = label, len(words)
        self.order = sorted({rank[w] for w in words})
        self.size = len(self.order)
        self.place = {r: i for i, r in enumerate(self.order)}
        self.need = max(1, -(-round(threshold * self.size * 1000) // 1000))


class Index:
    """Prefix words to (template, place in the template's order)."""

    def __init__(self, templates, frequency: dict[bytes, int], threshold: float):
        vocabulary = {w for _, t in templates for w in words_of(t.encode())}
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
        self.templates = [Template(label, text, self.rank, threshold) for label, text in templates]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(self.templates):
            for place, r in enumerate(template.order[: template.size - template.need + 1]):
                self.prefix.setdefault(r, []).append((t, place))
        self.words = [w for w, r in self.rank.items() if r in self.prefix]
        #: What each filter has turned away.
        self.rejected = {"length": 0, "positional": 0, "count": 0}

    def blocks(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, word behind the last, containment) of every
        block that passes, by label, then place."""
        known = [(i, r) for i, w in enumerate(words) if (r := self.rank.get(w)) is not None]
        candidates = set()
        for i, r in known:
            for t, _ in self.prefix.get(r, ()):
                step = self.templates[t].span
                candidates.update((t, b) for b in (i // step, i // step - 1) if b >= 0)
        out = []
        at = [i for i, _ in known]
        for t, b in sorted(candidates):
            template = self.templates[t]
            first, last = b * template.span, min(len(words), (b + 2) * template.span)
            own = sorted({r for _, r in known[bisect_left(at, first): bisect_left(at, last)]})
            found = self.contained(template, own)
            if found:
                out.append((template.label, first, last, found / template.size))
        return sorted(out)

    def contained(self, template: Template, own: list[int]) -> int:
        """How many of the template's words are among ``own`` (ordered); 0 if
        under ``need``."""
        if len(own) < template.need:
            self.rejected["length"] += 1
            return 0
        shared, place = next((i, template.place[r]) for i, r in enumerate(own) if r in template.place)
        if min(len(own) - shared, template.size - place) < template.need:
            self.rejected["positional"] += 1
            return 0
        found = 0
        for i, r in enumerate(own[shared:], shared):
            if found + len(own) - i < template.need:
                self.rejected["count"] += 1
                return 0
            found += r in template.place
        return found if found >= template.need else 0


def _binary_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
    for doc_id, text in zip(ids, texts):
        yield doc_id, (text.as_py() or b"").lower()


def template_frequency(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Documents of the whole table that hold each template word. The result
    has one row per distinct template word."""
    vocabulary = sorted({w for _, t in templates for w in words_of(t.encode())})

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for _, low in _binary_rows(batch):
                # Cheap test first: a word inside a longer one is settled by the word set.
                maybe = [w for w in vocabulary if w in low]
                if maybe:
                    seen.update(set(maybe).intersection(WORD.findall(low)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    rows = docs.select("doc_id", "text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def license_rows(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document, see OUT. ``score``: the best template
    containment, 1 where a base phrase stands. ``blocks``: label:first
    word:word behind the last of every block that passes, comma-joined."""
    index = Index(templates, template_frequency(docs, templates), threshold)
    edge = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    finders = [(re.compile(rb"(?<!" + edge + rb")" + GAP.join(p.encode().split()) + rb"(?!" + edge + rb")"),
                max(p.encode().split(), key=len), label) for p, label in phrases.items()]

    def scan(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")}
            for doc_id, low in _binary_rows(batch):
                words = WORD.findall(low)
                places, base, begins = [], set(), []
                for regex, must, label in finders:
                    if must in low:
                        found = [m.start() for m in regex.finditer(low)]
                        if found:
                            # One pass over the words, however many places there are.
                            begins = begins or [m.start() for m in WORD.finditer(low)]
                            places += [bisect_left(begins, at) for at in found]
                            base.add(label)
                blocks = index.blocks(words) if any(w in low for w in index.words) else []
                have = {label for label, *_ in blocks}
                score = 1.0 if base else max((share for *_, share in blocks), default=0.0)
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(places, default=None))
                out["last_word"].append(max(places, default=None))
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | have)))
                out["score"].append(score)
                out["blocks"].append(",".join(f"{label}:{a}:{b}" for label, a, b, _ in blocks))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return docs.select("doc_id", "text").mapInArrow(scan, OUT)
