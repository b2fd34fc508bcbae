"""Operator 10: benchmark decontamination by pigeonhole edit matching.

A passage within k edits of an item holds at least one of the item's k + 1
pieces unchanged. The pieces of all items are searched at once in every text
(Aho-Corasick), each hit fixes where the item would lie, and Myers'
bit-parallel distance decides whether it is there within k edits.

Texts are compared in lower case with runs of white space as one blank. k is
EDIT_SHARE of the item's length. Items run in hashed blocks of BLOCK_BYTES of
text (a longer item is a block of its own). The driver holds one block at a
time: with several, each one's findings are written before the next block is
read, so what the driver keeps and a task is sent is bounded whatever the
number of items. Each block is one pass over the documents.

Edge cases: null or empty texts match nothing, of documents and of items; an
item with a text but a null id is an item like others, its rows have the null
id; items of fewer than SHORT characters are matched unchanged as whole words
only; repeated items each get their rows (equal ones are searched once); repeated documents too; extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import free_name, materialize
from billbook.llm.lexical import blocks_of

EDIT_SHARE = 0.06
SHORT = 32
#: Bytes of item text in a block; its automaton takes some 60 times as much.
BLOCK_BYTES = 1 << 21

OUT = "doc_id long, item_id long, distance int, n_places int, place long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int, share: float = EDIT_SHARE) -> int:
    return 0 if length < SHORT else max(2, int(length * share))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of near-equal length."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance of ``pattern`` to a substring
    of ``text`` and where the first such substring ends."""
    m = len(pattern)
    if not m:
        return 0, 0
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(diagonal | up)
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = (fall | ~(diagonal | rise)) & full
        down = rise & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """The pieces of one block of items in an automaton."""

    def __init__(self, items: list[tuple[int | None, str, int]], share: float = EDIT_SHARE):
        self.items = [(i, normal(t), copies) for i, t, copies in items]
        self.items = [item for item in self.items if item[1]]
        self.k = [budget(len(t), share) for _, t, _ in self.items]
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for number, (_, t, _) in enumerate(self.items):
            for offset, piece in pieces(t, self.k[number]):
                where.setdefault(piece, []).append((number, offset))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), tuple(places)))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    @staticmethod
    def alone(text: str, begin: int, n: int) -> bool:
        """No letter or digit touches text[begin:begin + n]."""
        return not (text[max(0, begin - 1): begin].isalnum() or text[begin + n: begin + n + 1].isalnum())

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, places, first place) of the items in a
        normalised text."""
        if self.empty or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            begin = end - size + 1
            for number, offset in places:
                starts.setdefault(number, set()).add(begin - offset)
        out = []
        for number, guesses in starts.items():
            item_id, item, copies = self.items[number]
            k, n = self.k[number], len(item)
            best, count, first, last_end = None, 0, 0, -1
            ordered = sorted(guesses)
            i = 0
            while i < len(ordered):
                # Guesses within k of each other look at one stretch of text.
                j = i
                while j + 1 < len(ordered) and ordered[j + 1] - ordered[j] <= k:
                    j += 1
                lo, hi = max(0, ordered[i] - k), min(len(text), ordered[j] + n + k)
                size, i = j + 1 - i, j + 1
                if hi <= last_end:
                    continue
                exact = next((g for g in ordered[i - size: i] if g >= 0 and text.startswith(item, g)), None)
                if exact is not None and (k or self.alone(text, exact, n)):
                    distance, end = 0, exact + n
                elif k:
                    distance, end = myers(item, text[lo:hi])
                    end += lo
                else:
                    continue
                if distance <= k:
                    place = max(0, end - n)
                    if best is None or distance < best:
                        best = distance
                    first = place if not count else first
                    count += 1
                    last_end = end
            if count:
                out += [(item_id, best, count, first)] * copies
        return sorted(out, key=lambda m: (m[0] is None, m[0] or 0, *m[1:]))


def item_blocks(benchmark: DataFrame, limit: int) -> tuple[int, Iterator[list[tuple[int | None, str, int]]]]:
    """How many blocks there are, and (item_id, text, copies) of one after the
    other; empty ones are left out."""
    items = benchmark.filter("text is not null").groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    items = items.withColumn("item_hash", F.xxhash64("item_id", "text"))
    blocks = blocks_of(items, limit)

    def read(b: int) -> list[tuple[int | None, str, int]]:
        own = items.filter(F.pmod("item_hash", F.lit(blocks)) == b).orderBy("item_id", "text")
        return [(r["item_id"], r["text"], r["copies"]) for r in own.collect()]  # ``limit`` bytes

    return blocks, (own for own in map(read, range(blocks)) if own or blocks == 1)


def leak_rows(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, limit: int = BLOCK_BYTES) -> DataFrame:
    """One row per (document, item) within the item's budget: the least
    distance, how many places, and where the first stands in the normalised
    text."""
    blocks, each = item_blocks(benchmark, limit)
    out = None
    for items in each:

        def scan(batches, items=items):
            matcher = Matcher(items, share)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    rows += [(doc_id, *m) for m in matcher.find(normal(text.as_py()))]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["doc_id", "item_id", "distance", "n_places", "place"])

        found = docs.select("doc_id", "text").mapInArrow(scan, OUT)
        if blocks > 1:  # written, so that a block's items are let go before the next one's come
            found = materialize(found, "leaks")
        out = found if out is None else out.unionAll(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, limit: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds an item. One block: the texts
    are filtered where they are read, nothing is shuffled. Several: each block
    writes the digests of the texts it finds, and these texts go."""
    blocks, each = item_blocks(benchmark, limit)
    where = docs.columns.index("text")
    if blocks == 1:
        items = next(each)

        def keep(batches):
            matcher = Matcher(items, share)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.find(normal(t.as_py())) for t in batch.column(where)], pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)
    digest, leaks = free_name(docs, "digest"), None
    for items in each:

        def digests(batches, items=items):
            matcher = Matcher(items, share)
            for batch in batches:
                texts = (t.as_py() for t in batch.column(0))
                found = {hashlib.sha256(t.encode()).hexdigest() for t in texts if matcher.find(normal(t))}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=[digest])

        found = materialize(docs.select("text").mapInArrow(digests, f"{digest} string").distinct(), "leaked-texts")
        leaks = found if leaks is None else leaks.unionAll(found)
    return docs.join(leaks, F.sha2(docs["text"].cast("binary"), 256) == leaks[digest], "left_anti")
