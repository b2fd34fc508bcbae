"""Operator 12: ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items go into one automaton, each with a boundary on both
sides; the documents' bytes are mapped so that every separator is that
boundary, and one pass over a text then counts every term's occurrences, with
no index of the documents. Terms lead to the items that hold them.

Two scans: the first counts N, L and the documents of each term; the second
scores, and each task keeps only its best documents of every item.

The documents are never indexed, shuffled or collected. Items run in hashed
blocks of BLOCK_BYTES of text at most (an item longer than that has a block
to itself), one block at a time: the driver and the tasks hold one block's
terms whatever the number of items.

Edge cases: null or empty texts have no terms, they neither count in N nor are
found; items without terms have no rows; equal items (id and text) are one,
items that share only the id are ranked one by one; repeated documents are
each a document; a null doc_id comes after all others of its score; an empty
table of either kind gives no rows; extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.llm.common import LOWER_TABLE, materialize, row_chunks, text_bytes

#: What may not stand in a term, as a Java expression.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANK = 0x20
BLOCK_BYTES = 1 << 21
TOP = 10
#: Documents scored at a time: bounds the (documents x items) scores.
CELLS = 1 << 20
#: Longer texts are scanned in stretches that end between two terms.
STRETCH = 1 << 20

#: Term bytes as they are, A-Z lower-cased; every separator a blank.
TERM_TABLE = LOWER_TABLE.copy()
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    TERM_TABLE[_low: _high + 1] = BLANK


def terms_of(text: Column) -> Column:
    """The distinct terms of a text; null has none."""
    upper = "".join(chr(c) for c in range(65, 91))
    low = F.translate(text, upper, upper.lower())
    return F.array_distinct(F.filter(F.split(F.coalesce(low, F.lit("")), SEPARATORS, -1), lambda x: x != ""))


class Terms:
    """The automaton over one block's terms."""

    def __init__(self, items: list[list[str]]):
        self.words = sorted({t for own in items for t in own})
        number = {t: i for i, t in enumerate(self.words)}
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            self.automaton.add_word(f" {t} ", i)
        self.automaton.make_automaton()
        # Which items hold a term: items[first[t]: first[t + 1]].
        pairs = sorted((number[t], i) for i, own in enumerate(items) for t in own)
        self.items = np.array([i for _, i in pairs], dtype=np.int64)
        self.first = np.searchsorted([t for t, _ in pairs], np.arange(len(self.words) + 1))

    def count(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, occurrences) in one text's mapped bytes."""
        found = [np.fromiter((i for _, i in self.automaton.iter(part)), dtype=np.int64) for part in stretches(data)]
        return np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)


def stretches(data: np.ndarray) -> Iterator[str]:
    """Mapped bytes as strings that begin and end with a blank; no term is cut."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + STRETCH)
        while end < len(data):
            gap = np.flatnonzero(data[end: end + STRETCH] == BLANK)
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + STRETCH)
        yield f" {data[begin:end].tobytes().decode()} "
        begin = end


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Terms, with repeats, of each row of mapped bytes."""
    inside = data != BLANK
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = offsets[:-1]
    at = rows[rows < len(data)]
    begins[at] = inside[at]  # a row's first byte starts a term whatever stands before it
    return np.diff(np.concatenate(([0], np.cumsum(begins)))[offsets])


def _mapped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return TERM_TABLE[data], offsets


def corpus_counts(docs: DataFrame, items: list[list[str]]) -> tuple[int, int, dict[str, int]]:
    """N, L, and the documents of each of the items' terms: the sums of one
    row per task and term."""
    def count(batches):
        terms = Terms(items)
        holding, n_docs, n_terms = np.zeros(len(terms.words), dtype=np.int64), 0, 0
        for batch in batches:
            data, offsets = _mapped(batch.column(0))
            own = term_counts(data, offsets)
            n_docs, n_terms = n_docs + int((own > 0).sum()), n_terms + int(own.sum())
            for i in np.flatnonzero(own):
                holding[terms.count(data[offsets[i]: offsets[i + 1]])[0]] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", " ", *(terms.words[i] for i in some)], pa.string()),
             pa.array([n_docs, n_terms, *holding[some].tolist()], pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.toLocalIterator()}  # a row per term of the block
    return found.pop("", 0), found.pop(" ", 0), found


class Best:
    """The TOP best documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, dtype=np.int64)  # scores above 0 only
        self.rows = [np.zeros(0, dtype=np.int64)] * 4  # item, score, doc is null, doc

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        new = [item, scores[row, item], null[row], doc[row]]
        item, score, null, doc = (np.concatenate(c) for c in zip(self.rows, new))
        order = np.lexsort((doc, null, -score, item))
        item, score, null, doc = item[order], score[order], null[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.top
        self.rows = [c[keep] for c in (item, score, null, doc)]
        full = place == self.top - 1
        self.least[item[full]] = score[full]


def score_block(docs: DataFrame, ids: list[int | None], items: list[list[str]], top: int) -> DataFrame:
    """(item, item_id, doc_id, score): the ``top`` best of every task."""
    n_docs, n_terms, holding = corpus_counts(docs, items)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in holding.items()}

    def score(batches):
        terms = Terms(items)
        w = np.array([weight.get(t, 0) for t in terms.words], dtype=np.int64)
        best = Best(len(items), top)
        for batch in batches:
            data, offsets = _mapped(batch.column(1))
            null = np.asarray(batch.column(0).is_null()).astype(np.int64)
            doc = batch.column(0).fill_null(0).to_numpy()
            n = term_counts(data, offsets)
            m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
            step = max(1, CELLS // len(items))
            for a in range(0, len(doc), step):
                b = min(len(doc), a + step)
                scores = np.zeros((b - a, len(items)), dtype=np.int64)
                found = [terms.count(data[offsets[i]: offsets[i + 1]]) for i in range(a, b)]
                row = np.repeat(np.arange(b - a), [len(t) for t, _ in found])
                term, tf = (np.concatenate(c) for c in zip(*found))
                part = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[a + row]))
                # Each (document, term) goes to every item that holds the term.
                many = terms.first[term + 1] - terms.first[term]
                begin = np.repeat(terms.first[term] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
                item = terms.items[begin + np.arange(many.sum())]
                np.add.at(scores.ravel(), np.repeat(row * len(items), many) + item, np.repeat(part, many))
                best.add(scores, doc[a:b], null[a:b])
        item, points, null, doc = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array([ids[i] for i in item], pa.int64()),
             pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(points)], names=["item", "item_id", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "item long, item_id long, doc_id long, score long")


def blocks_of(items: DataFrame, limit: int = BLOCK_BYTES) -> int:
    """A number of hashed blocks of which none with two items or more has over
    ``limit`` bytes of text."""
    sized = items.select("item_hash", F.octet_length("text").alias("size"))
    blocks = max(1, -(-(sized.agg(F.sum("size")).first()[0] or 0) // limit))
    while True:
        loads = sized.groupBy(F.pmod("item_hash", F.lit(blocks))).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        if not loads.filter((F.col("n") > 1) & (F.col("size") > limit)).head(1):
            return blocks
        blocks *= 2


def ranked_search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, limit: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item."""
    items = benchmark.select("item_id", "text", terms_of(F.col("text")).alias("terms")).filter("size(terms) > 0").distinct()
    items = items.withColumn("item_hash", F.xxhash64("item_id", "text"))
    blocks = blocks_of(items, limit)
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod("item_hash", F.lit(blocks)) == b).select("item_id", "terms").collect()  # ``limit`` bytes
        if not own:
            continue
        found = score_block(docs, [r["item_id"] for r in own], [list(r["terms"]) for r in own], top)
        best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = (found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
                  .select("item_id", "rank", "doc_id", "score"))
        if blocks > 1:  # written, so that a block's terms are let go before the next one's come
            ranked = materialize(ranked, "ranked")
        out = ranked if out is None else out.unionAll(ranked)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


#: The same ranking in DuckDB SQL.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY r, doc_id, term),
n AS (SELECT r, sum(tf) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weighted AS (
  SELECT item.item_id, item.text, item.term,
         CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM item JOIN df USING (term) CROSS JOIN total),
scored AS (
  SELECT weighted.item_id, weighted.text, tf.r, tf.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) AS score
  FROM weighted JOIN tf USING (term) JOIN n USING (r) CROSS JOIN total
  GROUP BY weighted.item_id, weighted.text, tf.r, tf.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
