"""Operator 13: audit of how five filters act on each other.

The document-term matrix decides the first two. Each task turns a bounded
stretch of documents into a CSR shard over its own words; the words of all
shards get global numbers from one dictionary (dealt out and sorted by word;
a word comes once per shard, however often it occurs), and each shard's
columns are renumbered. A document's words are then its row's sum, its
distinct words the row's number of nonzero columns.

Capitals, marks and a digest of the text are taken in the same pass. Equal
texts are found by digest; documents are counted by part and pattern of failed
filters, at most 32 rows a part, and the 120 orders are played on those counts.

Edge cases: a null text is empty; a null source is the part ''; a document is a
repeat if an equal text has a smaller doc_id (a null doc_id is neither smaller
nor larger than any); rows that share doc_id and text count one by one;
documents without a label lose neither good nor toxic ones, and of several
labels of one doc_id the greatest counts; an empty table gives no rows;
extra columns are never read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import SPACE_TABLE, materialize, row_chunks, text_bytes

FILTERS = "ABCDE"
MARKS = b"#$%&*|"
#: Bytes of text of a shard; a longer text is a shard of its own.
SHARD = 1 << 24

ROW = "doc_id long, part string, code_points long, n_capitals long, marked boolean, digest binary"
SHARDS = f"shard long, words array<binary>, sizes binary, columns binary, counts binary, rows array<struct<{ROW}>>"
DOCS = ROW + ", n_words long, n_distinct long"

CAPITAL = np.zeros(256, dtype=bool)
CAPITAL[65:91] = True
MARK = np.zeros(256, dtype=bool)
MARK[list(MARKS)] = True


def pack(x: np.ndarray) -> bytes:
    return pa.compress(x.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def unpack(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, 4 * n, codec="zstd", asbytes=True), dtype="<i4")


def row_counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each row's flags are set; running sums over a shard's bytes
    would take eight times the shard, and twice."""
    ends = offsets.tolist()
    return np.fromiter((np.count_nonzero(flags[a:b]) for a, b in zip(ends, ends[1:])), np.int64, len(ends) - 1)


def row_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of the rows of ``data`` in order, and each one's row."""
    space = SPACE_TABLE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    # A row's edges are word edges too.
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    at = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - at
    places = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[~space]))])
    return words, (np.searchsorted(offsets, at, side="right") - 1).astype(np.int32)


#: Bytes of a shard whose words are looked at together.
PIECE = 1 << 20


def csr(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, row sizes, columns, counts) of the rows of ``data``; columns
    number the shard's own distinct ``words`` and ascend within a row. Words
    are found and counted a piece of whole rows at a time: positions and sorts
    over all of a shard would take fifteen times its bytes."""
    pieces = [row_words(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in row_chunks(offsets, piece)]
    # One dictionary for all pieces, in order of first sight.
    coded = pa.chunked_array([words for words, _ in pieces], pa.large_binary()).dictionary_encode()
    dictionary = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.large_binary())
    vocabulary = max(1, len(dictionary))
    empty = np.zeros(0, dtype=np.int32)
    # Pieces without words have no chunk of their own.
    column = np.concatenate([empty, *(chunk.indices.to_numpy() for chunk in coded.chunks)])
    done, sizes, columns, counts = 0, [], [], []
    for (_, row), (a, b) in zip(pieces, row_chunks(offsets, piece)):
        cells, times = np.unique(row.astype(np.int64) * vocabulary + column[done: done + len(row)], return_counts=True)
        done += len(row)
        sizes.append(np.bincount(cells // vocabulary, minlength=b - a))
        columns.append((cells % vocabulary).astype(np.int32))
        counts.append(times.astype(np.int32))
    return dictionary, *(np.concatenate([empty, *found]) for found in (sizes, columns, counts))


def csr_shards(docs: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """One row per shard: its words, its matrix and what else the filters need
    of its documents."""
    def build(batches):
        made = 0
        held: list[pa.RecordBatch] = []

        def shard(batch):
            nonlocal made
            data, offsets = text_bytes(batch.column(2))
            for a, b in row_chunks(offsets, shard_bytes):
                part, off = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
                words, sizes, columns, counts = csr(part, off)

                buffer = memoryview(part)
                digests = [hashlib.sha256(buffer[off[i]: off[i + 1]]).digest() for i in range(b - a)]
                rows = pa.StructArray.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(row_counts((part & 0xC0) != 0x80, off)),
                     pa.array(row_counts(CAPITAL[part], off)), pa.array(row_counts(MARK[part], off) > 0), pa.array(digests, pa.binary())],
                    names=["doc_id", "part", "code_points", "n_capitals", "marked", "digest"])
                number = (TaskContext.get().partitionId() << 32) + made
                made += 1
                words = words.cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                     pa.array([pack(sizes)], pa.binary()), pa.array([pack(columns)], pa.binary()), pa.array([pack(counts)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), rows)],
                    names=["shard", "words", "sizes", "columns", "counts", "rows"])

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.column(2).nbytes
            if size >= shard_bytes:
                # One copy of the text at a time: the batches go first.
                whole, batch, held, size = _joined(held), None, [], 0
                yield from shard(whole)
                whole = None
        if held:
            yield from shard(_joined(held))

    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(build, SHARDS)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    table = table.set_column(2, "text", table.column(2).cast(pa.large_string()))
    return table.combine_chunks().to_batches()[0] if table.num_rows else held[0]


def numbered_words(shards: DataFrame) -> DataFrame:
    """(shard, place, number): the global number of each shard's words. A
    number is the task and the rank of the word there, so it is the same when
    the task is run again."""
    def number(batches):
        base = TaskContext.get().partitionId() << 40
        last, seen = None, 0
        for batch in batches:
            if not len(batch):
                continue
            words = batch.column(2).cast(pa.large_binary())
            new = np.ones(len(words), dtype=np.int64)
            if len(words) > 1:
                new[1:] = np.asarray(pc.not_equal(words[1:], words[:-1]))
            new[0] = words[0].as_py() != last
            rank = seen + np.cumsum(new)
            last, seen = words[-1].as_py(), int(rank[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base + rank)], names=["shard", "place", "number"])

    words = shards.select("shard", F.posexplode("words").alias("place", "word"))
    return words.repartition("word").sortWithinPartitions("word").mapInArrow(number, "shard long, place int, number long")


def document_words(shards: DataFrame) -> DataFrame:
    """One row per document with its row sum and nonzero columns."""
    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        number = np.zeros(right.num_rows, dtype=np.int64)
        number[right.column("place").to_numpy()] = right.column("number").to_numpy()
        out = []
        for one in range(left.num_rows):  # a shard's number stands once
            rows = left.column("rows").combine_chunks()[one].values
            sizes = unpack(left.column("sizes")[one].as_py(), len(rows)).astype(np.int64)
            columns = number[unpack(left.column("columns")[one].as_py(), int(sizes.sum()))]
            counts = unpack(left.column("counts")[one].as_py(), len(columns))
            first = np.concatenate(([0], np.cumsum(sizes)))
            row = np.repeat(np.arange(len(rows)), sizes)
            order = np.lexsort((columns, row))  # canonical form under the global numbers
            row, columns, counts = row[order], columns[order], counts[order]
            fresh = np.ones(len(columns), dtype=np.int64)
            fresh[1:] = (columns[1:] != columns[:-1]) | (row[1:] != row[:-1])
            n_words = np.diff(np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[first])
            n_distinct = np.diff(np.concatenate(([0], np.cumsum(fresh)))[first])
            fields = [rows.field(i) for i in range(rows.type.num_fields)]
            out.append(pa.Table.from_arrays([*fields, pa.array(n_words), pa.array(n_distinct)],
                                            names=[*[f.name for f in rows.type], "n_words", "n_distinct"]))
        return pa.concat_tables(out)

    matrices = shards.select("shard", "sizes", "columns", "counts", "rows")
    return matrices.groupBy("shard").cogroup(numbered_words(shards).groupBy("shard")).applyInArrow(measure, DOCS)


def failures(docs: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """doc_id, part and a boolean column for each filter a document fails."""
    shards = materialize(csr_shards(docs, shard_bytes), "csr")
    found = materialize(document_words(shards).select(
        "doc_id", "part", "digest",
        (F.col("n_words") < 50).alias("A"),
        (100 * F.col("n_distinct") < 65 * F.col("n_words")).alias("B"),
        (100 * F.col("n_capitals") > 5 * F.col("code_points")).alias("C"),
        F.col("marked").alias("D")), "filter-rows")
    # Both sides are read from files, so that a hot digest's rows can be split.
    first = materialize(found.groupBy("digest").agg(F.min("doc_id").alias("first_id")), "first-texts")
    repeated = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return found.join(first, "digest").select("doc_id", "part", *FILTERS[:4], repeated.alias("E"))


def pattern_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part: documents, good and toxic ones by pattern (a bit a filter,
    A the lowest), at most 32 entries a part."""
    pattern = sum((F.col(c).cast("int") * (1 << i) for i, c in enumerate(FILTERS)), F.lit(0))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    per_doc = failed.select("doc_id", "part", pattern.alias("pattern")).join(marks, "doc_id", "left")
    counted = per_doc.groupBy("part", "pattern").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("patterns"))


class Orders:
    """For each order and step (600 rows), which of the 32 patterns count."""

    def __init__(self):
        names = ["".join(p) for p in permutations(FILTERS)]
        self.order = [o for o in names for _ in FILTERS]
        self.step = [s + 1 for _ in names for s in range(len(FILTERS))]
        pattern = np.arange(1 << len(FILTERS))
        bit = {f: 1 << i for i, f in enumerate(FILTERS)}
        before = np.array([sum(bit[f] for f in o[: s - 1]) for o, s in zip(self.order, self.step)])[:, None]
        own = np.array([bit[o[s - 1]] for o, s in zip(self.order, self.step)])[:, None]
        fails, gone = (pattern & own) > 0, (pattern & before) > 0
        self.removed = (fails & ~gone).astype(np.int64)
        self.redundant = (fails & gone).astype(np.int64)
        self.kept = (~fails & ~gone).astype(np.int64)
        self.unique = (pattern == own).astype(np.int64)
        filters = own[:, 0]
        self.shapley = np.array([self.removed[filters == f].sum(axis=0) for f in filters])


OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def played(counts: DataFrame) -> DataFrame:
    """The 600 rows of each part."""
    def play(batches):
        orders = Orders()
        for batch in batches:
            for part, patterns in zip(batch.column(0), batch.column(1)):
                cells = patterns.values
                by = {}
                for name in ("n", "good", "toxic"):
                    by[name] = np.zeros(1 << len(FILTERS), dtype=np.int64)
                    by[name][cells.field("pattern").to_numpy()] = cells.field(name).to_numpy()
                columns = [orders.kept @ by["n"], orders.removed @ by["n"], orders.redundant @ by["n"], orders.unique @ by["n"],
                           orders.removed @ by["good"], orders.removed @ by["toxic"], orders.shapley @ by["n"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(orders.step), pa.string()), pa.array(orders.order), pa.array(orders.step, pa.int32()),
                     *[pa.array(c) for c in columns]], names=[c.split()[0] for c in OUT.split(", ")])

    return counts.mapInArrow(play, OUT)


def filter_audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """One row per part, order of the filters and step."""
    return played(pattern_counts(failures(docs, shard_bytes), labels))


#: The same audit in DuckDB SQL.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
f AS (
  SELECT w.doc_id, part,
    len(words) < 50 AS a,
    100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(w.doc_id > first.first_id, false) AS e
  FROM w JOIN (SELECT t AS ft, min(doc_id) AS first_id FROM w GROUP BY t) first ON w.t = first.ft),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
p AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM f LEFT JOIN marks USING (doc_id) GROUP BY part, a, b, c, d, e),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT q.x || r.x || s.x || t.x || u.x AS filter_order
  FROM l q JOIN l r ON r.x <> q.x JOIN l s ON s.x NOT IN (q.x, r.x) JOIN l t ON t.x NOT IN (q.x, r.x, s.x)
  JOIN l u ON u.x NOT IN (q.x, r.x, s.x, t.x)),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
          FROM o CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step) z),
x AS (
  SELECT p.part, filter_order, step, own, n, good, toxic,
    (own = 'A' AND a) OR (own = 'B' AND b) OR (own = 'C' AND c) OR (own = 'D' AND d) OR (own = 'E' AND e) AS fails,
    (contains(earlier, 'A') AND a) OR (contains(earlier, 'B') AND b) OR (contains(earlier, 'C') AND c)
      OR (contains(earlier, 'D') AND d) OR (contains(earlier, 'E') AND e) AS gone,
    a::INTEGER + b::INTEGER + c::INTEGER + d::INTEGER + e::INTEGER AS failed
  FROM p CROSS JOIN steps),
g AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE fails AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails AND failed = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS toxic_lost
  FROM x GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""
