"""Operator 8: exact removal of repeated byte strings, keeping the first.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier:
the longest previous factor of that start is at least LENGTH. The order of
starts is doc_id, then place; matches never cross documents.

The suffixes are ordered sparsely. Among the LENGTH-byte string at each start
the K-gram with the smallest hash is its anchor; equal strings have equal
anchors at equal distances, so two suffixes can only match if their anchors
do. Neighbouring starts with one anchor form a run (about 35 starts), and one
row per run is sorted, by the hash of its anchor:

1. a run whose bytes all occur in an earlier run is a whole match;
2. of anchors that stand in different bytes (where a match begins or ends),
   the first run of each different content is looked at closely. Its starts
   fall into QUARTERS by their distance to the anchor; all strings of a
   quarter share 83 bytes around the anchor, so only quarters whose 83 bytes
   occur in another run can match. Their starts' LENGTH-byte prefixes are
   sorted in turn: in that order the previous smaller place with the same
   prefix is the previous factor; only the smallest place has none.

Rows of one anchor, and starts of one prefix, are combined per batch before
the shuffle, and the first runs are found by grouped minima joined back, so a
line shared by a third of all documents is not one task.

Edge cases: null and texts shorter than LENGTH bytes lose nothing; rows that
share doc_id and text are one document and get one result each; rows that
share only the doc_id are ordered by a checksum of the text; a null doc_id
comes first; an empty table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from billbook.llm.common import RangeHash, long_array, materialize, mix64, row_chunks, text_bytes

LENGTH = 100
K = 32
#: Longer texts are cut into stretches that overlap by LENGTH - 1 bytes.
STRETCH = 1 << 22
PLACE_BITS = np.uint64(24)

QUARTERS = 4
SEGMENTS = "doc_id long, tag long, lo int, bytes binary, quarters array<struct<h:long,first:int,n:int>>"
RUNS = "doc_id long, tag long, key long, kind int, g long, f long, lo int, n int"


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K) -> dict[str, np.ndarray]:
    """One entry per run: row, first start ``lo`` (in the buffer), number of
    starts ``n``, hash ``g`` of the anchor and ``f`` of all the run's bytes."""
    w = length - k + 1
    grams = len(data) - k + 1
    starts = len(data) - length + 1
    empty = {c: np.zeros(0, t) for c, t in (("row", np.int64), ("lo", np.int64), ("n", np.int64), ("g", np.uint64), ("f", np.uint64))}
    if starts <= 0:
        return empty
    rolling = RangeHash(data)
    at = np.arange(grams)
    gram = rolling(at, at + k)
    packed = (gram >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    blocks = np.full(-(-grams // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:grams] = packed
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:starts], ahead[w - 1: w - 1 + starts])
    anchor = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    valid = np.arange(starts) + length <= offsets[row + 1]
    place = np.flatnonzero(valid)
    if not len(place):
        return empty
    anchor, row = anchor[place], row[place]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(place)))
    lo, a = place[first], anchor[first]
    f = mix64(rolling(lo, lo + n + length - 1) + (a - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return {"row": row[first], "lo": lo, "n": n, "g": gram[a], "f": f}


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int):
    """(buffer, offsets, rows, base of each row's places) in pieces of bounded
    size; one very long row comes as several stretches."""
    for a, b in row_chunks(offsets):
        if b - a == 1 and offsets[b] - offsets[a] > STRETCH:
            for s in range(0, int(offsets[b] - offsets[a]) - length + 1, STRETCH):
                part = data[offsets[a] + s: min(offsets[b], offsets[a] + s + STRETCH + length - 1)]
                yield part, np.array([0, len(part)]), a, s
        else:
            yield data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], a, 0


def _tagged(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a 64-bit checksum that tells rows of one doc_id (or
    of none) apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))


def anchored_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The runs of all documents. ``kind`` 0: the anchor is alone in its
    batch; 1: the first of several; 2: the others, which need not meet. ``g``
    is null where it equals ``key``, which leaves those bytes out of the shuffle."""
    def find(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            parts = []
            for buffer, off, first_row, base in _stretches(data, offsets, length):
                r = runs(buffer, off, length)
                r["lo"] = r["lo"] - off[r["row"]] + base
                r["row"] = r["row"] + first_row
                parts.append(r)
            if not parts:
                continue
            row, lo, n, g, f = (np.concatenate([p[c] for p in parts]) for c in ("row", "lo", "n", "g", "f"))
            doc = np.array([-(1 << 63) if x is None else x for x in batch.column(0).to_pylist()], dtype=np.int64)
            tag = batch.column(2).to_numpy().astype(np.int64)
            order = np.lexsort((lo, tag[row], doc[row], g))
            row, lo, n, g, f = row[order], lo[order], n[order], g[order], f[order]
            same = np.zeros(len(g) + 1, dtype=bool)
            same[1:-1] = g[1:] == g[:-1]
            kind = np.where(same[:-1], 2, np.where(same[1:], 1, 0)).astype(np.int32)
            key = np.where(kind == 2, mix64(f + np.arange(len(f), dtype=np.uint64)), g)
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(2).take(picked), long_array(key), pa.array(kind),
                 pa.array(g.view(np.int64), mask=kind < 2), long_array(f), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["doc_id", "tag", "key", "kind", "g", "f", "lo", "n"])

    return _tagged(docs).select("doc_id", "text", "tag").mapInArrow(find, RUNS)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, tag, start, stop): byte spans made of strings of ``length``
    bytes that also start earlier. Spans may touch or overlap."""
    found = anchored_runs(docs, length)
    alone = F.count("*").over(Window.partitionBy("key"))
    shared = materialize(
        found.withColumn("c", alone).filter("c > 1 or kind > 0")
        .select("doc_id", "tag", F.coalesce("g", "key").alias("g"), "f", "lo", "n"), "runs")
    here = F.struct("doc_id", "tag", "lo")
    first = materialize(shared.groupBy("g", "f").agg(F.min(here).alias("at"), F.max("n").alias("n"), F.count("*").alias("c")), "firsts")
    many = first.filter("c > 1").select("g", "f", "at")
    # Written on its own, so that its shuffles are given back before those of the starts come.
    whole = materialize(
        shared.join(many, ["g", "f"]).filter(~here.eqNullSafe(F.col("at")))
        .select("doc_id", "tag", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + length - 1).alias("stop")), "whole")
    varied = first.groupBy("g").agg(F.count("*").alias("v")).filter("v > 1").select("g")
    edges = (first.join(varied, "g").select("at.*", "g", "n")
             .groupBy("doc_id", "tag").agg(F.collect_list(F.struct("g", "lo", "n")).alias("runs")))
    d, e = _tagged(docs).alias("d"), edges.alias("e")
    texts = d.join(e, F.col("d.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("d.tag") == F.col("e.tag"))).select("d.doc_id", "d.text", "d.tag", "e.runs")

    def segment(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i in range(len(batch)):
                own = batch.column(3)[i].values
                g, lo, n = (own.field(c).to_numpy() for c in range(3))
                yield _segments(batch, i, data[offsets[i]: offsets[i + 1]], g.view(np.uint64), lo, n, length)

    segments = materialize(texts.mapInArrow(segment, SEGMENTS), "segments")
    quarters = segments.select("doc_id", "tag", "lo", F.explode("quarters").alias("q")).select("doc_id", "tag", "lo", "q.*")
    common = quarters.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    wanted = (quarters.join(common, "h").groupBy("doc_id", "tag", "lo")
              .agg(F.collect_list(F.struct("first", "n")).alias("parts")))
    x, y = segments.drop("quarters").alias("x"), wanted.alias("y")
    opened = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.tag") == F.col("y.tag")) & (F.col("x.lo") == F.col("y.lo"))
                    ).select("x.doc_id", "x.tag", "x.lo", "x.bytes", "y.parts")

    def open_starts(batches):
        for batch in batches:
            raw = batch.column(3)
            data = np.frombuffer(b"".join(raw.to_pylist()), dtype=np.uint8)
            base = np.concatenate(([0], np.cumsum([len(r.as_buffer()) for r in raw])))
            parts = batch.column(4)
            row = np.repeat(np.arange(len(batch)), [len(p) for p in parts])
            flat = parts.flatten()
            first, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
            lo = batch.column(2).to_numpy().astype(np.int64)
            at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            row = np.repeat(row, n)
            inside = at - lo[row] + base[row]
            h = RangeHash(data)(inside, inside + length)
            # Of equal prefixes in this batch only the first place has to meet the others.
            doc = np.array([-(1 << 63) if v is None else v for v in batch.column(0).to_pylist()], dtype=np.int64)
            tag = batch.column(1).to_numpy().astype(np.int64)
            order = np.lexsort((at, tag[row], doc[row], h))
            row, at, h = row[order], at[order], h[order]
            # The first row of each prefix; a repeated row's start is that start, not a later one.
            head = np.searchsorted(h, h)
            own = tag[row], doc[row], at
            late = np.any([c != c[head] for c in own], axis=0)
            key = np.where(late, mix64(h + np.arange(len(h), dtype=np.uint64)), h)
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(1).take(picked), long_array(key), pa.array(at.astype(np.int32)), pa.array(late)],
                names=["doc_id", "tag", "key", "lo", "late"])

    starts = opened.mapInArrow(open_starts, "doc_id long, tag long, key long, lo int, late boolean")
    later = F.rank().over(Window.partitionBy("key").orderBy("late", "doc_id", "tag", "lo"))
    late = (starts.withColumn("place", later).filter("place > 1 or late")
            .select("doc_id", "tag", F.col("lo").alias("start"), (F.col("lo") + length).alias("stop")))
    return whole.unionAll(late)


def _segments(batch: pa.RecordBatch, i: int, data: np.ndarray, g: np.ndarray, lo: np.ndarray, n: np.ndarray, length: int) -> pa.RecordBatch:
    """The bytes of a document's edge runs, and per run the quarters: hash of
    the bytes all its strings share, first start, number of starts."""
    rolling, w, step = RangeHash(data), length - K + 1, (length - K) // QUARTERS
    # The anchor is the first place from the run's last start on that has hash g.
    reach = np.arange(w)
    place = np.minimum((lo + n - 1)[:, None] + reach, len(data) - K)
    anchor = place[np.arange(len(g)), (rolling(place, place + K) == g[:, None]).argmax(axis=1)]
    rows, firsts, counts, hashes = [], [], [], []
    for q in range(QUARTERS):
        # Starts between a - far and a - near, cut to the run.
        near, far = q * step, (q + 1) * step - 1 if q < QUARTERS - 1 else length - K
        a, b = np.maximum(lo, anchor - far), np.minimum(lo + n - 1, anchor - near)
        some = np.flatnonzero(a <= b)
        begin = anchor[some] - near
        end = anchor[some] - far + length
        rows.append(some)
        firsts.append(a[some])
        counts.append(b[some] - a[some] + 1)
        hashes.append(mix64(rolling(begin, end) + np.uint64(q + 1) * np.uint64(0xD6E8FEB86659FD93)))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    first, count, h = (np.concatenate(c)[order] for c in (firsts, counts, hashes))
    cuts = np.searchsorted(row[order], np.arange(len(g) + 1)).astype(np.int32)
    quarters = pa.StructArray.from_arrays([long_array(h), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], names=["h", "first", "n"])
    same = pa.array(np.full(len(g), i))
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(same), batch.column(2).take(same), pa.array(lo.astype(np.int32)),
         pa.array([data[x: x + y + length - 1].tobytes() for x, y in zip(lo, n)], pa.binary()),
         pa.ListArray.from_arrays(pa.array(cuts), quarters)], names=["doc_id", "tag", "lo", "bytes", "quarters"])


def cut(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(bytes left, bytes removed, maximal removed stretches)."""
    if not len(start):
        return data, 0, 0
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return data[~gone], int(gone.sum()), spans


def without_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """One row per document: bytes, bytes and stretches removed, digest of the
    rest; with ``keep_text`` the rest itself (binary: a cut may split a
    character)."""
    spans = materialize(
        repeated_spans(docs, length).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")

    def rest(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            rows = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = batch.column(2)[i].values
                start, stop = (own.field(c).to_numpy() if own is not None else np.zeros(0, int) for c in range(2))
                text = data[offsets[i]: offsets[i + 1]]
                left, removed, count = cut(text, start, stop)
                left = left.tobytes()
                rows.append((doc_id, len(text), removed, count, hashlib.sha256(left).hexdigest(), left if keep_text else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            size = 6 if keep_text else 5
            yield pa.RecordBatch.from_arrays(columns[:size], names=names[:size])

    d, s = _tagged(docs).alias("d"), spans.alias("s")
    joined = d.join(s, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.tag") == F.col("s.tag")), "left").select("d.doc_id", "d.text", "s.spans")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    return joined.mapInArrow(rest, out)
