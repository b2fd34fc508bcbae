"""Operator 5: language identification by language-bitmask n-gram filters.

Training counts, per language, in how many sample documents each byte n-gram
of the lower-cased text occurs, and puts the frequent ones into one bit-sliced
Bloom filter: an array of SLOTS masks with one bit per language. Looking an
n-gram up ANDs its HASHES masks and returns all languages that contain it.
A document counts the hits of each language (per-language popcounts), corrects
them for the false positives that the filter's fill gives, and the largest
corrected share decides.

The fit uses at most SAMPLE documents per language, chosen by hashed id; the filter has a fixed size and is shipped with the tasks. Every
document is scored whole.

Equal shares, and texts none of whose n-grams is known (such as two letters or
another script), go to the language with more training rows, then the one
that sorts first; the score is then the winner's part of a tie.

Edge cases: a null text or one without letters is ``und`` with score 0; with no
training rows every text is ``und``; ids, sources and labels are never inputs;
extra columns are never read; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import held_out, mix64, row_chunks, sample_cut, text_bytes, train_row

GRAM = 4
SLOTS = 1 << 20
HASHES = 2
SAMPLE = 1500
#: An n-gram belongs to a language if this share of its sample documents has it.
SHARE = 0.02
MASK = 64
LETTER = r"\p{L}"

OUT = "doc_id long, lang_pred string, score double"


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every GRAM-byte window that stays inside its row, where
    windows that are only white space, digits or ASCII marks are left out."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.zeros(n, dtype=np.uint64)
    lettered = np.zeros(len(data), dtype=bool)
    lettered[(data >= 97) & (data <= 122) | (data >= 128)] = True
    keep = np.zeros(n, dtype=np.int8)
    for i in range(GRAM):
        code = (code << np.uint64(8)) | data[i: n + i].astype(np.uint64)
        keep += lettered[i: n + i]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = (np.arange(n) + GRAM <= offsets[row + 1]) & (keep >= 2)
    return mix64(code[inside]), row[inside]


def _slots(h: np.ndarray, k: int) -> np.ndarray:
    return ((h >> np.uint64(20 * k)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _lower(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pc.utf8_lower(column))


def sample_per_language(docs: DataFrame, size: int = SAMPLE) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """(text, lang) of at most ``size`` training rows per language, how many
    each has there, and in all."""
    rows = docs.filter(train_row(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    keep, sizes, totals = sample_cut(rows, size, "lang")
    return rows.filter(keep).select("text", "lang"), sizes, totals


def fit(docs: DataFrame, size: int = SAMPLE, share: float = SHARE) -> dict:
    """Languages, the filter's masks, false-positive rates."""
    def count(batches):
        for batch in batches:
            data, offsets = _lower(batch.column(0))
            langs = batch.column(1)
            for a, b in row_chunks(offsets):
                h, row = grams(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                for i, lang in enumerate(langs[a:b].to_pylist()):
                    own = np.unique(h[row == i]) if b - a > 1 else np.unique(h)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64))], names=["lang", "gram"])

    sample, sizes, totals = sample_per_language(docs, size)
    languages = sorted(sizes, key=lambda x: (-totals[x], x))  # the order breaks ties
    number = {x: i for i, x in enumerate(languages)}
    masks = np.zeros((max(1, -(-len(languages) // MASK)), SLOTS), dtype=np.uint64)
    if languages:
        least = F.coalesce(*[F.when(F.col("lang") == x, F.lit(max(2.0, share * n))) for x, n in sizes.items()])
        found = (sample.mapInArrow(count, "lang string, gram long").groupBy("lang", "gram").count()
                 .filter(F.col("count") >= least))
        # A gram of a language occurs in 2 % of its sample: bounded by the sample, not by the corpus.
        for r in found.select("lang", "gram").toArrow().to_batches():
            h = r.column(1).to_numpy().view(np.uint64)
            own = np.array([number[x] for x in r.column(0).to_pylist()], dtype=np.uint64)
            word, bit = (own // np.uint64(MASK)).astype(np.int64), np.uint64(1) << (own % np.uint64(MASK))
            for k in range(HASHES):
                np.bitwise_or.at(masks, (word, _slots(h, k)), bit)
    fill = [float(np.mean((masks[i // MASK] >> np.uint64(i % MASK)) & np.uint64(1))) for i in range(len(languages))]
    return {"languages": languages, "masks": masks.astype(np.uint8) if len(languages) <= 8 else masks,
            "false_positive": [f ** HASHES for f in fill]}


def shares(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Corrected share of each row's n-grams that each language contains."""
    h, row = grams(data, offsets)
    n = len(offsets) - 1
    slots = [_slots(h, k) for k in range(HASHES)]
    total = np.maximum(np.bincount(row, minlength=n), 1)
    out = np.zeros((n, len(model["languages"])))
    for i, fp in enumerate(model["false_positive"]):
        if i % MASK == 0:
            masks = model["masks"][i // MASK]
            hit = np.bitwise_and.reduce([masks[s] for s in slots])
        bits = (hit >> hit.dtype.type(i % MASK)) & hit.dtype.type(1)
        raw = np.bincount(row, weights=bits, minlength=n) / total
        out[:, i] = np.clip((raw - fp) / max(1e-9, 1 - fp), 0, 1)
    return out


def language_rows(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the winner's part of the corrected
    shares, sharpened so that a clear win is near 1)."""
    model = model or fit(docs)
    languages = model["languages"]

    def predict(batches):
        for batch in batches:
            data, offsets = _lower(batch.column(1))
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            names, scores = [], []
            for a, b in row_chunks(offsets):
                part = shares(model, data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if not languages:
                    names += ["und"] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                best = part.argmax(axis=1)
                weight = np.exp(20 * (part - part.max(axis=1, keepdims=True)))
                top = 1 / weight.sum(axis=1)
                for i in range(b - a):
                    ok = bool(lettered[a + i])
                    names.append(languages[best[i]] if ok else "und")
                    scores.append(float(top[i]) if ok else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("lettered"))
    found = rows.mapInArrow(predict, OUT)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
