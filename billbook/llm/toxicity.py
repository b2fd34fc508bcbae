"""Operator 4: toxicity by Levenshtein automata over a learned lexicon trie.

Training finds the terms (word stems and whole words) that mark labelled toxic
documents. They form a trie; a word is matched by walking the trie with the
rows of a Levenshtein automaton, so a misspelled term is found without listing
its spellings. Every hit is weighed by its context window: a term between
quotation marks, or next to a reporting cue, counts as quotation, an address
such as "you" next to it as abuse. A logistic model over the per-document hit
counts gives the score. Its weights are fitted on exact hits and a misspelled
hit counts as MISSPELLED of one, so it moves the score also where the sample
holds no misspelled term.

The model is fitted on a bounded sample: at most SAMPLE labelled rows, chosen
by hashed id, never rows held out. Labels, ids, languages and
sources are not inputs of a score. Every document is scored whole.

Edge cases: a null or empty text has no hits and gets the score of no hits;
labels may be null (not used) or repeat (their largest value counts); with no
training rows the score is 0.5 times the hits' share, 0 here as the lexicon is
empty; extra columns are never read; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import held_out, materialize, sample_cut, train_row

SAMPLE = 16000
#: Tasks that the sample is dealt to.
SPREAD = 24
STEM_LETTERS = (4, 8)
#: A term is kept if this share of the sample documents that have it is toxic.
PRECISION = 0.96
#: ... and it is in so many toxic sample documents, or in this share of them.
LEAST = (3, 0.01)
#: A word near a term is its misspelling unless less than this share of the
#: sample documents that have the word is toxic; unseen words count as toxic.
FUZZY_PRECISION = 0.6
#: Edits allowed, by the term's length.
EDITS = ((9, 2), (4, 1))
WINDOW = 3
QUOTED = 0.35
#: What a misspelled hit counts, as a share of an exact one.
MISSPELLED = 0.5
CACHE = 400_000

#: Quotation marks, reporting cues and direct address.
QUOTES = "\"“”„«»‘’"
CUES = frozenset("said says quote quoted quotes called wrote word term sagte dit dijo".split())
ADDRESS = frozenset("you your youre du dich tu te vous usted".split())

WORD = re.compile(r"[^\W_]+")
OUT = "doc_id long, exact double, fuzzy double, quoted double, n_words long"


def terms_of(words: set[str]) -> set[str]:
    """Whole words (``word$``) and their stems."""
    out = {w + "$" for w in words}
    for w in words:
        for n in range(STEM_LETTERS[0], min(STEM_LETTERS[1], len(w)) + 1):
            out.add(w[:n])
    return out


def build_trie(terms) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for c in term.rstrip("$"):
            node = node.setdefault(c, {})
        node["$whole"] = term
    return root


def edits_for(length: int) -> int:
    return next((e for n, e in EDITS if length >= n), 0)


def match(trie: dict, word: str, most: int) -> tuple[str, int] | None:
    """The closest lexicon term (term, distance): the automaton's state is the
    row of edit distances between the trie path and the word's prefixes; a
    path is left when no entry of its row is within reach."""
    best: tuple[str, int] | None = None
    stack = [(trie, tuple(range(len(word) + 1)), 0)]
    while stack:
        node, row, depth = stack.pop()
        term = node.get("$whole")
        if term is not None and row[-1] <= min(most, edits_for(depth)) and (best is None or (row[-1], term) < (best[1], best[0])):
            best = (term, row[-1])
        limit = most if best is None else min(most, best[1])
        for c, child in node.items():
            if len(c) > 1:
                continue
            new = [depth + 1]
            for j, x in enumerate(word):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != c)))
            if min(new) <= limit:
                stack.append((child, tuple(new), depth + 1))
    return best


class Scorer:
    """Hits of one lexicon in texts; words are looked up once per task."""

    def __init__(self, exact: set[str], fuzzy: set[str], innocent: frozenset[str] | set[str] = frozenset()):
        self.innocent = innocent
        self.stems = {t for t in exact if not t.endswith("$")}
        self.whole = {t[:-1] for t in exact if t.endswith("$")}
        self.stem_letters = sorted({len(t) for t in self.stems})
        self.cache: dict[str, tuple[str, int]] = {}
        self.plain: set[str] = set()
        # A word within k edits of a term keeps one of k + 1 parts of it whole,
        # moved by what was put in or left out before it: by word length, the
        # slices that may hold a part, and a trie of the terms with that part there.
        slices: dict[int, dict[tuple[int, int], dict[str, set[str]]]] = {}
        for t in (t.rstrip("$") for t in fuzzy):
            k, n = edits_for(len(t)), len(t)
            cuts = [n * i // (k + 1) for i in range(k + 2)]
            for more in range(-k, k + 1):
                at = slices.setdefault(n + more, {})
                for a, b in zip(cuts, cuts[1:]):
                    for moved in range(-k, k + 1):
                        if abs(moved) + abs(more - moved) <= k and a + moved >= 0 and b + moved <= n + more:
                            at.setdefault((a + moved, b + moved), {}).setdefault(t[a:b], set()).add(t + "$")
        tries: dict[frozenset[str], dict] = {}

        def trie_of(terms: set[str]) -> dict:
            key = frozenset(terms)
            if key not in tries:
                tries[key] = build_trie(key)
            return tries[key]

        self.slices = {n: [(a, b, {part: trie_of(terms) for part, terms in parts.items()}) for (a, b), parts in at.items()]
                       for n, at in slices.items()}

    def look(self, word: str) -> tuple[str, int] | None:
        """(term, distance) or None."""
        if word in self.plain:
            return None
        found = self.cache.get(word)
        if found is not None:
            return found
        if word in self.whole:
            found = (word + "$", 0)
        else:
            for n in self.stem_letters:
                if word[:n] in self.stems:
                    found = (word[:n], 0)
                    break
            if found is None and word not in self.innocent:
                walked = []
                for a, b, parts in self.slices.get(len(word), ()):
                    trie = parts.get(word[a:b])
                    if trie is None or any(trie is t for t in walked):
                        continue
                    walked.append(trie)
                    near = match(trie, word, edits_for(len(word) + 2))
                    if near is not None and (found is None or near[::-1] < found[::-1]):
                        found = near
        if len(self.cache) + len(self.plain) >= CACHE:
            self.cache.clear()
            self.plain.clear()
        if found is None:
            self.plain.add(word)
        else:
            self.cache[word] = found
        return found

    def hits(self, text: str) -> list[tuple[str, int, float]]:
        """(term, distance, context weight) of each hit."""
        low = text.lower()
        words = WORD.findall(low)
        known = {w for w in set(words) - self.plain if self.look(w) is not None}
        if not known:
            return []
        out = []
        spots = [(m.start(), m.end(), m.group()) for m in WORD.finditer(low)]
        for i, (a, b, w) in enumerate(spots):
            if w not in known:
                continue
            around = {x for _, _, x in spots[max(0, i - WINDOW): i + WINDOW + 1]}
            lead = low[spots[max(0, i - WINDOW)][0]: a]
            tail = low[b: spots[min(len(spots) - 1, i + WINDOW)][1]]
            quoted = any(q in lead for q in QUOTES) and any(q in tail for q in QUOTES)
            quoted = quoted or bool(around & CUES)
            weight = QUOTED if quoted and not around & ADDRESS else 1.0
            found = self.look(w)
            out.append((found[0], found[1], weight))
        return out

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Summed weights of exact hits, of misspelled hits, and of quoted ones."""
        found = self.hits(text or "")
        return (sum(w for _, d, w in found if not d), sum(w for _, d, w in found if d),
                float(sum(1 for _, _, w in found if w < 1)))


def training_rows(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``size`` labelled rows that are not held out;
    rows that share doc_id and text are one."""
    marked = (labels.filter(train_row(F.col("doc_id")) & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # Counted after the join: many rows may share a labelled id.
    labelled = materialize(rows.select("doc_id", "text_hash").join(marked, "doc_id").distinct(), "toxic-labelled")
    keep, *_ = sample_cut(labelled, size, by=F.xxhash64("doc_id", "text_hash"))
    # ``size`` rows at most: a fixed bound, so broadcast.
    found = rows.join(F.broadcast(labelled.filter(keep)), ["doc_id", "text_hash"])
    return found.dropDuplicates(["doc_id", "text_hash"]).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> dict:
    """Lexicon, terms that may be misspelled, and the logistic weights."""
    sample = materialize(training_rows(docs, labels, size).repartition(SPREAD), "toxic-sample")  # ``size`` texts

    def count(batches):
        both = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = terms_of(set(WORD.findall((text or "").lower())))
                both[1 if toxic else 0].update(own)
                both[1 if toxic else 0][""] += 1
        # Only terms seen in a toxic text here can pass; their clean counts come in a second look.
        terms = list(both[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([both[1][t] for t in terms], pa.int64())], names=["term", "bad"])

    bad = materialize(sample.mapInArrow(count, "term string, bad long").groupBy("term").agg(F.sum("bad").alias("bad")), "toxic-terms")
    n_bad = (bad.filter("term = ''").agg(F.max("bad")).collect()[0][0]) or 0
    least = max(LEAST[0], math.ceil(LEAST[1] * n_bad))
    frequent = {r["term"]: r["bad"] for r in bad.filter((F.col("bad") >= least) & (F.col("term") != "")).toLocalIterator()}

    def clean(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not toxic:
                    seen.update(frequent.keys() & terms_of(set(WORD.findall((text or "").lower()))))
                    seen[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "good"])

    good = {r["term"]: r["good"] for r in sample.mapInArrow(clean, "term string, good long").groupBy("term").agg(F.sum("good").alias("good")).toLocalIterator()}
    chosen = {t for t, b in frequent.items() if b / (b + good.get(t, 0) + 0.3) >= PRECISION}
    # A longer stem or the whole word adds nothing where a shorter stem is kept.
    lexicon = {t for t in chosen if not any(t.rstrip("$")[:n] in chosen and t.rstrip("$")[:n] != t for n in range(STEM_LETTERS[0], len(t.rstrip("$")) + 1))}
    # Misspelling is judged on whole words; a stem matches any ending as it is.
    fuzzy = {t for t in chosen if t.endswith("$") and edits_for(len(t) - 1)}

    def near_words(batches):
        scorer, seen = Scorer(lexicon, fuzzy), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in set(WORD.findall((text or "").lower())):
                    found = scorer.look(w)
                    if found is not None and found[1]:
                        seen[(w, 1 if toxic else 0)] += 1
        rows = [(w, k, n) for (w, k), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["word", "toxic", "n"])

    # A spelling is judged, not its term: a clean neighbour ("oron") leaves the other spellings of "moron".
    innocent: set[str] = set()
    if fuzzy:
        judged = sample.mapInArrow(near_words, "word string, toxic int, n long").groupBy("word").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("toxic")).alias("bad"))
        innocent = {r["word"] for r in judged.filter(f"(bad + 1) / (n + 1) < {FUZZY_PRECISION}").select("word").toLocalIterator()}

    def measure(batches):
        scorer = Scorer(lexicon, set())  # misspelled hits are not fitted
        for batch in batches:
            rows = [scorer.features(t) for t in batch.column(0).to_pylist()]
            cols = [pa.array([r[i] for r in rows], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, batch.column(1).cast(pa.int32())], names=["exact", "fuzzy", "quoted", "toxic"])

    points = sample.mapInArrow(measure, "exact double, fuzzy double, quoted double, toxic int").toArrow()  # ``size`` rows at most
    x = np.column_stack([points.column(i).to_numpy() for i in range(3)]) if points.num_rows else np.zeros((0, 3))
    y = points.column(3).to_numpy().astype(float) if points.num_rows else np.zeros(0)
    return {"lexicon": lexicon, "fuzzy": fuzzy, "innocent": innocent, "weights": logistic(inputs(x), y)}


def inputs(x: np.ndarray) -> np.ndarray:
    """Model inputs: any hit, log of the hits."""
    hits = x[:, 0] + MISSPELLED * x[:, 1]
    return np.column_stack([np.ones(len(x)), np.minimum(hits, 1), np.log1p(hits)])


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 0.05) -> list[float]:
    """Newton steps of ridge logistic regression; all zero but a low intercept
    without rows."""
    w = np.zeros(x.shape[1])
    if not len(y):
        w[0] = -4.0
        return w.tolist()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def toxicity_rows(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, and the hit counts."""
    model = model or fit(docs, labels)
    lexicon, fuzzy, innocent, weights = model["lexicon"], model["fuzzy"], model["innocent"], np.array(model["weights"])

    def score(batches):
        scorer = Scorer(lexicon, fuzzy, innocent)
        for batch in batches:
            x = np.array([scorer.features(t.as_py()) for t in batch.column(1)]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(inputs(x) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), *[pa.array(x[:, i]) for i in range(3)]],
                                             names=["doc_id", "score", "exact_hits", "fuzzy_hits", "quoted_hits"])

    found = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, exact_hits double, fuzzy_hits double, quoted_hits double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "exact_hits", "fuzzy_hits", "quoted_hits")
