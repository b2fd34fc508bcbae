"""Operator 6: document quality by weak supervision (built-in functions only).

Rules look at one document each and vote good (+1), bad (-1) or abstain (0).
No rule has a hand-set weight: expectation-maximisation over the counts of the
distinct vote patterns estimates, per class, how often each rule votes each
way, and every document gets the posterior probability of being good.

The only rows that reach the driver are vote patterns with their counts, at
most 3 ** len(RULES) of them whatever the corpus. The counts cover all rows.

Edge cases: a null or empty text has no words and every count 0; an empty
table gives no rows; extra columns are kept by ``with_quality`` and never read;
repeated rows are judged one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import free_name, materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5

#: name, bad where, good where (over the fields of ``features``); else abstain.
#: A rule that looks for one fault says nothing about texts without it.
RULES = [
    ("length", "n_words < 10", "false"),
    ("symbols", "n_symbols > 0.2 * n_words", "false"),
    ("repetition", "n_repeat_words > 0.2 * n_words", "false"),
    ("lines", "n_lines >= 4 and n_dup_lines > 0.3 * n_lines", "false"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words", "false"),
    ("capitals", "n_upper > 0.5 * word_chars", "false"),
    ("exclamation", "n_exclaim > 0.3 * n_words", "false"),
    ("variety", "n_words >= 50 and n_distinct < 0.15 * n_words", "false"),
    ("prose", "n_symbols > 0.1 * n_words or n_exclaim > 0.2 * n_words or n_words >= 50 and n_stops < 0.005 * n_words",
     "n_words >= 20 and n_stops between 0.03 * n_words and 0.5 * n_words and n_symbols <= 0.02 * n_words "
     "and n_repeat_words <= 0.05 * n_words"),
]

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_exclaim", "n_distinct", "n_stops"]


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _neighbours_equal(placed: Column, x: Column, j: Column) -> Column:
    return (F.coalesce(F.get(placed, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(placed, j + 1)["h"] == x["h"], F.lit(False)))


def _add_repeat_words(df: DataFrame, windows: str, out: str) -> DataFrame:
    """Words inside windows that occur twice or more. Sorting (hash, place)
    brings equal windows together; the cover of the repeated places is the
    sum of the distances to the next one, WINDOW at most. Each step is a
    column of its own: inside a lambda it would be computed per element."""
    p, q = f"{out}_p", f"{out}_q"
    v = F.col(windows)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn(p, F.when(F.size(F.array_distinct(v)) == F.size(v), none).otherwise(
        F.array_sort(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(q, F.array_sort(F.transform(
        F.filter(F.col(p), lambda x, j: _neighbours_equal(F.col(p), x, j)), lambda x: x["i"])))
    gaps = F.transform(F.col(q), lambda at, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(q), j + 1) - at, F.lit(WINDOW))))
    return df.withColumn(out, F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)).drop(p, q)


def with_features(docs: DataFrame, text: str = "text", out: str = "quality_features") -> DataFrame:
    """``docs`` plus a struct column ``out`` of the counts in FEATURES."""
    t, w, v, b = f"{out}_t", f"{out}_w", f"{out}_v", f"{out}_b"
    df = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(w, F.filter(F.split(t, r"[\x20\x09-\x0D]+", -1), lambda x: x != ""))
    df = df.withColumn(v, F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(F.slice(F.col(w), i + 1, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    df = _add_repeat_words(df, v, f"{out}_r")
    df = df.withColumn(b, F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
    text_c = F.col(t)
    fields = {
        "n_words": F.size(w),
        "word_chars": F.length(F.translate(text_c, SPACES, "")),
        "n_symbols": _count_of(text_c, SYMBOLS),
        "n_dup_lines": F.size(b) - F.size(F.array_distinct(b)),
        "n_repeat_words": F.col(f"{out}_r"),
        "n_lines": F.size(b),
        "n_upper": F.length(text_c) - F.length(F.regexp_replace(text_c, r"\p{Lu}", "")),
        "n_exclaim": _count_of(text_c, "!"),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_stops": _count_of(text_c, ".?"),
    }
    packed = F.struct(*[fields[k].cast("long").alias(k) for k in FEATURES])
    return df.withColumn(out, packed).drop(t, w, v, b, f"{out}_r")


def _votes(out: str) -> list[Column]:
    """One column per rule: 0 bad, 1 abstain, 2 good."""
    def bound(rule: str) -> Column:
        for name in sorted(FEATURES, key=len, reverse=True):
            rule = rule.replace(name, f"{out}.{name}") if f"{out}.{name}" not in rule else rule
        return F.expr(rule)

    return [F.when(bound(bad), 0).when(bound(good), 2).otherwise(1) for _, bad, good in RULES]


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> dict:
    """EM for two classes and three vote values per rule, from (votes, count)
    pairs. The start doubts every document that some rule votes bad (most
    rules vote good on most documents, so a majority would hide a single
    strong objection); add-one smoothing keeps every probability positive.
    Rules are taken to be no worse than chance: a good vote never counts
    against a document nor a bad one for it. With no rows votes weigh nothing."""
    patterns = sorted(patterns)
    total = sum(n for _, n in patterns)
    k = len(RULES)
    post = [0.05 if 0 in votes else 0.95 for votes, _ in patterns]
    prior, like = 0.5, [[[1 / 3] * 3 for _ in range(2)] for _ in range(k)]
    for _ in range(rounds if total else 0):
        good = sum(n * p for (_, n), p in zip(patterns, post))
        prior = (good + 1) / (total + 2)
        for r in range(k):
            for cls in range(2):
                mass = [1.0] * 3
                for (votes, n), p in zip(patterns, post):
                    mass[votes[r]] += n * (p if cls else 1 - p)
                s = sum(mass)
                like[r][cls] = [m / s for m in mass]
        weights = [_weights(like[r]) for r in range(k)]
        odds = [math.log(prior / (1 - prior)) + sum(weights[r][v] for r, v in enumerate(votes)) for votes, _ in patterns]
        post = [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in odds]
    return {"prior": prior, "weights": [_weights(like[r]) for r in range(k)]}


def _weights(like: list[list[float]]) -> list[float]:
    """Log odds of a bad vote, an abstention (no evidence) and a good vote."""
    raw = [math.log(like[1][v] / like[0][v]) for v in range(3)]
    return [min(0.0, raw[0]), 0.0, max(0.0, raw[2])]


def posterior(model: dict, out: str = "quality_features") -> Column:
    """Probability that a document is good, from its votes."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for vote, weights in zip(_votes(out), model["weights"]):
        odds = odds + F.element_at(F.array(*[F.lit(x) for x in weights]), vote + 1)
    return 1 / (1 + F.exp(-odds))


def learn(featured: DataFrame, out: str = "quality_features") -> dict:
    """Vote-pattern counts of all rows (map-side combined), then EM."""
    digits = F.concat(*[v.cast("string") for v in _votes(out)])
    rows = featured.groupBy(digits.alias("pattern")).count().collect()  # at most 3 ** rules rows
    return fit_votes([(tuple(int(c) for c in r["pattern"]), r["count"]) for r in rows])


def with_quality(docs: DataFrame, text: str = "text", out: str = "quality_features") -> DataFrame:
    """``docs`` plus ``out`` (counts), ``out_p`` (posterior), ``out_base_failed``
    and ``out_kept``. The featured rows are written once and reread, so texts
    are parsed once."""
    featured = materialize(with_features(docs, text, out), "quality")
    model = learn(featured, out)
    q = F.col(out)
    failed = (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])
    return (featured.withColumn(f"{out}_p", posterior(model, out))
            .withColumn(f"{out}_base_failed", failed)
            .withColumn(f"{out}_kept", ~failed & (F.col(f"{out}_p") >= 0.5)))


def quality_rows(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, the base verdict and ``kept``."""
    featured = materialize(with_features(docs.select("doc_id", "text")).drop("text"), "quality")
    model = learn(featured)
    q = F.col("quality_features")
    failed = (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])
    good = posterior(model)
    return featured.select(
        "doc_id", *[q[k].alias(k) for k in FEATURES[:5]],
        failed.alias("base_failed"), (~failed & (good >= 0.5)).alias("kept"), good.alias("p_good"))


def good_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the verdict rejects."""
    out = free_name(docs, "quality_features")
    return with_quality(docs, out=out).filter(f"{out}_kept").select(*docs.columns)
