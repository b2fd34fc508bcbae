"""Operator 9: secret scans through a trigram inverted index (built-in
functions only).

``trigram_query`` derives a Boolean query over trigrams from each rule's
regular expression: an AND of clauses, each an OR of literal alternatives,
each the AND of its trigrams. ``postings`` builds the inverted index of the
trigrams those queries use (lower-cased text); intersecting postings gives the
candidate documents of each rule, and the expression runs on candidates only.
A rule without a mandatory trigram (``hex``) scans every text.

Offsets are code points. Edge cases: a null or empty text has no spans; rows
sharing a ``doc_id`` (or a null id) share their postings, which only adds
candidates, and each is verified on its own text; an empty table gives no rows;
extra columns are ignored unless named in ``keep``; ``redact`` keeps them all,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``regex``: Java syntax (kept within what Python's parser also reads).
    ``need_group``/``need``: a match counts if that group has that many
    characters at least."""
    name: str
    regex: str
    need_group: int = 0
    need: int = 0


#: Order matters: it breaks ties between spans that start at one place.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
BASE = ("assign", "access", "hex")
SPAN = "struct<start:int,kind:int,stop:int>"
#: A run of fewer than 32 hex digits can't pass ``need``: this finds the same
#: spans as the greedy rule with its length test, without listing short runs.
LONG_FORM = {"hex": r"(?<![0-9a-f])[0-9a-f]{32,}", "access": r"AKIA[A-Z0-9]{12,}"}
MOST_ALTERNATIVES = 64


def _alternatives(items) -> set[str] | None:
    """All strings an expression part can match, if finite and few."""
    found = {""}
    for op, arg in items:
        if op is sre.LITERAL:
            more = {chr(arg).lower()}
        elif op is sre.SUBPATTERN:
            more = _alternatives(arg[3])
        elif op is sre.BRANCH:
            parts = [_alternatives(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
            more = {chr(c).lower() for _, c in arg}
        elif op is sre.MAX_REPEAT and arg[1] is not sre.MAXREPEAT and arg[1] <= 3:
            once = _alternatives(arg[2])
            more = None
            if once is not None:
                more, power = set(), {""}
                for n in range(int(arg[1]) + 1):
                    more |= power if n >= arg[0] else set()
                    power = {a + b for a in power for b in once}
        else:
            more = None
        if more is None or len(found) * len(more) > MOST_ALTERNATIVES:
            return None
        found = {a + b for a in found for b in more}
    return found


def trigram_query(regex: str) -> list[list[frozenset[str]]]:
    """Clauses (AND) of alternatives (OR) of trigram sets (AND) that every
    match of ``regex`` satisfies on lower-cased text; [] where none is
    mandatory."""
    clauses: list[list[frozenset[str]]] = []

    def flush(run: set[str]) -> None:
        if run and all(len(s) >= 3 for s in run):
            clauses.append([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(run)])

    def walk(items) -> None:
        run = {""}
        for item in items:
            op, arg = item
            part = _alternatives([item])
            if part is not None and len(run) * len(part) <= MOST_ALTERNATIVES:
                run = {a + b for a in run for b in part}
                continue
            flush(run)
            run = {""}
            if op is sre.SUBPATTERN:
                walk(arg[3])
            elif op is sre.MAX_REPEAT and arg[0] >= 1:
                walk(arg[2])
        flush(run)

    walk(_parser.parse(regex))
    return clauses


def vocabulary(rules: list[Rule]) -> list[str]:
    """The trigrams that the rules' queries use, sorted."""
    return sorted({t for r in rules for clause in trigram_query(r.regex) for alt in clause for t in alt})


def postings(docs: DataFrame, rules: list[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: (trigram number, doc_id), one row per trigram of
    the rules' vocabulary and document that has it."""
    low = F.lower(F.col(text))
    has = F.array(*[F.when(low.contains(t), F.lit(i)) for i, t in enumerate(vocabulary(rules))])
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.array_compact(has)).alias("trigram"))


def candidates(index: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Intersect postings: per document, the rules (a bit each) whose query
    holds. Documents on no posting list are absent."""
    number = {t: i for i, t in enumerate(vocabulary(rules))}
    words = (len(number) + 62) // 63
    masks = index.groupBy("doc_id").agg(*[
        F.bit_or(F.when((F.col("trigram") >= 63 * k) & (F.col("trigram") < 63 * (k + 1)),
                        F.expr(f"shiftleft(1L, trigram - {63 * k})")).otherwise(F.lit(0).cast("long"))).alias(f"m{k}")
        for k in range(words)])

    def holds(alternative: frozenset[str]) -> Column:
        out = F.lit(True)
        for k in range(words):
            bits = sum(1 << (number[t] - 63 * k) for t in alternative if 63 * k <= number[t] < 63 * (k + 1))
            if bits:
                out = out & (F.col(f"m{k}").bitwiseAND(F.lit(bits)) == F.lit(bits))
        return out

    found = F.lit(0)
    for r, rule in enumerate(rules):
        query = trigram_query(rule.regex)
        if not query:
            continue
        ok = F.lit(True)
        for clause in query:
            one = F.lit(False)
            for alternative in clause:
                one = one | holds(alternative)
            ok = ok & one
        found = found + F.when(ok, F.lit(1 << r)).otherwise(F.lit(0))
    return masks.select(F.col("doc_id").alias("candidate_id"), found.alias("candidate_rules")).filter("candidate_rules != 0")


#: Elements folded at a time: an array that grows is copied at each step, so
#: it grows in blocks and the blocks are put together once.
FOLD = 64


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _folded(items: Column, total: Callable[[Column, Column], Column], joined: Callable[[Column, Column], Column],
            emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """All ``emit(carry, x)`` arrays, one behind the other, where ``carry`` (0
    at first) has gone through ``total`` over the elements before x; ``joined``
    puts the carries of two stretches together. Blocks are folded first, then
    their carries, then each block from its carry."""
    none = F.array().cast(f"array<{kind}>")

    def over(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / F.lit(FOLD)), F.lit(0)).cast("int"))

        def block(b: Column) -> Column:
            return F.slice(v, b * FOLD + 1, F.lit(FOLD))

        def from_heads(heads: Column) -> Column:
            def one(b: Column) -> Column:
                start = F.struct(F.get(heads, b).alias("at"), none.alias("out"))
                return F.aggregate(block(b), start, lambda acc, x: F.struct(
                    total(acc["at"], x).alias("at"), F.concat(acc["out"], emit(acc["at"], x)).alias("out")), lambda acc: acc["out"])
            return F.flatten(F.transform(numbers, one))

        carries = F.transform(numbers, lambda b: F.aggregate(block(b), F.lit(0), total))
        heads = F.aggregate(carries, F.array(F.lit(0)), lambda acc, c: F.array_append(acc, joined(F.element_at(acc, -1), c)))
        return _bound(heads, from_heads)

    return _bound(items, over)


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """array<struct<start,kind,stop>> of one rule's matches. The pieces
    between matches and the matches alternate, so running lengths give the
    places; failing matches still take their room."""
    regex = F.lit(LONG_FORM.get(rule.name, rule.regex))
    gaps = F.split(text, LONG_FORM.get(rule.name, rule.regex), -1)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    sized = whole if not rule.need_group else F.regexp_extract_all(text, regex, F.lit(rule.need_group))
    # Zipped once: a call inside the lambda would be made again per element.
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), sized.alias("sized"))
    steps = F.transform(F.filter(steps, lambda s: s["hit"].isNotNull()), lambda s: F.struct(
        F.length(s["gap"]).alias("gap"), F.length(s["hit"]).alias("hit"), (F.length(s["sized"]) >= rule.need).alias("ok")))

    def span(at: Column, s: Column) -> Column:
        found = F.struct((at + s["gap"]).alias("start"), F.lit(number).alias("kind"), (at + s["gap"] + s["hit"]).alias("stop"))
        return F.when(s["ok"], F.array(found)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return _folded(steps, lambda at, s: at + s["gap"] + s["hit"], lambda a, b: a + b, span, SPAN)


def secret_spans(docs: DataFrame, rules: list[Rule] = RULES, doc_id: str = "doc_id", text: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``text``, ``secret_row`` (a struct of the ``keep`` columns)
    and ``secret_spans``: every rule's spans, by start, then rule order."""
    hits = candidates(postings(docs, rules, doc_id, text), rules)
    # What is carried along sits in one struct, so its names can't clash.
    carried = [F.struct(*[F.col(c) for c in keep]).alias("secret_row")] if keep else []
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carried)
    joined = rows.join(hits.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(hits["candidate_id"]), "left")
    t = F.col("text")
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.regex):
            test = F.coalesce(F.col("candidate_rules").bitwiseAND(F.lit(1 << number)) != 0, F.lit(False))
        else:
            test = F.lit(True)  # no mandatory trigram: every text is searched
        test = test & t.rlike(LONG_FORM.get(rule.name, rule.regex))
        found.append(F.when(test, _spans(t, number, rule)).otherwise(none))
    return joined.select(*rows.columns, F.array_sort(F.concat(*found)).alias("secret_spans"))


def joined_spans(spans: Column, rules: list[Rule] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_rows(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base
    spans and all spans."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return secret_spans(docs).select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"), joined_spans(spans).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mask`` (overlapping spans
    become one). Null texts stay null."""
    found = secret_spans(docs, keep=tuple(docs.columns))
    t = F.col("text")
    lead = "struct<start:int,stop:int>"

    def gap(at: Column, s: Column) -> Column:
        """The text between what is masked so far and a span beyond it."""
        fresh = F.array(F.struct(at.alias("start"), s["start"].alias("stop")))
        return F.when(s["start"] >= at, fresh).otherwise(F.array().cast(f"array<{lead}>"))

    def masked(spans: Column) -> Column:
        gaps = _folded(spans, lambda at, s: F.greatest(at, s["stop"]), F.greatest, gap, lead)
        last = F.struct(F.array_max(F.transform(spans, lambda s: s["stop"])).alias("start"), F.length(t).alias("stop"))
        # The text in pieces of PIECE characters: a place is found without walking from the text's start.
        return _bound(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda pieces: F.array_join(
            F.transform(F.array_append(gaps, last), lambda g: _between(pieces, g["start"], g["stop"])), mask))

    text = F.when(F.size("secret_spans") > 0, _bound(F.col("secret_spans"), masked)).otherwise(t)
    return found.select(*[text.alias(c) if c == "text" else F.col("secret_row")[c].alias(c) for c in docs.columns])


#: Characters of a piece of a text that is cut up.
PIECE = 1024


def _between(pieces: Column, start: Column, stop: Column) -> Column:
    """Characters start to stop of the text that ``pieces`` make up."""
    first = F.floor(start / F.lit(PIECE)).cast("int")
    count = F.greatest(F.ceil(stop / F.lit(PIECE)).cast("int") - first, F.lit(0))

    def part(piece: Column, i: Column) -> Column:
        base = (first + i) * PIECE
        return F.substring(piece, F.greatest(start - base, F.lit(0)) + 1, F.least(stop - base, F.lit(PIECE)) - F.greatest(start - base, F.lit(0)))

    return F.array_join(F.transform(F.slice(pieces, first + 1, count), part), "")
