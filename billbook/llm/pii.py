"""Operator 11: personal data by weak supervision.

Patterns propose spans: the four base kinds, which are verified and always
stay, and wider ones (masked mail addresses, local phone numbers, tax and
account numbers, titled names). On each span regex, checksum, gazetteer and
context labelers vote personal (2), abstain (1) or not personal (0). EM over
the counts of all vote patterns estimates how reliable each labeler is, and
its posteriors train the final classifier of spans on their shape and
neighbouring words; the classifier decides on the spans beyond the base.

A text is read once: its spans, votes and features (a small part of it) are
written to the shared folder, and everything later reads those. Vote patterns
are counted over all spans; only the patterns (3 ** 8 a kind at most) and
SAMPLE distinct, counted spans for the classifier reach the driver.

Every pattern starts at a place of its own and never goes back over another's
text, so long runs of digits or letters take time in proportion.

Edge cases: a null or empty text has no spans; rows are read one by one
(repeated rows alike, a null doc_id is kept); an empty table gives no rows;
extra columns are never read, and ``masked`` carries them along.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import free_name, materialize, sample_cut

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_masked", "ipv6", "phone_local", "ssn", "iban", "name")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A number that fails from its first digit fails from the others too.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

AT, DOT = r"\x20?[(\[{]at[)\]}]\x20?", r"(?:\.|\x20?[(\[{]dot[)\]}]\x20?)"
WIDER = {
    "email_masked": re.compile(rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{{1,64}}{AT}[a-z0-9-]{{1,63}}(?:{DOT}[a-z0-9-]{{1,63}}){{1,4}}"),
    "ipv6": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "phone_local": re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9A-Za-z-])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "iban": re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20([^\W\d_]{2,20})(?:\x20[^\W\d_]{2,20})?"),
}

# FIXED VALUES: gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl be at ch pl pt br mx us ca au nz jp cn in ru eu".split())
COUNTRY_CODES = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 359 380 420 421 971 972".split())
ISSUERS = tuple("4 51 52 53 54 55 2 34 37 36 38 6011 62 65 35".split())
IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE".split())
FIRST_NAMES = frozenset("""james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica
    thomas sarah charles karen anna peter hans klaus jürgen ursula monika pierre marie jean claire luc sophie josé carmen juan maría luis ana
    carlos lucía""".split())
CUES = {
    "email": "email mail e-mail contact courriel correo write", "ip": "ip host server address login logged",
    "card": "card visa mastercard credit debit karte carte tarjeta", "phone": "phone tel telephone call mobile fax cell telefon téléphone teléfono",
    "ssn": "ssn social security tax", "iban": "iban account konto compte cuenta bank", "name": "name patient signed dear from contact",
}
CUES = {k: frozenset(v.split()) for k, v in CUES.items()}
ANTI_CUES = frozenset("version release isbn issn order invoice article page figure table chapter serial part example sample dummy test model sku".split())
#: The cue list and gazetteer of a wider kind are those of its base kind.
LIKE = {"email_masked": "email", "ipv6": "ip", "phone_local": "phone"}

CONTEXT = 60
COMPANY = 120
WORD = re.compile(r"[^\W\d_][\w-]*")

STRICT = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,24}"),
    "ip": re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}"),
    "card": re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}"),
}
LONGEST = 320


@dataclass(slots=True)
class Span:
    kind: int
    start: int
    stop: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a domain after it, and the local part that reaches it."""
    last = 0
    for m in DOMAIN.finditer(text):
        begin = m.start()
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < m.start():
            last = m.end()
            yield begin, last


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind that pass their test."""
    out = []
    if "@" in text:
        out += [Span(0, a, b, True) for a, b in emails(text)]
    # A part of many digits is over 255 (or zeros in front of a short number).
    out += [Span(1, *m.span(), True) for m in IP.finditer(text) if all(len(g.lstrip("0")) < 4 and int("0" + g[-3:]) <= 255 for g in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = digits_of(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(Span(2, *m.span(), True))
    if "+" in text:
        out += [Span(3, *m.span(), True) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


def candidate_spans(text: str) -> list[Span]:
    """Base spans, then wider ones that lie beside all spans before them, by
    kind as listed, then place."""
    out = base_spans(text)
    taken = sorted((s.start, s.stop) for s in out)
    for number, kind in enumerate(KINDS):
        regex = WIDER.get(kind)
        if regex is None or kind == "email_masked" and "at" not in text.lower():
            continue
        new = []
        for m in regex.finditer(text):
            a, b = m.span()
            at = bisect_left(taken, (b,))
            if at and max(stop for _, stop in taken[max(0, at - 4): at]) > a:
                continue
            new.append(Span(number, a, b, False))
        if new:
            out += new
            taken = sorted([*taken, *((s.start, s.stop) for s in new)])
    return out


# ----------------------------------------------------------------- labelers
YES, ABSTAIN, NO = 2, 1, 0


def _format(kind: str, found: str, **_) -> int:
    regex = STRICT.get(kind)
    if regex is None:
        return ABSTAIN
    return YES if len(found) <= LONGEST and regex.fullmatch(found) else NO


def _edges(before: str, after: str, **_) -> int:
    """Whether the span stands alone or is cut out of a longer token."""
    left, right = before[-1:], after[:1]
    if left.isalnum() or right.isalnum() or left in "_/#=" and left or right in "_/=" and right:
        return NO
    return YES if (not left or left.isspace() or left in "([<\"':;,|") and (not right or right.isspace() or right in ")]>\"':;,.!?|") else ABSTAIN


def _checksum(kind: str, found: str, **_) -> int:
    if kind == "card":
        return YES if luhn(digits_of(found)) else NO
    if kind == "iban":
        plain = found.replace(" ", "")
        return YES if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else NO
    if kind == "ssn":
        return NO if found[:3] in ("000", "666") or found[0] == "9" or found[4:6] == "00" or found[7:] == "0000" else YES
    if kind == "phone_local":
        return NO if digits_of(found)[0] in "01" else YES
    return ABSTAIN


def _gazetteer(kind: str, found: str, **_) -> int:
    if kind in ("email", "email_masked"):
        known = re.split(r"[^A-Za-z]+", found[-30:].rstrip(")]}"))[-1].lower() in TOP_DOMAINS
    elif kind == "phone":
        known = digits_of(found).startswith(COUNTRY_CODES)
    elif kind == "card":
        known = digits_of(found).startswith(ISSUERS)
    elif kind == "iban":
        known = found[:2] in IBAN_COUNTRIES
    elif kind == "name":
        words = [w.lower() for w in WORD.findall(found)][1:]
        return YES if any(w in FIRST_NAMES for w in words) else NO if not found.split()[1][0].isupper() else ABSTAIN
    else:
        return ABSTAIN
    return YES if known else NO


def _cue(kind: str, words: list[str], **_) -> int:
    return YES if CUES.get(LIKE.get(kind, kind), frozenset()).intersection(words) else ABSTAIN


def _anti_cue(words: list[str], **_) -> int:
    return NO if ANTI_CUES.intersection(words) else ABSTAIN


def _varied(kind: str, found: str, **_) -> int:
    """Digits all equal or counting up are no one's number."""
    d = digits_of(found)
    if len(d) < 7 or kind in ("email", "email_masked", "ip", "ipv6"):
        return ABSTAIN
    steps = {(ord(b) - ord(a)) % 10 for a, b in zip(d, d[1:])}
    return NO if steps <= {0} or steps <= {1} else ABSTAIN


def _company(near: int, **_) -> int:
    return YES if near else ABSTAIN


LABELERS = {"format": _format, "edges": _edges, "checksum": _checksum, "gazetteer": _gazetteer, "cue": _cue,
            "anti_cue": _anti_cue, "varied": _varied, "company": _company}

# ----------------------------------------------------------------- features
WIDTH = 2048


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


def shape(found: str) -> str:
    """Classes of characters, runs as one: 555-0199 is d-d."""
    out = []
    for c in found[:LONGEST]:
        k = "d" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def judged(text: str, spans: list[Span]) -> list[tuple[str, list[int]]]:
    """(votes, feature slots) of each span."""
    starts = sorted(s.start for s in spans)
    out = []
    for s in spans:
        kind, found = KINDS[s.kind], text[s.start: s.stop]
        before, after = text[max(0, s.start - CONTEXT): s.start], text[s.stop: s.stop + CONTEXT]
        words = [w.lower() for w in WORD.findall(before)][-6:]
        near = bisect_right(starts, s.stop + COMPANY) - bisect_left(starts, s.start - COMPANY) - 1
        facts = {"kind": kind, "found": found, "before": before, "after": after, "words": words, "near": near}
        votes = "".join(str(f(**facts)) for f in LABELERS.values())
        tail = [w.lower() for w in WORD.findall(after)][:1]
        names = [f"kind {kind}", f"shape {kind} {shape(found)}", f"length {kind} {min(len(found), 40) // 4}",
                 *(f"before {w}" for w in words[-2:]), *(f"after {w}" for w in tail), f"edge {before[-1:]} {after[:1]}"]
        out.append((votes, sorted({_slot(n) for n in names})))
    return out


ROWS = "doc_id long, spans array<struct<kind int, start int, stop int, base boolean, votes string, slots array<int>>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()),
                                ("votes", pa.string()), ("slots", pa.list_(pa.int32()))]))


def judged_rows(docs: DataFrame) -> DataFrame:
    """One row per document: its candidate spans with votes and features."""
    def scan(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans = candidate_spans(text)
                rows.append([{"kind": s.kind, "start": s.start, "stop": s.stop, "base": s.base, "votes": v, "slots": f}
                             for s, (v, f) in zip(spans, judged(text, spans))] if spans else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, ROWS)


# ----------------------------------------------------------------- learning
#: Votes a labeler starts with, so that few spans can't turn it round.
TRUST = 25.0
#: Distinct spans (kind, votes, features; counted) that the classifier is fitted on.
SAMPLE = 20000
PULL = 0.05


def reliabilities(patterns: list[tuple[int, str, int]], rounds: int = 50) -> dict:
    """EM for personal and not, from (kind, votes, count): a prior per kind
    and, per labeler, the log odds of its three votes. A labeler is taken to
    be no worse than chance and abstaining says nothing."""
    patterns = sorted(patterns)
    kind = np.array([k for k, _, _ in patterns], dtype=int)
    vote = np.array([[int(c) for c in v] for _, v, _ in patterns], dtype=int).reshape(-1, len(LABELERS))
    n = np.array([c for _, _, c in patterns], dtype=float)
    start = np.array([[0.45, 0.45, 0.10], [0.10, 0.45, 0.45]]) * TRUST  # class 0, class 1: no, abstain, yes
    weights = np.tile(np.log(start[1] / start[0]), (len(LABELERS), 1))
    prior = np.full(len(KINDS), 0.5)
    lab = np.arange(len(LABELERS))
    for _ in range(rounds if len(n) else 0):
        odds = np.log(prior / (1 - prior))[kind] + weights[lab, vote].sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        yes = np.bincount(kind, weights=n * post, minlength=len(KINDS))
        prior = (yes + TRUST / 2) / (np.bincount(kind, weights=n, minlength=len(KINDS)) + TRUST)
        for j in lab:
            like = []
            for cls, mass in ((0, n * (1 - post)), (1, n * post)):
                seen = np.bincount(vote[:, j], weights=mass, minlength=3) + start[cls]
                like.append(seen / seen.sum())
            raw = np.log(like[1] / like[0])
            weights[j] = min(0.0, raw[0]), 0.0, max(0.0, raw[2])
    return {"prior": np.log(prior / (1 - prior)), "weights": weights}


def vote_odds(model: dict, kind: int, votes: str) -> float:
    return float(model["prior"][kind] + sum(model["weights"][j][int(c)] for j, c in enumerate(votes)))


def fit_classifier(rows: list[tuple[int, str, list[int], int]], em: dict, rounds: int = 200) -> np.ndarray:
    """Logistic weights: one per feature slot, then one that multiplies the
    labelers' log odds. The targets are the posteriors. Each row stands twice,
    with and without its votes, so that shape and neighbours must explain what
    the votes know; weights are pulled to 0 and, for the votes, to 1."""
    w = np.zeros(WIDTH + 1)
    w[-1] = 1.0
    if not rows:
        return w
    odds = np.array([vote_odds(em, k, v) for k, v, _, _ in rows])
    y = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    n = np.log1p(np.array([c for *_, c in rows], dtype=float))
    n /= n.sum()
    row = np.repeat(np.arange(len(rows)), [len(f) for _, _, f, _ in rows])
    slot = np.concatenate([np.array(f, dtype=int) for _, _, f, _ in rows])
    odds = np.clip(odds, -5, 5)
    rest = w.copy()
    squares = np.full(WIDTH + 1, 1e-8)
    for _ in range(rounds):
        own = np.bincount(row, weights=w[slot], minlength=len(rows))
        gradient = PULL * (w - rest) / len(rows) ** 0.5
        for with_votes in (True, False):
            z = own + w[-1] * odds if with_votes else own
            miss = n * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            gradient[:-1] += np.bincount(slot, weights=miss[row], minlength=WIDTH)
            gradient[-1] += float(miss @ odds) if with_votes else 0.0
        squares += gradient ** 2
        w = w - 0.2 * gradient / np.sqrt(squares)
    return w


def learn(rows: DataFrame, size: int = SAMPLE) -> dict:
    """Labeler reliabilities from the vote patterns of all spans, and the
    classifier from ``size`` distinct spans at most, chosen by their hash."""
    spans = rows.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.slots")
    counted = materialize(spans.groupBy("kind", "votes", "slots").count(), "pii-distinct")
    patterns = counted.groupBy("kind", "votes").agg(F.sum("count").alias("n")).collect()  # 3 ** 8 a kind at most
    em = reliabilities([(r["kind"], r["votes"], r["n"]) for r in patterns])
    keep, *_ = sample_cut(counted, size, by=F.xxhash64("kind", "votes", "slots"))
    chosen = counted.filter(keep).orderBy("kind", "votes", "slots")
    points = [(r["kind"], r["votes"], list(r["slots"]), r["count"]) for r in chosen.collect()]
    return {**em, "classifier": fit_classifier(points, em)}


def probability(model: dict, kind: int, votes: str, slots: list[int]) -> float:
    w = model["classifier"]
    z = w[slots].sum() + w[-1] * min(5.0, max(-5.0, vote_odds(model, kind, votes)))
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def listed(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by kind as listed, then start."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


OUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
       "n_added long, n_doubted long")


def pii_rows(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: base counts and digest, all spans, how many the
    classifier added, and on how many base spans it doubts (they stay)."""
    rows = materialize(judged_rows(docs), "pii-spans")
    model = learn(rows)

    def decide(batches):
        for batch in batches:
            out = []
            for spans in batch.column(1).to_pylist():
                p = [probability(model, s["kind"], s["votes"], s["slots"]) for s in spans]
                base = [(s["kind"], s["start"], s["stop"]) for s in spans if s["base"]]
                added = [(s["kind"], s["start"], s["stop"]) for s, x in zip(spans, p) if not s["base"] and x >= threshold]
                counts = [sum(k == i for k, _, _ in base) for i in range(len(BASE))]
                out.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added), len(added),
                            sum(s["base"] and x < threshold for s, x in zip(spans, p))))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                                             names=[c.split()[0] for c in OUT.split(", ")])

    return rows.mapInArrow(decide, OUT)


def masked(docs: DataFrame, model: dict | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span replaced by its kind (``[EMAIL]``); of spans
    that overlap, the first. Null texts stay null; other columns are kept."""
    model = model or learn(materialize(judged_rows(docs), "pii-spans"))
    plain = free_name(docs, "pii_text")

    def mask(batches):
        for batch in batches:
            texts = []
            for text in batch.column(batch.schema.get_field_index(plain)).to_pylist():
                spans = candidate_spans(text or "")
                keep = [s for s, (v, f) in zip(spans, judged(text or "", spans)) if s.base or probability(model, s.kind, v, f) >= threshold]
                parts, at = [], 0
                for s in sorted(keep, key=lambda s: (s.start, s.kind)):
                    if s.start >= at:
                        parts += [text[at: s.start], f"[{KINDS[s.kind].upper()}]"]
                        at = s.stop
                texts.append(text if not parts else "".join(parts) + text[at:])
            yield batch.set_column(batch.schema.get_field_index(plain), plain, pa.array(texts, pa.string()))

    # The text under a name of its own and the rest in one struct, so that no names clash.
    carried = docs.select(F.col("text").alias(plain), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(f"{plain}_row"))
    done = carried.mapInArrow(mask, carried.schema)
    return done.select(*[F.col(plain).alias(c) if c == "text" else F.col(f"{plain}_row")[c].alias(c) for c in docs.columns])
