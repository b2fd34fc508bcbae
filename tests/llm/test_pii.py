"""Operator 11: base spans against plain regular expressions, the added ones
against made-up personal data and look-alikes."""

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from billbook.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def own(text):
    return sorted(((pii.KINDS[s.kind], s.start, s.stop) for s in pii.base_spans(text or "")), key=lambda s: (pii.KINDS.index(s[0]), s[1]))


PARTS = st.sampled_from(["a", "b.c", "@", "x.org", "@mail.de", " ", "-", "+", "1", "12", "255", "256", "007", ".", "4111111111111111",
                         "+1 (555) 010-9999", "é", "\n", "(", ")", "%", "4111 1111-1111 1111", "0000000000000"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_base_equals_plain_regex(text):
    assert own(text) == brute(text)


def test_base_equals_plain_regex_on_documents(corpus):
    assert sum(len(brute(t)) for t in corpus.values())
    for text in corpus.values():
        assert own(text) == brute(text)


@pytest.mark.parametrize("text", ["1" * 300000, "a" * 300000, "a@" * 150000, "1." * 150000, "+1(" * 100000, "a1_" * 100000 + "@",
                                  "AB12 " * 60000, "x (at) " * 40000, "1-1 " * 80000])
def test_long_runs_take_linear_time(text):
    t0 = time.perf_counter()
    spans = pii.candidate_spans(text)
    pii.judged(text, spans)
    assert time.perf_counter() - t0 < 8


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


FILLER = "some plain words of a text that names no one at all"


def made_up(n=400, seed=3):
    """(id, text, personal?) with one wider span each."""
    rng, out = random.Random(seed), []

    def digits(k, first="23456789"):
        return rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(k - 1))

    for i in range(n):
        ssn = f"{rng.randint(100, 599)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
        local = f"({digits(3)}) {digits(3)}-{digits(4)}"
        yes = [f"my phone is {local} thanks", f"ssn {ssn} on file", f"write to user{i} (at) mail{i % 9} (dot) com please",
               f"email u{i}@mail{i % 7}.org or call {local} today"]
        no = [f"see version {ssn} here", f"order part {digits(3)}-{digits(3)}-{digits(4)}/7", f"serial {rng.choice(['000', '666'])}-12-3456 of the model",
              f"sku test x={digits(3)}.{digits(3)}.{digits(4)}"]
        good = i % 2 == 0
        out.append((i, f"{FILLER} {rng.choice(yes if good else no)} {FILLER}", good))
    return out


def test_wider_spans_are_told_from_look_alikes(make_docs):
    made = made_up()
    got = rows_of(pii.pii_rows(make_docs([(i, t) for i, t, _ in made])))
    right = sum((got[i]["n_added"] > 0) == good for i, _, good in made)
    assert right >= 0.95 * len(made)


def test_reliabilities_find_a_bad_labeler():
    """Three labelers follow the truth, 'cue' votes by chance."""
    rng, counts = random.Random(1), {}
    for _ in range(6000):
        truth = rng.random() < 0.4
        votes = [pii.ABSTAIN] * len(pii.LABELERS)
        for j, accuracy in ((0, 0.9), (1, 0.85), (3, 0.8), (4, 0.5)):
            right = rng.random() < accuracy
            votes[j] = pii.YES if truth == right else pii.NO
        key = (7, "".join(map(str, votes)))
        counts[key] = counts.get(key, 0) + 1
    weights = pii.reliabilities([(k, v, n) for (k, v), n in counts.items()])["weights"]
    spread = weights[:, pii.YES] - weights[:, pii.NO]
    assert spread[0] > spread[3] > 1.5 and spread[1] > 1.5 and spread[4] < 0.6


def test_rows_of_edge_documents(spark, make_docs, edge_docs):
    got = pii.pii_rows(edge_docs).collect()
    assert len(got) == 10 and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got)
    assert pii.pii_rows(make_docs([])).count() == 0
    docs = spark.createDataFrame([(None, "a@b.cd", "1"), (1, None, "2"), (1, "ip 10.0.0.1 x@y.zz a@b.cd", "3"), (1, "ip 10.0.0.1 x@y.zz a@b.cd", "3")],
                                 "doc_id long, text string, spans string")
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["spans"]) for r in pii.pii_rows(docs).collect())
    both = "email:12:18,email:19:25,ip:3:11"
    assert got == [("1", 0, 0, ""), ("1", 2, 1, both), ("1", 2, 1, both), ("None", 1, 0, "email:0:6")]


def test_query_rows_equal_brute_force(spark, sf_small, corpus):
    from billbook.llm.queries import QUERIES

    got = rows_of(QUERIES["op11_personal_data"](spark, sf_small))
    assert got.keys() == corpus.keys()
    for doc_id, text in corpus.items():
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[doc_id]
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_masked_texts(spark):
    docs = spark.createDataFrame([(1, "mail a@b.org, ip 1.2.3.4!", "x"), (2, None, "y"), (3, "nothing", "z")], "doc_id long, text string, pii_text string")
    got = {r["doc_id"]: (r["text"], r["pii_text"]) for r in pii.masked(docs).collect()}
    assert got == {1: ("mail [EMAIL], ip [IP]!", "x"), 2: (None, "y"), 3: ("nothing", "z")}


def test_learning_is_bounded(spark, make_docs):
    docs = make_docs([(i, f"w{i} mail u{i}@h{i}.org and x{i}") for i in range(300)])
    rows = pii.judged_rows(docs)
    seen = []
    real = pii.fit_classifier
    try:
        pii.fit_classifier = lambda points, em: seen.append(len(points)) or real(points, em)
        pii.learn(rows, size=50)
    finally:
        pii.fit_classifier = real
    assert 0 < seen[0] <= 50
