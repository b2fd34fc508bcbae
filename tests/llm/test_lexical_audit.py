"""Operators 12 and 13 against plain Python and their SQL."""

import math
import re
from collections import Counter
from itertools import permutations

import pytest

from billbook.llm import audit, lexical
from billbook.llm.queries import ORACLE, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranking(docs, items, top=10):
    """Sorted (item_id, rank, doc_id, score) from lists of (id, text)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for t in set(terms(text)) & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * (10 + (90 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def ranked(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "The quick Brown-fox"), (2, "ÉTÉ été naïve"), (3, None), (4, " .,; "), (None, "lazy dog"), (5, "quick quick fox"),
         (5, "another text of item five"), (1, "The quick Brown-fox"), (6, "absent words only")]
TEXTS = [(1, "the quick brown fox"), (2, "The QUICK brown fox! the quick"), (3, None), (4, ""), (5, "\t \n"), (6, "été, naïve été x"),
         (7, "lazy_dog lazy.dog"), (7, "lazy_dog lazy.dog"), (None, "lazy dog"), (8, "foxes quickly thequick"), (9, "fox" * 3), (10, "text item five the"),
         (11, "A" * 50 + " fox"), (12, "the " * 400000 + "fox"), (13, "x" * (3 << 20) + " quick")]


@pytest.mark.parametrize("limit", [lexical.BLOCK_BYTES, 30])
def test_ranking_equals_brute_force(spark, make_docs, limit):
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id long, text string, score string")
    got = ranked(lexical.ranked_search(make_docs(TEXTS).repartition(3), items, limit=limit))
    assert got == brute_ranking(TEXTS, ITEMS)


def test_ranking_ties_go_to_the_smaller_id(spark, make_docs):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "other")]
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    got = ranked(lexical.ranked_search(make_docs(docs).repartition(4), items))
    assert got == brute_ranking(docs, [(1, "same words")])
    assert sorted(r[2] for r in got) == list(range(1, 11))


def test_ranking_of_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical.ranked_search(make_docs([]), items).count() == 0
    assert lexical.ranked_search(make_docs([(1, "word")]), items.limit(0)).count() == 0
    assert lexical.ranked_search(make_docs([(1, None), (2, "")]), items).count() == 0


def test_a_stretch_never_cuts_a_term(monkeypatch):
    import numpy as np

    monkeypatch.setattr(lexical, "STRETCH", 5)
    data = lexical.TERM_TABLE[np.frombuffer("ab cdefghijklmn op  é qrstuv".encode(), dtype=np.uint8)]
    assert " ".join("".join(lexical.stretches(data)).split()) == "ab cdefghijklmn op é qrstuv"


def brute_audit(rows, labels):
    """Rows of (doc_id, source, text); labels {doc_id: (quality, toxic)}."""
    first = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    failed = []
    for doc_id, source, text in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and doc_id > first[t]}
        failed.append((source or "", fails, *labels.get(doc_id, (None, None))))
    out = []
    for part in {f[0] for f in failed}:
        own, shapley = [f for f in failed if f[0] == part], Counter()
        rows_ = []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                hit = [f for f in left if f[1][letter]]
                left = [f for f in left if not f[1][letter]]
                every = [f for f in own if f[1][letter]]
                shapley[letter] += len(hit)
                rows_.append(("".join(order), step, letter, len(left), len(hit), len(every) - len(hit),
                              sum(sum(f[1].values()) == 1 for f in every), sum(f[2] == 1 for f in hit), sum(f[3] == 1 for f in hit)))
        out += [(part, r[0], r[1], *r[3:], shapley[r[2]]) for r in rows_]
    return sorted(out)


AUDIT_DOC = "doc_id long, source string, text string, digest string, part string"
AUDIT_LABEL = "doc_id long, quality int, toxic int"


def audited(df):
    return sorted(map(tuple, df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                       "good_lost", "toxic_lost", "shapley").collect()))


@pytest.mark.parametrize("shard", [audit.SHARD, 64])
def test_audit_equals_brute_force(spark, shard):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "a", None), (2, "a", ""), (3, None, long), (4, "", long), (5, "a", long.upper()), (6, "b", long + " 5%"), (None, "b", long),
            (7, "b", "same " * 60), (7, "b", "same " * 60), (8, "a", "same " * 60), (9, "a", "é" * 30), (10, "b", " \n\t "),
            (11, "c", "x y " * 50000), (12, "c", "Ä Ö word" + " w" * 55), (12, "a", "an id that stands twice")]
    labels = [(3, 1, 0), (4, 1, 1), (5, 0, 1), (8, 1, 1), (None, 1, 1), (99, 1, 1), (12, 1, None)]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], AUDIT_DOC).repartition(3)
    got = audited(audit.filter_audit(docs, spark.createDataFrame(labels, AUDIT_LABEL), shard))
    assert got == brute_audit(rows, {i: (q, t) for i, q, t in labels if i is not None})


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], AUDIT_DOC)
    labels = spark.createDataFrame([], AUDIT_LABEL)
    assert audit.filter_audit(docs, labels).count() == 0
    blank = spark.createDataFrame([(1, "a", None, "", ""), (2, "a", " ", "", "")], AUDIT_DOC)
    assert audited(audit.filter_audit(blank, labels)) == brute_audit([(1, "a", None), (2, "a", " ")], {})


def test_a_word_has_one_number_in_all_shards(spark, make_docs):
    docs = make_docs([(i, f"common w{i % 7} x{i}") for i in range(50)]).repartition(4)
    shards = audit.csr_shards(docs, 64).cache()
    words = shards.selectExpr("shard", "posexplode(words) as (place, word)")
    found = words.join(audit.numbered_words(shards), ["shard", "place"]).select("word", "number").distinct().collect()
    assert len(found) == len({r["word"] for r in found}) == len({r["number"] for r in found}) == 58


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_filter_audit"])
def test_query_equals_its_sql(spark, sf_small, name):
    from tools.compare import compare, duck

    assert compare(QUERIES[name](spark, sf_small), ORACLE[name], duck(sf_small))["ok"]


def test_audit_row_counts_need_no_running_sums():
    import tracemalloc

    import numpy as np

    from billbook.llm.audit import row_counts

    flags = np.tile(np.array([True, False, True, True]), 1 << 18)
    offsets = np.array([0, 0, 3, 4, 1 << 18, 1 << 18, len(flags)])
    tracemalloc.start()
    counts = row_counts(flags, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [int(flags[a:b].sum()) for a, b in zip(offsets, offsets[1:])]
    assert counts.dtype == np.int64 and peak < len(flags)  # a running sum is eight times as large
    assert row_counts(flags[:0], np.array([0, 0])).tolist() == [0]


def test_audit_matrix_is_built_in_pieces():
    import tracemalloc
    from collections import Counter

    import numpy as np

    from billbook.llm.audit import csr

    texts = ["", "a b a", " ", "\tb\n\u00e9 \u00e9x ", "end", "start  end", " " * 70_000, "", " " * 70_000] + [f"w{i % 97} w{i % 5} w{i} filler words" for i in range(40_000)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    whole = csr(data, offsets, 1 << 30)  # and all is imported
    tracemalloc.start()
    words, sizes, columns, counts = csr(data, offsets, 1 << 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(data)  # all at once took twice that
    known, first = words.to_pylist(), np.concatenate(([0], np.cumsum(sizes)))
    assert len(sizes) == len(texts) and len(set(known)) == len(known)
    for i, text in enumerate(texts):
        cells = slice(first[i], first[i + 1])
        assert (np.diff(columns[cells]) > 0).all()
        expected = Counter(w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text))
        assert dict(zip((known[c] for c in columns[cells]), counts[cells])) == expected
    for blank in ([0, 0], [0, 3], [0, 0, 3, 3]):
        assert csr(np.full(blank[-1], 0x20, np.uint8), np.array(blank), 2)[1].tolist() == [0] * (len(blank) - 1)
    assert whole[0].equals(words) and all((x == y).all() for x, y in zip(whole[1:], (sizes, columns, counts)))
