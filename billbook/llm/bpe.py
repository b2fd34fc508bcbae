"""Operator 2: byte-pair encoding and decoding by per-prefix dynamic
programming.

Byte-pair encoding keeps a prefix property: for every prefix of a word there
is exactly one token that ends its encoding. So the last token of each prefix
is stored, left to right: the tokens that end at a place come from one walk of
the word through the suffix automaton of the vocabulary (the state is the
longest suffix read so far that lies in a token; the tokens that end there
stand on its suffix links), and the candidate is the one whose preceding prefix is encoded and whose pair with that prefix's
last token is compatible (encoding the two tokens' bytes as one text gives
these two tokens back). Back-pointers then give the exact ids.

Texts are cut into words by the tokenizer's pattern first, and special tokens
found in the text stand for themselves, as the tokenizer file says. Words
recur, so each worker remembers their encodings in two generations of CACHE
words at most: when the young one is full it replaces the old one, and words
met again move to the new young one, so frequent words are never forgotten.

Edge cases: null and empty texts have no tokens; rows are encoded one by one,
rows with a null or repeated doc_id too; words of over LONG bytes are encoded
but not remembered; an empty table gives no rows; extra columns are never read. Decoding maps ids
to bytes and reads them as UTF-8, invalid bytes becoming U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CACHE = 300_000
LONG = 256
#: Tokens and rows that a task gathers before it gives them out.
HELD = 1 << 17

#: White space as the tokenizer's pattern sees it (Unicode White_Space).
_S = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The byte of each letter that byte-level vocabularies write: printable
    bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> dict:
    """Vocabulary, merges and special tokens of a byte-level tokenizer file
    (read where the session runs; the tables are shipped with the tasks)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = []
    for m in spec["model"]["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ", 1)
        merges.append((bytes(to_byte[c] for c in a), bytes(to_byte[c] for c in b)))
    return {"tokens": tokens, "merges": merges, "special": special, "automaton": suffix_automaton(tokens)}


def suffix_automaton(tokens: dict[bytes, int]) -> dict[str, np.ndarray]:
    """The suffix automaton of all tokens: ``edge`` (state * 256 + byte) to
    ``target``, and per state its suffix ``link``, the ``size`` of its longest
    string, and the ``token`` which that string is, or -1. A token is the
    longest string of its state, for nothing stands before its first byte."""
    edges: list[dict[int, int]] = [{}]
    link, size, token_of = [-1], [0], [-1]

    def state(out: dict[int, int], up: int, length: int) -> int:
        edges.append(out)
        link.append(up)
        size.append(length)
        token_of.append(-1)
        return len(size) - 1

    def split(before: int, byte: int, old: int) -> int:
        """The strings of ``old`` that ``before`` and ``byte`` give, as a state of their own."""
        new = state(dict(edges[old]), link[old], size[before] + 1)
        link[old] = new
        while before != -1 and edges[before].get(byte) == old:
            edges[before][byte] = new
            before = link[before]
        return new

    for token, token_id in tokens.items():
        at = 0
        for byte in token:
            old = edges[at].get(byte)
            if old is not None:
                at = old if size[old] == size[at] + 1 else split(at, byte, old)
                continue
            before, at = at, state({}, 0, size[at] + 1)
            while before != -1 and byte not in edges[before]:
                edges[before][byte] = at
                before = link[before]
            if before != -1:
                old = edges[before][byte]
                link[at] = old if size[old] == size[before] + 1 else split(before, byte, old)
        token_of[at] = token_id
    pairs = [(s << 8 | b, t) for s, out in enumerate(edges) for b, t in out.items()]
    edge, target = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    return {"edge": edge, "target": target, "link": np.array(link), "size": np.array(size), "token": np.array(token_of)}


_codecs: dict[str, "Codec"] = {}


def codec_for(path: str, spec: dict) -> "Codec":
    """One codec per worker process and tokenizer file."""
    if path not in _codecs:
        _codecs[path] = Codec(spec)
    return _codecs[path]


class Codec:
    def __init__(self, spec: dict):
        self.ids = spec["tokens"]
        self.special = spec["special"]
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        #: id -> (left id, right id, rank) of the merge that makes the token first.
        self.parts: dict[int, tuple[int, int, int]] = {}
        #: (left id, right id) -> rank
        self.rank: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(spec["merges"]):
            pair = (self.ids[a], self.ids[b])
            self.rank.setdefault(pair, r)
            self.parts.setdefault(self.ids[a + b], (*pair, r))
        walk = spec["automaton"]
        self.edge = dict(zip(walk["edge"].tolist(), walk["target"].tolist()))
        self.link, self.size = walk["link"].tolist(), walk["size"].tolist()
        self.ends = self._ends(walk["token"].tolist())
        self.compatible = lru_cache(maxsize=200_000)(self._compatible)
        self.words: dict[str, str] = {}
        self.aged: dict[str, str] = {}
        self.split = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _ends(self, token: list[int]) -> list[tuple[tuple[int, int], ...]]:
        """Per state the (size, id) of the tokens that end its longest string,
        long ones first."""
        ends: list[tuple] = [()] * len(token)
        for s in sorted(range(1, len(token)), key=self.size.__getitem__):  # a link is shorter
            up = ends[self.link[s]]
            ends[s] = ((self.size[s], token[s]), *up) if token[s] >= 0 else up
        return ends

    def _compatible(self, left: int, right: int) -> bool:
        """Encoding the bytes of both tokens gives the two tokens back: no
        merge over their border comes before the merges that made them. The
        later of the two is undone, again and again, and the border pair of
        what is left compared with the merge just undone; of equal merges the
        one further left comes first."""
        limit = len(self.rank) + 1
        while True:
            if self.rank.get((left, right), limit) < limit:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is not None and (b is None or a[2] > b[2]):
                limit, left = a[2], a[1]
            elif b is not None:
                limit, right = b[2] + 1, b[0]
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """The last token of every prefix, then the back-pointers."""
        n = len(word)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        edge, link, longest, ends, compatible = self.edge, self.link, self.size, self.ends, self.compatible
        state = length = 0
        for end, byte in enumerate(word, 1):
            follow = edge.get(state << 8 | byte)
            while follow is None and state:
                state = link[state]
                length = longest[state]
                follow = edge.get(state << 8 | byte)
            if follow is None:  # no token holds the byte
                state = length = 0
                continue
            state, length = follow, length + 1
            # A shorter string of the state ends only with what its link ends with.
            # A token that is the whole prefix stands (each token encodes to itself).
            for n_bytes, token in ends[state if length == longest[state] else link[state]]:
                if n_bytes == end or compatible(last[end - n_bytes], token):
                    last[end], size[end] = token, n_bytes
                    break
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def word(self, w: str) -> str:
        """Comma-joined ids of a word, remembered."""
        got = self.aged.get(w) or ",".join(map(str, self.encode_word(w.encode("utf-8", "surrogatepass"))))
        if len(w) <= LONG:
            if len(self.words) >= CACHE:  # bounded memory: the old generation goes
                self.aged, self.words = self.words, {}
            self.words[w] = got
        return got

    def encode_joined(self, text: str) -> str:
        """The ids of a text as decimals joined by commas."""
        out = []
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        for part in parts:
            if part in self.special:
                out.append(str(self.special[part]))
            else:
                known = self.words
                for w in self.split.findall(part):
                    ids = known.get(w)
                    if ids is None:
                        ids = self.word(w)
                        known = self.words
                    out.append(ids)
        return ",".join(out)

    def encode(self, text: str | None) -> list[int]:
        joined = self.encode_joined(text or "")
        return [int(x) for x in joined.split(",")] if joined else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def token_rows(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: token count, digest of the ids, digest of what
    the ids decode to; with ``keep_ids`` the ids themselves."""
    spec = docs.sparkSession.sparkContext.broadcast(load(path))  # a tokenizer file: a fixed size

    def code(batches):
        codec = codec_for(path, spec.value)
        as_bytes = {str(i): t for i, t in codec.bytes.items()}
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

        def packed(rows, lists):
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            if not keep_ids:
                return pa.RecordBatch.from_arrays(columns, names=names)
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
            return pa.RecordBatch.from_arrays([*columns, ids], names=[*names, "ids"])

        rows, lists, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                joined = codec.encode_joined(text.as_py() or "")
                ids = joined.split(",") if joined else []
                back = b"".join(map(as_bytes.__getitem__, ids)).decode("utf-8", "replace")
                rows.append((doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
                if keep_ids:
                    lists.append(np.array(ids, dtype=np.int32))
                held += len(ids) + 1
                if held >= HELD:  # bounded memory: give out what is there
                    yield packed(rows, lists)
                    rows, lists, held = [], [], 0
        if rows:
            yield packed(rows, lists)

    return docs.select("doc_id", "text").mapInArrow(code, OUT + (", ids array<int>" if keep_ids else ""))
