"""Byte-pair encoding by a deterministic automaton built from the merges, one gadget per merge.

The automaton starts with one state that every base symbol leaves and re-enters.  The gadget of
merge k, (u, v) -> w, works on the state p that the arcs labelled u enter: p is copied without its
arc v, the arcs u are led to the copy, and w gets an arc from wherever u has one to where v led.
So a state is known by the token that enters it, its arcs only depend on the merges before it,
and the successive gadgets are kept as what each changes: the arc that it takes away, and the state
and arcs that its new token inherits (``Automaton.arc`` follows that).  Spelt out, the arcs would be
tokens times tokens, too many for an executor.  The paths of the automaton spell exactly the
correct tokenisations, and every prefix of a word has exactly one.

Words are read byte by byte by the deterministic form of that automaton.  Its states say which
suffix of what was read can still grow into a token, and which tokens end where such a token may
begin; so a state and a byte give the one token that ends there, and the next state.  Transitions are
worked out when first met and kept in a table.  Encoding is one look-up a byte, and a walk
back over the tokens that the states name.  Decoding emits the labels of the arcs.

Normalisation and pre-splitting are those of the vocabulary file's configuration.  Special tokens
are cut out of the raw text first.  For texts of the first 256 code points, where they come down to
lower case and one pattern, Python's own do them; other texts are left to the library's normaliser
and splitter, whose tables of Unicode differ from Python's.

Null text is empty and has no tokens.  Very long texts and words take time and memory linear in
their length.  Rows are independent, so ties, repeated rows and extra columns, whatever their
names, do not matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import CACHES, map_slices, texts

CACHED_WORDS = 100_000
CACHED_ARCS = 300_000
CACHED_STATES = 100_000
TOKEN, OPEN = "token", "open"  # no symbol has more than one character
LONG_WORD = 48


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Automaton:
    """Tokens are numbered as in the vocabulary; a token also names the state that its arc enters."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "</w>"):
        self.labels = {i: t for t, i in vocab.items()}
        alphabet = byte_alphabet()
        # A last symbol, which carries the suffix, is one character like the others.
        last = {c: chr(0xE000 + b) for b, c in enumerate(alphabet)}
        self.inner, self.final = alphabet, last

        def spelt(token: str) -> str:
            return token[: -len(suffix) - 1] + last[token[-len(suffix) - 1]] if suffix and token.endswith(suffix) and len(token) > len(suffix) else token

        # By token; -1 for those that no merge makes.
        self.born, self.left, self.right = ([-1] * (max(vocab.values(), default=-1) + 1) for _ in range(3))
        self.gadget: dict[tuple[int, int], int] = {}
        self.ids = {spelt(c): vocab[c] for c in alphabet} | {last[c]: vocab[c + suffix] for c in alphabet if c + suffix in vocab}
        for k, (u, v) in enumerate(merges):
            a, b = vocab[u], vocab[v]
            w = vocab[(u[: -len(suffix)] if suffix and u.endswith(suffix) and len(u) > len(suffix) else u) + v] if u + v not in vocab else vocab[u + v]
            self.gadget[a, b] = k
            if self.born[w] >= 0:
                raise ValueError("two merges make one token")
            self.born[w], self.left[w], self.right[w] = k, a, b
            self.ids[spelt(self.labels[w])] = w
        self.prefixes = {t[:i] for t in self.ids for i in range(1, len(t))}
        self.length = [0] * len(self.born)
        for t, i in self.ids.items():
            self.length[i] = len(t)
        self.table: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        """The start state alone: nothing read, no token before.

        A state is a row of the table: by byte the next state, under TOKEN the token that ends there,
        under OPEN the suffix that can still grow and the tokens that end where it may begin.
        """
        self.start: dict = {TOKEN: -1, OPEN: ("", (-1,))}
        self.states: dict[tuple[str, tuple[int, ...]], dict] = {self.start[OPEN]: self.start}

    def arc(self, state: int, token: int) -> bool:
        """Whether the finished automaton has an arc for the token out of the state."""
        key = state << 32 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= CACHED_ARCS:
                self.table.clear()
            known = self.table[key] = self._arc(state, token)
        return known

    def _arc(self, state: int, token: int) -> bool:
        born, upto = self.born, len(self.gadget)
        while True:
            k = self.gadget.get((state, token), upto)
            if k < upto:
                return False  # a gadget took this arc away
            if born[state] < 0 > born[token]:
                return True
            if born[token] >= born[state]:
                # The token's arc was added beside its left part's, once its own gadget had split the state.
                token, upto = self.left[token], born[token] + 1
            else:
                # The state is the one that its right part entered before its own gadget.
                state, upto = self.right[state], born[state]

    def _step(self, state: dict, symbol: str) -> dict:
        """The transition of the deterministic form, entered in the table."""
        grown, ends = state[OPEN]
        grown += symbol
        for k in range(len(grown)):
            token = self.ids.get(grown[k:])
            if token is not None and (ends[k] < 0 or self.arc(ends[k], token)):
                break
        else:
            raise ValueError(f"no token for {symbol!r}")
        ends = (*ends, token)
        k = 0
        while k < len(grown) and grown[k:] not in self.prefixes:
            k += 1
        # Only ends where a token can begin tell states apart; the last is the token itself.
        key = grown[k:], tuple([ends[i] if i == len(grown) or grown[i:] in self.prefixes else 0 for i in range(k, len(ends))])
        new = state[symbol] = self.states.setdefault(key, {TOKEN: token, OPEN: key})
        return new

    def word(self, text: str) -> list[int]:
        """The tokens of one pre-split word, given as the stand-ins of its bytes."""
        if not text:
            return []
        if len(self.states) > CACHED_STATES:
            self._forget()
        state, path = self.start, []
        for symbol in text[:-1] + self.final[text[-1]]:
            try:
                state = state[symbol]
            except KeyError:
                state = self._step(state, symbol)
            path.append(state)
        out, at, length = [], len(path), self.length
        while at:
            token = path[at - 1][TOKEN]
            out.append(token)
            at -= length[token]
        return out[::-1]


def _latin_1(split: str) -> str:
    """The split pattern for texts of the first 256 code points, for the faster matcher."""
    of = lambda kinds: "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] in kinds)
    white = "".join(re.escape(chr(c)) for c in (*range(9, 14), 32, 0x85, 0xA0))
    for old, new in ((r"\p{L}", of("L")), (r"\p{N}", of("N")), (r"\s", white)):
        split = split.replace(old, new)
    return split.replace("[[", "[").replace("]]", "]")


class Encoder:
    """Encodes and decodes whole texts with a vocabulary file's contents."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model, added = spec["model"], spec["added_tokens"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]], model["type"], spec["decoder"], [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], "BPE", None, ["Split", "ByteLevel"]):
            raise ValueError(f"no such tokenizer is known: {kinds}")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must be matched in the raw text, as they are")
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or "")
        # The library is asked for its normaliser and splitter alone.
        library = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.split_latin = re.compile(_latin_1(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])).findall
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.labels = self.automaton.labels
        self.labels.update({i: t for t, i in self.special.items()})
        self.cache: dict[str, bytes] = {}
        self.foreign: dict[str, bytes] = {}

    def rest(self) -> None:
        """Drops what was kept for speed."""
        self.cache.clear()
        self.foreign.clear()
        self.automaton.table.clear()
        self.automaton._forget()

    def _latin_word(self, word: str) -> bytes:
        inner = self.automaton.inner
        return self._kept(self.cache, word, "".join([inner[b] for b in word.encode()]))

    def _foreign_word(self, word: str) -> bytes:
        return self._kept(self.foreign, word, word)

    def _kept(self, cache: dict[str, bytes], word: str, symbols: str) -> bytes:
        tokens = self.automaton.word(symbols)
        code = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(word) <= LONG_WORD:
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            cache[word] = code
        return code

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                get, make = self.foreign.get, self._foreign_word
                return b"".join([get(w) or make(w) for w, _ in self.split(self.normalise(text))])
        # No piece holds white space, so replacing runs of it by one space changes none.
        get, make = self.cache.get, self._latin_word
        return b"".join([get(w) or make(w) for w in self.split_latin(text.lower())])

    def encode(self, text: str) -> bytes:
        """The token ids as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(t in text for t in self.special):
            return self._plain(text)
        out = []
        for part in self.cut.split(text):
            out.append(self.special[part].to_bytes(4, "little") if part in self.special else self._plain(part))
        return b"".join(out)

    def decode(self, code: bytes) -> str:
        labels = self.labels
        return " ".join([labels[i] for i in memoryview(code).cast("I").tolist()])


@lru_cache(maxsize=2)
def encoder(source: str) -> Encoder:
    _built.append(made := Encoder(source))
    return made


_built: list[Encoder] = []
CACHES.append(lambda: [e.rest() for e in _built])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _shared(docs: DataFrame, path: str | None):
    """The vocabulary file, read on the driver and sent to the executors; its size is the vocabulary's."""
    with open(path or default_path(), encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids and the decoded text."""
    source = _shared(docs, path)

    def step(batch):
        e = encoder(source.value)
        codes = [e.encode(t) for t in texts(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "ids": [memoryview(c).cast("I").tolist() for c in codes], "decoded": [e.decode(c) for c in codes]}

    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, ids array<int>, decoded string", step)


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: number of tokens and digests of ids and decoded text."""
    source = _shared(docs, path)

    def step(batch):
        e = encoder(source.value)
        codes = [e.encode(t) for t in texts(batch.column("text"))]
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": [len(c) // 4 for c in codes],
            "ids_sha256": [sha256(c).hexdigest() for c in codes],
            "decoded_sha256": [sha256(e.decode(c).encode()).hexdigest() for c in codes],
        }

    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", step)
