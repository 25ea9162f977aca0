"""Byte-pair encoding and decoding with public vocabularies.

Merging follows the classic priority-queue scheme: a heap of (merge rank, position) over a doubly linked symbol list, where
entries whose symbols have changed since are skipped. Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import map_rows, table

#: Entries of one generation of the word cache; a worker holds two generations at most.
CACHE = 250_000
#: Separators for str.split that are no white space in the vocabulary's own pattern.
ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Bpe:
    """A vocabulary with word ends, as the file's normaliser and pre-tokeniser describe it."""

    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        #: symbol pair, packed as left << 32 | right, -> rank; the rank's merged symbol is in ``made``.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.ids[a] << 32 | self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.strings[i] = token
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(regex.escape(x) for x in self.special) + ")")
        alphabet = byte_alphabet()
        self.first = [self.ids.get(c, -1) for c in alphabet]
        self.last = [self.ids.get(c + self.end, -1) for c in alphabet]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids after all merges, lowest rank first and leftmost among equals."""
        n, rank_of, made, low = len(symbols), self.ranks.get, self.made, (1 << 40) - 1
        heap = [found << 40 | i for i in range(n - 1) if (found := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
        if not heap:
            return symbols
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i, rank = x & low, x >> 40
            j = after[i]
            if j < 0 or symbols[i] < 0 or rank_of(symbols[i] << 32 | symbols[j]) != rank:
                continue  # stale
            new = symbols[i] = made[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (found := rank_of(new << 32 | symbols[k])) is not None:
                    heappush(heap, found << 40 | i)
            h = before[i]
            if h >= 0 and (found := rank_of(symbols[h] << 32 | new)) is not None:
                heappush(heap, found << 40 | h)
        return [s for s in symbols if s >= 0]

    def piece(self, word: str) -> bytes:
        """Ids of one pre-token, as little-endian 32-bit integers."""
        found = self.pieces.get(word)
        if found is None:
            raw = word.encode()
            symbols = [self.first[b] for b in raw]
            symbols[-1] = self.last[raw[-1]]
            found = array("I", self.merge([s for s in symbols if s >= 0])).tobytes()
            if len(word) < 64:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[word] = found
        return found

    def word(self, raw: str) -> bytes:
        """Ids of white-space-free text."""
        norm = raw.lower() if raw.isascii() else "".join([c.lower() for c in unicodedata.normalize("NFC", raw)])
        if norm.isalpha():
            return self.piece(norm)
        if norm[:-1].isalpha() and norm[-1] in ".,!?;:":
            return self.piece(norm[:-1]) + self.piece(norm[-1])
        return b"".join([self.piece(w) for w in self.pattern.findall(norm)])

    def miss(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.word(word)
        if len(word) < 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found

    def plain(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACES):
            import regex

            words = regex.split(r"\s+", text)
            return b"".join([self.word(w) for w in words if w])
        words = text.split()
        found = list(map(self.young.get, words))
        if None in found:
            miss = self.miss
            found = [miss(w) if f is None else f for w, f in zip(words, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self.plain(text)
        return b"".join(array("I", [self.special[x]]).tobytes() if x in self.special else self.plain(x) for x in self.specials.split(text))

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings, one space between them (the vocabulary file names no decoder)."""
        numbers = array("I", ids)
        return " ".join(map(self.strings.__getitem__, numbers))


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary at ``path``, read once per worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row of ``docs`` (doc_id, text); other columns are not read.

    A null text counts as empty, which has no ids; long ones are encoded whole. Rows with a null id and repeated rows each give their
    own; an empty table gives no rows.
    """

    def make():
        bpe = load(path or vocabulary("word_bpe_49k.json"))

        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                ids = bpe.encode(text or "")
                yield i, array("I", ids).tolist(), bpe.decode(ids)

        return rows

    return map_rows(docs.select("doc_id", "text"), "doc_id long, ids array<int>, decoded string", make)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of encoding and decoding every document."""

    def make():
        bpe = load(vocabulary("word_bpe_49k.json"))

        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                ids = bpe.encode(text or "")
                yield i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()

        return rows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_rows(docs, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
