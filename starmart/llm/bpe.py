"""Byte-pair encoding with word ends, and decoding, from a public vocabulary file.

A word is a doubly linked list of symbols. A heap holds the ranks of all adjacent pairs; the best
pair is merged, its neighbours' new pairs are pushed, and entries whose symbols have changed meanwhile
are skipped. Decoding concatenates vocabulary strings; the file names no decoder, so a space is between them.

The vocabulary file is read on the driver and broadcast: it is a fixed file of a few MB that does not grow
with the data. Words already merged and their pieces are remembered in each task, up to ``memo`` of either; then the older half goes.
The strings of a word's ids are remembered too, where the decoded text is wanted.

Cases: a null or empty text gives no ids. Special tokens that stand in a text are found before normalisation and
become their ids, as the tokenizers library does. Repeated rows are encoded one by one; other columns are handed
through, an existing column with the name of the result is replaced.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from heapq import heapify, heappop, heappush
from itertools import pairwise

import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .common import with_column

#: Words remembered by a task, at about 500 bytes a word and its pieces; fewer take less memory and more time.
MEMO = 400_000
_PLACES = 40  # bits of a place in a word, or of a symbol
_PLACE = (1 << _PLACES) - 1
#: White space of the pattern language of the vocabulary file; ``str.split`` also parts at U+001C to U+001F.
WHITE = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SPLITS_MORE = regex.compile("[\x1c-\x1f]")
_RESULT = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
])
_DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else free))
        free += b not in shown
    return out


class Merges:
    """The merges of a vocabulary: the rank of a pair, and what is merged at each rank."""

    def __init__(self, merged: list[tuple[int, int, int]]) -> None:
        self.rank = {a << _PLACES | b: i for i, (a, b, _) in enumerate(merged)}
        self.first, self.second, self.made = (list(x) for x in zip(*merged, strict=True)) if merged else ([], [], [])


def merge(symbols: list[int], merges: Merges) -> list[int]:
    """``symbols`` after all merges. An entry of the heap is one number, rank before place."""
    rank, first, second, made = merges.rank.get, merges.first, merges.second, merges.made
    heap = []
    for i, (a, b) in enumerate(pairwise(symbols)):
        if (r := rank(a << _PLACES | b)) is not None:
            heap.append(r << _PLACES | i)
    if not heap:
        return symbols
    n = len(symbols)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        r, i = entry >> _PLACES, entry & _PLACE
        j = right[i]
        if symbols[i] != first[r] or j < 0 or symbols[j] != second[r]:
            continue  # stale: one of the two has been merged since
        symbols[i] = new = made[r]
        symbols[j] = -1
        right[i] = k = right[j]
        if k >= 0:
            left[k] = i
            if (r := rank(new << _PLACES | symbols[k])) is not None:
                heappush(heap, r << _PLACES | i)
        if (h := left[i]) >= 0 and (r := rank(symbols[h] << _PLACES | new)) is not None:
            heappush(heap, r << _PLACES | h)
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: str, decoded: bool = True, memo: int = MEMO) -> None:
        self.decoded, self.most = decoded, memo
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.merges = Merges([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in model["merges"]])
        self.pieces = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        alphabet = byte_alphabet()
        self.inner = [self.vocab[c] for c in alphabet]
        self.last = [self.vocab[c + self.end] for c in alphabet]
        self.memo: dict[str, tuple[bytes, str, int]] = {}
        self.parts: dict[str, list[int]] = {}

    def _merged(self, text: str) -> tuple[bytes, str, int]:
        """Ids as 32-bit numbers, their strings (none unless decoded) and how many there are, of characters without white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # lower case of single characters: the rule for a sigma at the end of a word is the only other one
        text = text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))
        ids: list[int] = []
        for piece in [text] if text.isascii() and text.isalpha() else self.pieces.findall(text):
            ids += self._piece(piece)
        return array("I", ids).tobytes(), " ".join(map(self.strings.__getitem__, ids)) if self.decoded else "", len(ids)

    def _piece(self, piece: str) -> list[int]:
        got = self.parts.get(piece)
        if got is None:
            *raw, end = piece.encode()
            got = merge([*map(self.inner.__getitem__, raw), self.last[end]], self.merges)
            if len(piece) <= 64:
                self.parts[piece] = got
        return got

    def pieces_of(self, text: str | None) -> list[tuple[bytes, str, int]]:
        """What each run of characters without white space, and each special token, of a text becomes."""
        if not text:
            return []
        out: list[tuple[bytes, str, int]] = []
        at = 0
        for m in self.specials.finditer(text) if self.special else ():
            out += self._plain(text[at : m.start()])
            out.append((array("I", [self.special[m.group()]]).tobytes(), m.group() if self.decoded else "", 1))
            at = m.end()
        return out + self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> list[tuple[bytes, str, int]]:
        memo = self.memo
        chunks = WHITE.split(text) if SPLITS_MORE.search(text) else text.split()
        for known in (memo, self.parts):
            if len(known) > self.most:
                for old in list(known)[: len(known) - self.most // 2]:
                    del known[old]
        new = {c for c in chunks if c not in memo}
        for chunk in new:
            memo[chunk] = self._merged(chunk)
        out = [got for chunk in chunks if (got := memo[chunk])[2]]
        for chunk in new:
            if len(chunk) > 64:
                del memo[chunk]
        return out

    def encode(self, text: str | None) -> array:
        return array("I", b"".join([p[0] for p in self.pieces_of(text)]))

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def _shared(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, path: str, *, text: str = "text", result: str = "bpe", decoded: bool = True, memo: int = MEMO
) -> DataFrame:
    """``docs`` with a struct column of ``ids`` and, unless not wanted, the text ``decoded`` from them."""
    spec = _shared(docs, path)

    def make():
        codec = Codec(spec.value, decoded, memo)

        def one(found):
            return array("I", b"".join([p[0] for p in found])).tolist(), " ".join([p[1] for p in found]) if decoded else None

        def work(texts):
            return [one(codec.pieces_of(t)) for t in texts]

        return work

    return with_column(docs, result, _RESULT, make, text)


def encode_digest(docs: DataFrame, path: str, *, text: str = "text", result: str = "bpe") -> DataFrame:
    """As ``encode``, with the number of ids and hashes in place of the ids and the text."""
    import hashlib

    spec = _shared(docs, path)

    def make():
        import sys

        codec = Codec(spec.value)

        def one(t):
            found = codec.pieces_of(t)
            ids, decoded = b"".join([p[0] for p in found]), " ".join([p[1] for p in found])
            if sys.byteorder == "big":
                (swapped := array("I", ids)).byteswap()
                ids = swapped.tobytes()
            return sum([p[2] for p in found]), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        return lambda texts: [one(t) for t in texts]

    return with_column(docs, result, _DIGEST, make, text)


def digest(encoded: DataFrame, key: str = "doc_id", result: str = "bpe") -> DataFrame:
    return encoded.select(F.col(key), *(F.col(result)[f].alias(f) for f in _DIGEST.names))
