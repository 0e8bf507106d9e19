"""Byte-level BPE encoding over a trie of distinct words, and decoding.

The encoding of a byte string is found from the encodings of its prefixes: it is the
encoding of a shorter prefix and then one last token, and that token is the one that BPE
would not merge otherwise with the token before it. So a trie of distinct words is walked
depth first, every node gets the last token of its prefix, and words that share a prefix
share the work. A word's tokens are read off its path from the end backwards.

That holds for vocabularies whose every token is the encoding of its own bytes; tokens that
are not are never chosen.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.memo import Memo
from twintally.llm.scratch import quoted

# Fixed value: the public pattern by which byte-level BPE cuts text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_CACHED = 400_000


def byte_letters() -> list[str]:
    """The letter by which vocabulary files write each byte: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class TrieEncoder:
    """Encodes and decodes with one vocabulary file; its tables of words are bounded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        octet = {letter: b for b, letter in enumerate(byte_letters())}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self.ids = {bytes(octet[c] for c in t): i for t, i in vocab.items()}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.size = {i: len(b) for i, b in self.bytes.items()} | {-1: 0}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.rank.setdefault(pair, rank)
            self.halves.setdefault(vocab[left + right], pair)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words, self.chunks = Memo(_CACHED), Memo(_CACHED)
        self.fits: dict[int, bool] = {}
        self.proper: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def merged(self, token: bytes) -> list[int]:
        """Plain BPE of some bytes: the pair of lowest rank is joined, from the left."""
        units = [self.ids[bytes([b])] for b in token]
        while len(units) > 1:
            ranked = [(self.rank.get(pair, 1 << 60), i) for i, pair in enumerate(zip(units, units[1:]))]
            lowest, i = min(ranked)
            if lowest == 1 << 60:
                break
            units[i : i + 2] = [self.ids[self.bytes[units[i]] + self.bytes[units[i + 1]]]]
        return units

    def whole(self, token: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        proper = self.proper.get(token)
        if proper is None:
            proper = self.proper[token] = self.merged(self.bytes[token]) == [token]
        return proper

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The units at a token's left (0) or right (1) edge while it is built, each with the rank that uses it up."""
        units = self.edges.get((token, side))
        if units is None:
            units, unit, used_up = [], token, 1 << 60
            while True:
                units.append((unit, used_up))
                if unit not in self.halves:
                    break
                pair = self.halves[unit]
                unit, used_up = pair[side], self.rank[pair]
            self.edges[token, side] = units
        return units

    def follows(self, before: int, last: int) -> bool:
        """Whether BPE leaves the two tokens as they are when they stand side by side.

        It does not if a unit at the right edge of the one and a unit at the left edge of the
        other would be joined before either is used up inside its own token. Of two merges
        of one rank that overlap, the left one comes first.
        """
        rank = self.rank.get
        for left, left_used in self.edge(before, 1):
            for right, right_used in self.edge(last, 0):
                joined = rank((left, right))
                if joined is not None and joined < left_used and joined <= right_used:
                    return False
        return self.whole(last)

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encodes distinct words in one depth-first walk of their trie.

        The trie is held as the sorted list of its words: a node is a prefix that neighbours
        share, going down the list is the depth-first walk, and ``last`` is the path from the root
        to the word at hand with the last token of every prefix on it.
        """
        if len(self.fits) > 2 * _CACHED:
            self.fits.clear()
        ids, fits, size, longest, found = self.ids.get, self.fits, self.size, self.longest, {}
        last = [-1]
        above = b""
        for word, text in sorted((word.encode("utf-8"), word) for word in words):
            shared = 0
            for x, y in zip(above, word):
                if x != y:
                    break
                shared += 1
            above = word
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # Only one token fits, so the order is free: first the one above with a byte more.
                likely = end - 1 - size[last[-1]]
                for start in (likely, *range(end - 1, max(end - longest, 0) - 1, -1)):
                    token = ids(word[start:end])
                    if token is None:
                        continue
                    if start:
                        pair = last[start] << 32 | token
                        good = fits.get(pair)
                        if good is None:
                            good = fits[pair] = self.follows(last[start], token)
                    else:
                        good = self.whole(token)
                    if good:
                        last.append(token)
                        break
                else:
                    raise ValueError(f"the vocabulary has no encoding of {word[:end]!r}")
            tokens, end = [], len(word)
            while end:
                tokens.append(last[end])
                end -= size[last[end]]
            tokens.reverse()
            found[text] = array("i", tokens).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text. Added tokens' strings in a text are those tokens.

        Words never reach over a space to their right, so a text is cut before each space
        and the pieces are looked up; only texts with two spaces in a row are cut
        into words whole, as there a word's end depends on what follows the piece.
        """
        plain = [[*self._pieces(text)] for text in texts]
        loose = set().union(*(p[0] for pieces in plain for p in pieces if not isinstance(p, int) and not p[1]))
        chunks = set().union(*(p[0] for pieces in plain for p in pieces if not isinstance(p, int) and p[1]))
        known = self.chunks.look_up(chunks, self._learn_chunks), self.words.look_up(loose, self.learn)
        return [np.frombuffer(b"".join(_ids(pieces, *known)), "<i4") for pieces in plain]

    def _learn_chunks(self, chunks: set[str]) -> dict[str, bytes]:
        cut = {c: WORDS.findall(c) for c in chunks}
        ids = self.words.look_up(set().union(*cut.values()), self.learn).__getitem__
        return {c: ids(words[0]) if len(words) == 1 else b"".join(map(ids, words)) for c, words in cut.items()}

    def _pieces(self, text: str) -> Iterator[tuple[list[str], bool] | int]:
        """The id of an added token, or strings: pieces from space to space, or words."""
        for part in self.cuts.split(text) if self.cuts and any(t in text for t in self.added) else [text]:
            if part in self.added:
                yield self.added[part]
            elif "  " in part:
                yield WORDS.findall(part), False
            elif part:
                first, *rest = part.split(" ")
                yield ([first] if first else []) + [" " + piece for piece in rest], True

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _ids(pieces: list, chunks: dict[str, bytes], words: dict[str, bytes]) -> Iterator[bytes]:
    for piece in pieces:
        if isinstance(piece, int):
            yield np.array([piece], "<i4").tobytes()
        else:
            yield b"".join(map((chunks if piece[1] else words).__getitem__, piece[0]))


@cache
def _encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row, whole texts.

    ``vocabulary`` is the path of a byte-level BPE file on every executor. A task keeps a
    bounded table of the words it has met; nothing is shuffled.

    - A null text is empty; an empty text has no ids.
    - Repeated rows and null identifiers are kept as they are; an empty table gives no rows.
    """
    return _mapped(docs, id_column, text_column, "doc_id long, ids array<int>", lambda encoder, ids: ids, vocabulary)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` for rows of ``doc_id, ids``; null ids are no ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def digest_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes, decodes and keeps digests.

    What :func:`encode_documents` and :func:`decode_documents` give, without moving the ids.
    """
    return _mapped(
        docs, id_column, text_column, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, vocabulary
    )


def _digests(encoder: TrieEncoder, ids: np.ndarray) -> tuple:
    ids = ids.tolist()
    written = ",".join(map(str, ids)).encode()
    decoded = encoder.decode(ids).encode("utf-8")
    return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _mapped(docs: DataFrame, id_column: str, text_column: str, schema: str, of_ids, vocabulary: str) -> DataFrame:
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for part in (batch.slice(at, 1024) for at in range(0, batch.num_rows, 1024)):
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = [of_ids(encoder, ids) for ids in encoder.encode(texts)]
                columns = [pa.array(c) for c in (zip(*found) if len(names) > 2 else [found])]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(mapped, schema)
