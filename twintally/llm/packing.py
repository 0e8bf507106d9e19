"""Sum-of-squares online packing of tokenised documents into fixed windows.

A level array counts the open windows by how many tokens they hold. A document's
remainder (what is left after whole windows are cut off it) goes to the level that makes
the sum of the squared counts smallest: a level whose windows it fills up, a level
that many windows share, or a new window. Levels so stay about equally common, and
there is nearly always an open window that the next document fits exactly.

Documents are packed where they are read: a task tokenises and packs its own rows, nothing
is shuffled, and what is open at its end (or beyond ``most_open`` windows at any time) is
packed by cutting, so that a task leaves at most one window that is not full.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twintally.llm.bpe import byte_letters
from twintally.llm.memo import Learnt
from twintally.llm.scratch import quoted

WINDOW, EOS, MOST_OPEN = 2048, 1, 2048

_CACHED_CHUNKS, _CACHED_WORDS, _CACHED_MARKS = 600_000, 300_000, 10_000
# Neither letters nor digits, nor the start of a contraction.
_MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
_LETTERS = dict(enumerate(byte_letters()))
# White space to Python that the tokenizer does not take for white space.
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


# The normaliser and the cutting into words for which chunks may be encoded by themselves.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}


class ChunkEncoder:
    """Token ids of whole texts, as the tokenizer gives them, with repeated words looked up.

    The tokenizer makes white space alike, drops it and never joins what it separates, so
    a text's ids are those of its chunks between white space one after another. Chunks
    that were met before are taken from a table of bounded size. Texts that may hold a
    special token or white space on which the two sides disagree are encoded whole, and so
    are all texts if the tokenizer normalises or cuts words in another way than the one known here.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = Learnt(_CACHED_CHUNKS, self._chunk)
        self.words = Learnt(_CACHED_WORDS, self._word)
        self.marks = Learnt(_CACHED_MARKS, lambda mark: self._library([mark])[0])
        given = json.loads(self.tokenizer.to_str())
        cuts = (given["pre_tokenizer"] or {}).get("pretokenizers") or [None]
        self.known = given["normalizer"] == _NORMALIZER and cuts[0] == _SPLIT and given["model"].get("dropout") is None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.known:
            return self._library(texts)
        odd, ids = [*self.specials, *_ODD_SPACE], self.chunks.__getitem__
        return [
            self._library([text])[0] if any(s in text for s in odd) else b"".join(map(ids, text.split())) for text in texts
        ]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk; marks after a word of letters are cut from it by the tokenizer as well."""
        word = chunk.rstrip(_MARKS)
        # A word of plain letters passes the normaliser and the cutting into words as it is, but for its case.
        if not word.isalpha() or max(word) >= "\u0250" or "\u0130" in word:
            return self._library([chunk])[0]
        ids, mark = self.words[word.lower()], chunk[len(word) :]
        return ids + self.marks[mark] if mark else ids

    def _word(self, letters: str) -> bytes:
        """Ids of a word of lower-case letters."""
        if not letters.isascii():
            letters = letters.encode("utf-8").decode("latin-1").translate(_LETTERS)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(letters)]).tobytes()


@cache
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


class SumOfSquares:
    """The open windows of one task and the level array that chooses among them."""

    def __init__(self, window: int):
        self.window = window
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, piece, length: int) -> list | None:
        """Puts a piece of fewer than ``window`` tokens in place; the pieces of a window that became full."""
        at = self.choose(length)
        if at:
            pieces = self.open[at].pop()
            self.level[at] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + length == self.window:
            return pieces
        self.open[at + length].append(pieces)
        self.level[at + length] += 1
        return None

    def choose(self, length: int) -> int:
        """The level whose choice leaves the smallest sum of squares; the fullest of equals."""
        n, full = self.level, self.window - length
        best, least = 0, 2 * n[length] + 1  # a new window
        held = np.nonzero(n[1:full])[0] + 1
        if len(held):
            change = 2 * (n[held + length] - n[held]) + 2
            k = len(held) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= least:
                best, least = int(held[k]), change[k]
        if n[full] and 1 - 2 * n[full] <= least:
            best = full
        return best

    def n_open(self) -> int:
        return int(self.level.sum())

    def clear(self) -> list:
        """All open pieces, fullest window first; none stays open."""
        pieces = [p for windows in reversed(self.open) for window in windows for p in window]
        self.__init__(self.window)
        return pieces


def _pack_task(texts, encode, window: int, eos: int, most_open: int, first_sequence: int) -> Iterator[tuple]:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of every piece of a task's rows."""
    sequence, packer = first_sequence, SumOfSquares(window)
    end = np.array([eos], "<u4").tobytes()

    def laid(pieces) -> Iterator[tuple]:
        nonlocal sequence
        at = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids) // 4, ids, total, sequence, at
            at += len(ids) // 4
        sequence += 1

    def cut() -> Iterator[tuple]:
        pieces, room = [], window
        for doc_id, start, ids, total in packer.clear():
            while ids:
                some, ids = ids[: 4 * room], ids[4 * room :]
                pieces.append((doc_id, start, some, total))
                start, room = start + len(some) // 4, room - len(some) // 4
                if not room:
                    yield from laid(pieces)
                    pieces, room = [], window
        if pieces:
            yield from laid(pieces)

    for doc_ids, batch in texts:
        for doc_id, ids in zip(doc_ids, encode(batch)):
            ids += end
            total = len(ids) // 4
            whole = total // window * window
            for start in range(0, whole, window):
                yield from laid([(doc_id, start, ids[4 * start : 4 * (start + window)], total)])
            if whole < total:
                full = packer.place((doc_id, whole, ids[4 * whole :], total), total - whole)
                if full:
                    yield from laid(full)
                elif packer.n_open() > most_open:
                    yield from cut()
    yield from cut()


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    eos: int = EOS,
    most_open: int = MOST_OPEN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts and the sequence and place it went to.

    ``tokenizer`` is the path of a tokenizers file on every executor. A document is its text's
    ids and then ``eos``; it is cut at multiples of ``window``, and further only where a task
    packs what it has open. Columns: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, with ``with_ids`` also ``token_ids``. A sequence's pieces have gapless
    offsets from 0; a sequence's number is its task's number times 2^32 and a count. The
    numbers are the same in every run if the rows of ``docs`` come in the same order in the same
    partitions, as they do from files.

    - A null text is empty: the document is ``eos`` alone.
    - Rows that repeat an identifier are documents of their own; a null identifier stays null.
    - An empty table gives no rows. Other columns are not read.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (
            (part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()])
            for batch in batches
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000))
        )
        first = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        for piece in _pack_task(texts, _encoder(tokenizer).encode, window, eos, most_open, first):
            held.append(piece)
            if len(held) == 2000:
                yield _batch(held, with_ids)
                held = []
        if held:
            yield _batch(held, with_ids)

    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(pack, _PIECES + (", token_ids array<int>" if with_ids else ""))


def _batch(pieces: list[tuple], with_ids: bool) -> pa.RecordBatch:
    doc_id, start, length, ids, total, sequence, offset = zip(*pieces)
    columns = [doc_id, start, length, [zlib.crc32(i) for i in ids], total, sequence, offset]
    arrays = [pa.array(c, pa.int64()) for c in columns]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        arrays.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
        names.append("token_ids")
    return pa.RecordBatch.from_arrays(arrays, names)
