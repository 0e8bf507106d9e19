"""Words of a text as bytes, cut by a table instead of a pattern."""

from __future__ import annotations

import numpy as np
import xxhash

# A-Z become a-z; digits, a-z and all bytes of characters beyond ASCII stay; the rest separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def ascii_words(data: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_FOLD).split()


def word_hashes(text: str) -> np.ndarray:
    """XXH64 of each word of the lower-cased text."""
    words = ascii_words(text.lower().encode("utf-8"))
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
