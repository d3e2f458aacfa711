"""Sets of hashed byte n-grams of texts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from matchmill.llm.text import ALNUM, PIECE, joined, mix, pieces


class GramSets:
    """The distinct n-grams of a text's words (bytes of UTF-8, A-Z lower-cased, a space around each word) as bucket numbers.

    Grams of up to seven bytes are packed into numbers together with their length and hashed into ``2 ** bits`` buckets.
    """

    def __init__(self, sizes: Sequence[int], bits: int):
        self.sizes, self.bits = tuple(sizes), bits
        self.flags = np.zeros(1 << bits, np.bool_)

    def of(self, text: bytes | None) -> np.ndarray:
        """Sorted bucket numbers; none for a text without words. Long texts are read piece by piece."""
        if text and len(text) > 2 * PIECE:
            tail = b""
            for piece in pieces(text, ALNUM):
                # The end of the piece before, less the space that both have, so that no n-gram across the cut is lost.
                raw = tail[:-1] + joined(piece, ALNUM) if tail else joined(piece, ALNUM)
                self._mark(raw)
                tail = raw[-max(self.sizes) :] or tail
        else:
            self._mark(joined(text, ALNUM))
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found.astype(np.int32)

    def _mark(self, flat: bytes) -> None:
        raw = np.frombuffer(flat, np.uint8)
        packed = np.zeros(len(raw), np.uint64)
        for n in range(1, max(self.sizes) + 1):
            if len(raw) < n:
                break
            packed = (packed[: len(raw) - n + 1] << np.uint64(8)) | raw[n - 1 :]
            if n in self.sizes:
                self.flags[(mix(packed | np.uint64(n << 56)) >> np.uint64(64 - self.bits)).astype(np.int64)] = True
