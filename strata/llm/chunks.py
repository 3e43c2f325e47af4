"""Tokenising by whole text through a cache of its short chunks.

Both tokenizers here split a text by a pattern before they merge, and no match
crosses a single space between two words. So a text is cut at such spaces, each
different chunk is encoded once by the tokenizers library, and the ids of a text
are its chunks' ids joined. The cache is bounded: when full it starts anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

MOST_CHUNKS = 600_000
LONGEST_CHUNK = 200  # longer ones are encoded but not kept


class ChunkCache:
    """``encode`` turns a list of chunks into a list of id lists."""

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], most: int = MOST_CHUNKS):
        self.encode, self.most, self.known = encode, most, {}

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        """Per text (a list of chunks) its ids as little-endian unsigned 32-bit integers."""
        import numpy as np

        known = self.known
        missing = list(set().union(*texts) - known.keys())
        if len(known) + len(missing) > self.most:
            known.clear()
            missing = list(set().union(*texts))
        for at in range(0, len(missing), 4096):
            part = missing[at : at + 4096]
            known.update((c, np.array(x, "<u4").tobytes()) for c, x in zip(part, self.encode(part)))
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in texts]
        for chunk in missing:
            if len(chunk) > LONGEST_CHUNK:
                del known[chunk]
        return out
