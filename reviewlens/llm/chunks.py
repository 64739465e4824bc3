"""Encoding whole texts by their distinct chunks (runs between ASCII white space).

A tokenizer that never joins symbols across white space encodes a text chunk by
chunk.  A group's distinct chunks are found by their hashes (numpy), each is
encoded once and kept in a bounded cache of the worker process, and the pieces
are put together for each text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from reviewlens.llm.words import Group

#: chunks kept in each of two generations; the older one goes when the younger is full
CACHE_CHUNKS = 120_000
GROUP_BYTES = 1 << 22


class ChunkCache:
    """chunk -> piece, where ``encode_many`` makes the pieces of a list of chunks."""

    def __init__(self, encode_many: Callable[[list[bytes]], list], most: int = CACHE_CHUNKS):
        self.encode_many, self.most = encode_many, most
        self.young: dict = {}
        self.old: dict = {}

    def pieces(self, chunks: list[bytes]) -> list:
        young, old = self.young, self.old
        out = [young.get(c) for c in chunks]
        missing = []
        for i, p in enumerate(out):
            if p is None:
                p = old.get(chunks[i])
                if p is None:
                    missing.append(i)
                else:
                    out[i] = young[chunks[i]] = p
        for i, p in zip(missing, self.encode_many([chunks[i] for i in missing]) if missing else (), strict=True):
            out[i] = p
            if len(chunks[i]) <= 64:
                young[chunks[i]] = p
        if len(young) > self.most:
            self.old, self.young = young, {}
        return out

    def rest(self) -> None:
        """At a task's end: free the older generation, as the worker may run other code next."""
        self.old = {}


def by_text(g: Group, cache: ChunkCache) -> list[list]:
    """The pieces of every text of a group, in order."""
    first, end, h, at = g.words(lower=False)
    if not len(h):
        return [[] for _ in g.texts]
    _, where, which = np.unique(h, return_index=True, return_inverse=True)
    whole = g.data.tobytes()
    distinct = cache.pieces([whole[a:b] for a, b in zip(first[where].tolist(), end[where].tolist(), strict=True)])
    table = np.empty(len(distinct), object)
    table[:] = distinct
    pieces = table[which].tolist()
    return [pieces[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
