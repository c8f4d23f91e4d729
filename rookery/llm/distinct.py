"""Ids of distinct chunks, each encoded once."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Sequence

import numpy as np

#: Longest chunk that is remembered, and bytes of chunks (4 for a character) and ids, besides the entries' own overhead.
CHUNK = 64
LIMIT = 64 << 20


class DistinctTable:
    """Remembers the ids of chunks as packed bytes and joins them by position.

    The first distinct chunks stay, up to ``most`` of them and LIMIT bytes; frequent ones are soon among them.
    Later ones go to a smaller table that starts anew when it is full.  Chunks of over CHUNK
    characters are segmented where they stand and not remembered.  So a task holds bounded bytes whatever the texts are.
    """

    def __init__(self, encode: Callable[[list], list[bytes]], most: int):
        self.encode, self.most = encode, most
        self.known: dict[Hashable, bytes] = {}
        self.recent: dict[Hashable, bytes] = {}
        self.known_bytes = self.recent_bytes = 0

    def ids(self, chunks: Sequence[Hashable]) -> np.ndarray:
        """Ids of all chunks in order, as 32-bit integers."""
        try:
            return np.frombuffer(b"".join(map(self.known.__getitem__, chunks)), np.int32)
        except KeyError:
            pass
        new = self._learn(set(chunks).difference(self.known))
        get, recent = self.known.get, self.recent
        return np.frombuffer(
            b"".join([v if (v := get(c)) is not None else v if (v := recent.get(c)) is not None else new[c] for c in chunks]),
            np.int32,
        )

    def of_distinct(self, chunks: Sequence[Hashable]) -> list[bytes]:
        """Packed ids of each chunk, where no chunk comes twice."""
        found = list(map(self.known.get, chunks))
        unknown = [c for c, v in zip(chunks, found) if v is None]
        if not unknown:
            return found
        new = self._learn(unknown)
        recent = self.recent
        return [v if v is not None else new[c] if c in new else recent[c] for c, v in zip(chunks, found)]

    def _learn(self, unknown: Iterable[Hashable]) -> dict[Hashable, bytes]:
        """Encode distinct chunks outside ``known`` that the smaller table does not hold, and remember them."""
        if len(self.recent) > self.most // 4 or self.recent_bytes > LIMIT // 4:
            self.recent, self.recent_bytes = {}, 0
        recent = self.recent
        missing = [c for c in unknown if c not in recent]
        new = dict(zip(missing, self.encode(missing)))
        kept = {c: v for c, v in new.items() if len(c) <= CHUNK} if max(map(len, missing), default=0) > CHUNK else new
        held = sum(map(len, kept)) * 4 + sum(map(len, kept.values()))
        if len(self.known) < self.most and self.known_bytes < LIMIT:
            self.known.update(kept)
            self.known_bytes += held
        else:
            recent.update(kept)
            self.recent_bytes += held
        return new


def packed(ids: Sequence[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()
