"""A process's memory of spans and their ids: hashes to rows of a flat id array."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

KEPT = 1_000_000               # distinct spans that are remembered
KEPT_IDS = 8_000_000           # and their ids


class SpanTable:
    """Ids of distinct spans.  ``learn`` turns spans into lists of ids; entry 0
    holds ``first``.  Beyond the bounds it forgets all and starts anew."""

    def __init__(self, learn: Callable[[list[str]], list], first: list[int]):
        self.learn, self.first = learn, np.array(first, np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.at = self.first.copy(), np.array([0, len(self.first)], np.int64)

    def _add(self, keys: np.ndarray, spans: list[str]) -> None:
        found = [np.asarray(x, np.uint32) for x in self.learn(spans)]
        entries = np.arange(len(self.at) - 1, len(self.at) - 1 + len(found))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.concatenate([self.flat, *found])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.entry = np.insert(self.keys, where, keys), np.insert(self.entry, where, entries)

    def entries(self, keys: np.ndarray, starts: np.ndarray, stops: np.ndarray, joined: str) -> np.ndarray:
        """Entry of each span joined[start:stop], known by its hash."""
        if not len(keys):
            return np.zeros(0, np.int64)
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > KEPT or len(self.flat) > KEPT_IDS:
            self._forget()
        known = np.zeros(len(distinct), bool)
        if len(self.keys):
            where = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            known = self.keys[where] == distinct
        if not known.all():
            new = first[~known]
            self._add(distinct[~known],
                      [joined[s:e] for s, e in zip(starts[new].tolist(), stops[new].tolist(), strict=True)])
        return self.entry[np.searchsorted(self.keys, distinct)][back]

    def gather(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All entries' ids one after another, and offsets by entry."""
        size = (self.at[1:] - self.at[:-1])[entry]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.at[entry] - at[:-1], size) + np.arange(at[-1])], at
