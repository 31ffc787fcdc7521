"""Vectorised text primitives: many texts as one array of code points, spans as
(start, end) offsets into it, and 64-bit hashes of all spans at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)       # odd, so its powers are invertible
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and the n + 1 offsets."""
    joined = "".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return cp, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n, kept for later calls."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise hashes so that every bit depends on every other."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(33))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums of (value + 1) * BASE**i, all modulo 2**64."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the array under ``prefix``; equal contents, equal hashes."""
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_TABLES: dict[str, np.ndarray] = {}


def class_table(name: str, test) -> np.ndarray:
    """Truth of ``test(character)`` for every code point, made once a process."""
    if name not in _TABLES:
        _TABLES[name] = np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)
    return _TABLES[name]


def part_ends(text: str, opens: Callable[[str], np.ndarray], size: int) -> Iterator[int]:
    """Ends of the parts that a text is worked on in: about ``size`` characters, each
    ending at one of the places that ``opens`` names in the window given to it (a
    part is longer where there is none)."""
    lo = 0
    while len(text) - lo > size:
        a, b = lo + size - min(size, 4096), lo + size
        at = opens(text[a:b])
        while not len(at) and b < len(text):
            a, b = max(lo, b - 64), min(b + size, len(text))
            at = opens(text[a:b])
        if not len(at):
            break
        lo = a + int(at[-1])
        yield lo
    yield len(text)
