"""Byte-level BPE ids of many texts at once.

``tokenizers`` merges each distinct pre-token once a process; splitting texts
into pre-tokens and gathering their ids is numpy work.  The split follows the
vocabulary's own pattern: contractions, an optional blank before a run of
letters, digits or other signs, and white space whose last character belongs
to what follows.  Character classes are asked of the tokenizer itself, and a
text that holds an added token's string is encoded by the tokenizer alone.  Very long
texts are worked on in parts that end where a pre-token does in any context.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

from .spans import SpanTable
from .textops import codepoints, part_ends, prefix_hashes, span_hashes

LETTER, DIGIT, OTHER, SPACE, UNSEEN = range(5)
END = 0                        # id that ends every document
PART = 1 << 20                 # characters of a text that are worked on at once


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: its own
    Latin-1 character if that is visible, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of one ``tokenizers`` file with the byte-level split described above."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None:
            raise ValueError(f"{path}: a normalising tokenizer can't be split here")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = _byte_signs()
        self.classes = np.full(0x110000, UNSEEN, np.uint8)
        self.table = SpanTable(self._merge, [END])

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The process's encoder of ``path``."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _class(self, char: str) -> int:
        alone = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return next((k for k, before in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!"))
                     if len(alone(before + char)) == 1), SPACE)

    def _kinds(self, cp: np.ndarray) -> np.ndarray:
        kind = self.classes[cp]
        if (kind == UNSEEN).any():
            for c in np.unique(cp[kind == UNSEEN]):
                self.classes[c] = self._class(chr(c))
            kind = self.classes[cp]
        return kind

    def _opens(self, window: str) -> np.ndarray:
        """Places well inside ``window`` where a pre-token begins whatever stands
        around: a single blank between two others, or another class of character
        that follows no apostrophe; none within an added token."""
        cp = codepoints([window])[0]
        kind = self._kinds(cp)
        margin = 2 + max(map(len, self.added), default=0)
        opens = np.zeros(len(cp), bool)
        before, here, after = kind[:-2] != SPACE, kind[1:-1] != SPACE, kind[2:] != SPACE
        opens[1:-1] = before & ((cp[1:-1] == 32) & after | here & (kind[:-2] != kind[1:-1]) & (cp[:-2] != 39))
        opens[:margin] = opens[-margin:] = False
        for a in self.added:
            at = window.find(a)
            while at >= 0:
                opens[at + 1: at + len(a)] = False
                at = window.find(a, at + 1)
        return np.flatnonzero(opens)

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text's parts, which are together the text's, END included."""
        lo = 0
        for hi in part_ends(text, self._opens, PART):
            ids = self.encode([text[lo:hi]])[0]
            yield ids if hi == len(text) else ids[:-1]
            lo = hi

    def split(self, cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens of texts that follow one another in ``cp``."""
        kind = self._kinds(cp)
        n = len(cp)
        first = np.zeros(n + 1, bool)
        first[ends] = True
        begin = first.copy()
        begin[1:n] |= kind[1:] != kind[:-1]
        # the last of white space before something else stands alone or joins it
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n])
        begin[last] = True
        begin[last[cp[last] == 32] + 1] = False
        mark = np.flatnonzero((cp == 39) & begin[:n])          # contractions
        if len(mark):
            text_end = ends[np.searchsorted(ends, mark, "right")]
            padded = np.concatenate([cp, np.zeros(3, np.uint32)])
            a, b = padded[mark + 1], padded[mark + 2]
            one = np.isin(a, [ord(c) for c in "stmd"]) & (mark + 1 < text_end)
            two = ((((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
                   & (mark + 2 < text_end))
            begin[mark[one | two] + 1] = False
            begin[mark[one] + 2] = True
            begin[mark[two] + 3] = True
        return np.flatnonzero(begin[:n])

    def _merge(self, spans: list[str]) -> list[list[int]]:
        merge, signs = self.tokenizer.model.tokenize, self.signs
        return [[t.id for t in merge(s.encode().decode("latin-1").translate(signs))] for s in spans]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, each followed by END, and offsets."""
        odd = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        plain = ["" if i in odd else t for i, t in enumerate(texts)] if odd else texts
        cp, ends = codepoints(plain)
        starts = self.split(cp, ends) if len(cp) else np.zeros(0, np.int64)
        stops = np.append(starts[1:], len(cp))
        keys = span_hashes(prefix_hashes(cp), starts, stops)
        entry = self.table.entries(keys, starts, stops, "".join(plain))
        entry = np.insert(entry, np.searchsorted(starts, ends[1:]), 0)
        of_text = np.searchsorted(starts, ends) + np.arange(len(ends))
        ids, at = self.table.gather(entry)
        offsets = at[of_text]
        if odd:
            parts = [ids[offsets[i]: offsets[i + 1]] for i in range(len(texts))]
            for i in odd:
                own = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                parts[i] = np.array([*own, END], np.uint32)
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets
