"""SentencePiece encoding and decoding by a batched Viterbi in numpy.

A model's pieces are sorted by the hash of their characters.  Words of equal
length advance together: at each end position the hashes of all substrings that
end there probe the pieces, and the best candidate's length is stored as back-
pointer.

For a model of merges (BPE) the best path is the one that merging would leave.
A piece may follow the best path of what is before it exactly if merging would
not join the two across their border; that is read off by undoing merges on
either side, the latest first, and probing what the facing pieces would make.
One candidate at each position passes, so the path found is the merge result,
character for character.  Runs of blanks, whose pieces share one score, are
resolved by length.

Text without blanks is cut between two characters that stand side by side in no
piece, as no merge crosses there.  A word that is still long advances as chunks
of one length, all at once, each begun some way before its own part; a chunk
stands if it agrees with its predecessor over the longest piece's length, since
nothing further back is looked at, and is else gone through again from there.
Very long texts are worked on in parts that end at such borders.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices
from .spans import SpanTable
from .textops import BASE, codepoints, mix, part_ends, prefix_hashes, span_hashes

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
NEVER = np.int64(1) << 40
WORDS = 4096                   # words that advance together
WHOLE = 32                     # words up to this length are not searched for borders
CHUNK = 128                    # characters that a chunk of a long word owns
PART = 1 << 20                 # characters of a text that are worked on at once
PAIRS = 2_000_000              # pairs of pieces whose border a process remembers


def default_model() -> str:
    return public_tokenizers.path(MODEL)


class Vocabulary:
    """A SentencePiece model's pieces, their hashes and the merges behind them."""

    _made: dict[str, Vocabulary] = {}

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """The process's vocabulary of ``path``."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        self.byte = {int(self.pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        inner = [i for i in range(n) if plain[i] and BLANK in self.pieces[i][1:]]
        if any(self.pieces[i].strip(BLANK) for i in inner):
            raise ValueError(f"{path}: a piece spans words")
        probe = "a  \tﬁéé "
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError(f"{path}: the model normalises its input")
        self.blank_runs = {self.pieces[i]: i for i in inner}
        usable = [i for i in range(n) if plain[i] and i not in set(inner)]
        score = {i: sp.get_score(i) for i in usable}
        merged = [i for i in usable if len(self.pieces[i]) > 1]
        if len({score[i] for i in merged}) < len(merged):
            raise ValueError(f"{path}: equal scores leave the order of merges open")
        self.rank = np.full(n, -1, np.int64)                    # order of merging; characters: -1
        for r, i in enumerate(sorted(merged, key=lambda i: -score[i])):
            self.rank[i] = r
        self.length = np.array([len(p) for p in self.pieces])
        self.longest = max((len(self.pieces[i]) for i in usable), default=1)
        self.up = np.array([pow(int(BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.raw = np.array([self._hash(p) for p in self.pieces], np.uint64)
        keys = mix(self.raw[usable] + self.length[usable].astype(np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable)[order]
        self._split({self.pieces[i]: i for i in usable})
        self.beside = np.unique(np.array([ord(a) << 21 | ord(b) for i in usable
                                          for a, b in zip(self.pieces[i], self.pieces[i][1:])], np.int64))
        self.lead = 3 * self.longest
        self.pairs, self.stays = np.zeros(0, np.int64), np.zeros(0, bool)

    @staticmethod
    def _hash(text: str) -> int:
        return sum((ord(c) + 1) * pow(int(BASE), k, 1 << 64) for k, c in enumerate(text)) % (1 << 64)

    def _split(self, known: dict[str, int]) -> None:
        """The two pieces that each piece is last merged from.  One that merging
        its characters does not bring about is never met and leaves the table."""
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        lost = []
        for text, i in known.items():
            if len(text) > 1:
                parts = _merge(list(text), lambda a, b: (self.rank[known[a + b]] if a + b in known else None),
                               until=text)
                if len(parts) == 2 and parts[0] in known and parts[1] in known:
                    self.left[i], self.right[i] = known[parts[0]], known[parts[1]]
                else:
                    lost.append(i)
        keep = ~np.isin(self.ids, lost)
        self.keys, self.ids = self.keys[keep], self.ids[keep]
        self.seen = np.zeros(1 << 20, bool)                     # whether a key has these first 20 bits
        self.seen[self.keys >> np.uint64(44)] = True

    def probe(self, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Piece of each substring hash, -1 if there is none."""
        key = mix(raw + length.astype(np.uint64))
        found = np.full(len(key), -1)
        some = np.flatnonzero(self.seen[key >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
        found[some] = np.where(self.keys[at] == key[some], self.ids[at], -1)
        return found

    # A character that is no piece stands as size + code point.

    def _rank(self, t: np.ndarray) -> np.ndarray:
        return np.where(t < self.size, self.rank[np.minimum(t, self.size - 1)], -1)

    def _raw(self, t: np.ndarray) -> np.ndarray:
        return np.where(t < self.size, self.raw[np.minimum(t, self.size - 1)],
                        (t - self.size + 1).astype(np.uint64))

    def _length(self, t: np.ndarray) -> np.ndarray:
        return np.where(t < self.size, self.length[np.minimum(t, self.size - 1)], 1)

    def may_follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between each two pieces."""
        ok = np.ones(len(before), bool)
        a, b = before.copy(), after.copy()
        limit = np.full(len(a), 2 * NEVER)                      # twice the rank, odd if undone on the right
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            size = self._length(x) + self._length(y)
            fits = size <= self.longest
            made = np.full(len(open_), -1)
            made[fits] = self.probe((self._raw(x) + self._raw(y) * self.up[np.minimum(self._length(x), self.longest)])[fits],
                                    size[fits])
            joined = (made >= 0) & (2 * self.rank[np.maximum(made, 0)] < limit[open_])
            ok[open_[joined]] = False
            rx, ry = self._rank(x), self._rank(y)
            undo_left = rx > ry
            limit[open_] = np.where(undo_left, 2 * rx, 2 * ry + 1)
            a[open_] = np.where(undo_left, self.right[np.minimum(x, self.size - 1)], x)
            b[open_] = np.where(undo_left | (ry < 0), y, self.left[np.minimum(y, self.size - 1)])
            open_ = open_[~joined & (np.maximum(rx, ry) >= 0)]
        return ok

    def _passes(self, pair: np.ndarray) -> np.ndarray:
        """``may_follow`` of pairs (before << 32 | after), asked once for each."""
        own, back = np.unique(pair, return_inverse=True)
        known = np.zeros(len(own), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(np.searchsorted(self.pairs, own), len(self.pairs) - 1)] == own
        if not known.all():
            if len(self.pairs) > PAIRS:
                self.pairs, self.stays, known = self.pairs[:0], self.stays[:0], np.zeros(len(own), bool)
            new = own[~known]
            where = np.searchsorted(self.pairs, new)
            self.stays = np.insert(self.stays, where, self.may_follow(new >> 32, new & 0xFFFFFFFF))
            self.pairs = np.insert(self.pairs, where, new)
        return self.stays[np.searchsorted(self.pairs, own)][back]

    def borders(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether no piece holds the two characters side by side."""
        pair = before.astype(np.int64) << 21 | after
        at = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
        return self.beside[at] != pair

    def _advance(self, chars: np.ndarray, best: np.ndarray, back: np.ndarray, done: int = 0) -> None:
        """Last piece of each prefix of words of equal length, one a row of code
        points, and its length, from prefixes longer than ``done`` on."""
        many, n = chars.shape
        prefix = np.zeros((many, n + 1), np.uint64)
        powers = np.full(n, BASE, np.uint64)
        powers[:1] = 1
        powers = np.multiply.accumulate(powers)
        inverse = np.full(n, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
        inverse[:1] = 1
        inverse = np.multiply.accumulate(inverse)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers, axis=1, out=prefix[:, 1:])
        rows = np.arange(many)
        for end in range(done + 1, n + 1):
            sizes = np.arange(1, min(end, self.longest) + 1)
            found = self.probe(((prefix[:, [end]] - prefix[:, end - sizes]) * inverse[end - sizes]).ravel(),
                               np.tile(sizes, many)).reshape(many, -1)
            single = found[:, 0] < 0
            found[single, 0] = self.size + chars[single, end - 1]
            r, c = np.nonzero(found >= 0)
            piece, start = found[r, c], end - sizes[c]
            inside = start > 0
            passes = np.ones(len(r), bool)
            passes[inside] = self._passes(best[r[inside], start[inside]] << 32 | piece[inside])
            length = np.zeros(many, np.int64)
            np.maximum.at(length, r[passes], sizes[c[passes]])
            back[:, end] = length
            best[:, end] = found[rows, length - 1]

    def viterbi(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words, one a row of code points filled up to equal length: all
        paths one after another, and offsets by word."""
        many, n = chars.shape
        best, back = np.zeros((many, n + 1), np.int64), np.zeros((many, n + 1), np.int64)
        self._advance(chars, best, back)
        row, last = [], []
        at = lengths.copy()
        while len(open_ := np.flatnonzero(at > 0)):
            row.append(open_)
            last.append(best[open_, at[open_]])
            at[open_] -= back[open_, at[open_]]
        row, last = np.concatenate(row[::-1]), np.concatenate(last[::-1])
        return last[np.argsort(row, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=many))])

    def chunked(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of long words, all their chunks advancing together.  A word's chunk k
        starts at its character k * CHUNK and owns what lies beyond its first
        ``lead`` characters; the first owns those too."""
        lead, near, width = self.lead, self.longest, CHUNK + self.lead
        count = [max(1, -(-(len(w) - lead) // CHUNK)) for w in words]
        first = np.concatenate([[0], np.cumsum(count)])
        chars = np.zeros((first[-1], width), np.int64)
        for w, lo, hi in zip(words, first[:-1], first[1:], strict=True):
            filled = np.zeros((hi - lo) * CHUNK + lead, np.int64)
            filled[:len(w)] = w
            chars[lo:hi] = np.lib.stride_tricks.sliding_window_view(filled, width)[::CHUNK]
        best, back = np.zeros((2, len(chars), width + 1), np.int64)
        for lo in range(0, len(chars), WORDS):
            rows = slice(lo, lo + WORDS)
            self._advance(chars[rows], best[rows], back[rows])
        ends, starts = slice(width + 1 - near, None), slice(lead + 1 - near, lead + 1)
        differs = np.ones(len(chars), bool)
        differs[1:] = ((best[1:, starts] != best[:-1, ends]) | (back[1:, starts] != back[:-1, ends])).any(axis=1)
        differs[first[:-1]] = False
        for k in range(len(chars)):                             # in order: a chunk set right may part from the next
            if differs[k]:
                best[k, starts], back[k, starts] = best[k - 1, ends], back[k - 1, ends]
                self._advance(chars[k:k + 1], best[k:k + 1], back[k:k + 1], lead)
                if k + 1 < len(chars) and k + 1 not in first:
                    differs[k + 1] = ((best[k + 1, starts] != best[k, ends]).any()
                                      or (back[k + 1, starts] != back[k, ends]).any())
        paths = []
        for w, lo, hi in zip(words, first[:-1], first[1:], strict=True):
            last = np.concatenate([best[lo, :lead + 1], best[lo:hi, lead + 1:].ravel()])
            steps = np.concatenate([back[lo, :lead + 1], back[lo:hi, lead + 1:].ravel()]).tolist()
            path, at = [], len(w)
            while at:
                path.append(at)
                at -= steps[at]
            paths.append(last[path[::-1]])
        return np.concatenate(paths), np.concatenate([[0], np.cumsum([len(p) for p in paths])])

    def ids_of(self, pieces: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each path: characters that are no piece become bytes or unknown."""
        paths = np.split(pieces, offsets[1:-1])
        for w in np.unique(np.searchsorted(offsets, np.flatnonzero(pieces >= self.size), "right") - 1):
            out: list[int] = []
            for p in paths[w].tolist():
                if p < self.size:
                    out.append(p)
                elif self.byte:
                    out += [self.byte[b] for b in chr(p - self.size).encode()]
                else:
                    out.append(self.unknown)
            paths[w] = np.array(out)
        return paths

    def blanks(self, n: int) -> list[int]:
        """Ids of a run of ``n`` blanks: the leftmost two that make a piece merge
        first."""
        one = self.pieces.index(BLANK)
        known = self.blank_runs
        parts = _merge([BLANK] * n, lambda a, b: 0 if a + b in known else None)
        return [known.get(p, one) for p in parts]


def _merge(parts: list[str], rank, until: str | None = None) -> list[str]:
    """Merge neighbours by ``rank(a, b)`` (None: never), lowest first, leftmost of
    equals; stop before a merge that gives ``until``."""
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts):
            r = rank(parts[i], parts[after[i]])
            if r is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))

    for i in range(len(parts) - 1):
        offer(i)
    alive = [True] * len(parts)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(parts) or parts[i] != a or parts[j] != b:
            continue
        if a + b == until:
            break
        parts[i], alive[j], after[i] = a + b, False, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p, ok in zip(parts, alive, strict=True) if ok]


class Encoder:
    """Ids of texts, and texts of ids, under one model."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.v = Vocabulary.of(path)
        self.one = self.v.pieces.index(BLANK)
        self.table = SpanTable(self._learn, [])
        text = [bytes([int(p[1:-1], 16)]) if i in self.v.byte.values() else p.replace(BLANK, " ").encode()
                for i, p in enumerate(self.v.pieces)]
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(t) for t in text])])

    def _learn(self, spans: list[str]) -> list:
        """Ids of spans, each a run of blanks and what follows up to the next."""
        bare = [s.lstrip(BLANK) for s in spans]
        blanks = [len(s) - len(b) for s, b in zip(spans, bare, strict=True)]
        words = sorted({BLANK * (n > 0) + b for n, b in zip(blanks, bare, strict=True) if b}, key=len)
        paths: dict[str, np.ndarray] = {}
        lo = 0
        while lo < len(words) and len(words[lo]) <= CHUNK:
            most = -(-len(words[lo]) // 16) * 16 if len(words[lo]) > WHOLE else len(words[lo])
            hi = lo
            while hi < len(words) and len(words[hi]) <= most and hi - lo < WORDS:
                hi += 1
            chars, at = codepoints(words[lo:hi])
            rows = np.zeros((hi - lo, most), np.int64)
            rows[np.arange(most) < np.diff(at)[:, None]] = chars
            paths.update(zip(words[lo:hi], self.v.ids_of(*self.v.viterbi(rows, np.diff(at))), strict=True))
            lo = hi
        if lo < len(words):
            found = self.v.chunked([codepoints([w])[0] for w in words[lo:]])
            paths.update(zip(words[lo:], self.v.ids_of(*found), strict=True))
        out = []
        for n, b in zip(blanks, bare, strict=True):
            ids = paths[BLANK * (n > 0) + b] if b else self.v.blanks(n)
            if b and n > 1:
                alone = ids[0] == self.one
                ids = np.concatenate([self.v.blanks(n - 1 + alone), ids[1:] if alone else ids])
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and offsets by text."""
        if max(map(len, texts), default=0) <= PART:
            return self._encode([BLANK + t.replace(" ", BLANK) if t else "" for t in texts])
        ids = [[found for _, found in self.parts(t)] for t in texts]
        return (np.concatenate([x for found in ids for x in found]),
                np.concatenate([[0], np.cumsum([sum(map(len, found)) for found in ids])]))

    def _encode(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cp, ends = codepoints(marked)
        blank = cp == ord(BLANK)
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        first[ends[:-1][ends[:-1] < len(cp)]] = True
        starts = np.flatnonzero(first)
        size = np.diff(starts, append=len(cp))
        inner = np.flatnonzero(np.repeat(size > WHOLE, size) & ~first & ~blank)
        inner = inner[~blank[inner - 1]]
        if len(inner):
            first[inner[self.v.borders(cp[inner - 1], cp[inner])]] = True
            starts = np.flatnonzero(first)
        stops = np.append(starts[1:], len(cp))[: len(starts)]
        entry = self.table.entries(span_hashes(prefix_hashes(cp), starts, stops), starts, stops, "".join(marked))
        ids, at = self.table.gather(entry)
        return ids, at[np.searchsorted(starts, ends)]

    def _opens(self, window: str) -> np.ndarray:
        """Places in ``window``, but the first, where a text may be parted."""
        cp = codepoints([window.replace(" ", BLANK)])[0]
        blank = cp == ord(BLANK)
        return 1 + np.flatnonzero(~blank[:-1] & (blank[1:] | self.v.borders(cp[:-1], cp[1:])))

    def parts(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """A text's parts with their ids; all parts' ids are the text's."""
        lo = 0
        for hi in part_ends(text, self._opens, PART):
            part = text[lo:hi]
            yield part, self._encode([BLANK * (lo == 0 < hi) + part.replace(" ", BLANK)])[0]
            lo = hi

    def decode(self, ids: np.ndarray, offsets: np.ndarray, inner: bool = False) -> list[str]:
        """Texts of id sequences; bytes that are no UTF-8 become U+FFFD.  ``inner``
        sequences are parts of a text but the first: no blank was set before them."""
        ids = np.asarray(ids, np.int64)
        size = (self.bytes_at[1:] - self.bytes_at[:-1])[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        raw = self.bytes[np.repeat(self.bytes_at[ids] - at[:-1], size) + np.arange(at[-1])].tobytes()
        where = at[offsets]
        return [raw[s + (not inner and raw[s: s + 1] == b" " and e > s): e].decode("utf-8", "replace")
                for s, e in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]


def _encode(batches, path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path)
    for b in slices(batches, "text"):
        texts = [t or "" for t in b.column("text").to_pylist()]
        ids, at = encoder.encode(texts)
        raw = memoryview(ids.astype("<u4")).cast("B")
        crc = [zlib.crc32(raw[4 * s: 4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), lists, pa.array(crc, pa.int64()),
             pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64())],
            names=["doc_id", "ids", "ids_crc32", "text_crc32"])


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, ids_crc32 (of the ids as little-endian 32-bit numbers) and
    text_crc32 (of the text's UTF-8): one row for each row of ``docs``.

    Null texts count as empty and give no ids.  Repeated rows stay; there are no
    ties, as no two merges share a rank; further columns are left out; no rows:
    no rows.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(read, partial(_encode, path=model or default_model()),
                     "doc_id long, ids array<int>, ids_crc32 long, text_crc32 long")


def _decode(batches, path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path)
    for b in batches:
        lists = b.column("ids")
        at = lists.offsets.to_numpy()
        texts = encoder.decode(lists.flatten().to_numpy(), at - at[0])
        names = [c for c in b.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(lists.value_lengths(), pa.int32()),
                                          pa.array(texts, pa.string())], names=[*names, "n_ids", "text"])


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with its ``ids`` turned into n_ids and text.  A null list gives an
    empty text."""
    read = encoded.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    kinds = encoded.drop("ids").schema.simpleString()[len("struct<"):-1]
    return map_arrow(read, partial(_decode, path=model or default_model()), f"{kinds}, n_ids int, text string")


def _figures(encoder: Encoder, texts: list[str]) -> list[tuple]:
    """n_ids, ids_crc32, text_crc32, decoded_crc32 and equality of each text."""
    ids, at = encoder.encode(texts)
    back = encoder.decode(ids, at)
    raw = memoryview(ids.astype("<u4")).cast("B")
    return [(e - s, zlib.crc32(raw[4 * s: 4 * e]), zlib.crc32(t.encode()), zlib.crc32(d.encode()), t == d)
            for s, e, t, d in zip(at[:-1].tolist(), at[1:].tolist(), texts, back, strict=True)]


def _long_figures(encoder: Encoder, text: str) -> tuple:
    """The same of a very long text, part by part."""
    n = ids_crc = text_crc = back_crc = 0
    same = True
    for k, (part, ids) in enumerate(encoder.parts(text)):
        back = encoder.decode(ids, np.array([0, len(ids)]), inner=k > 0)[0]
        n += len(ids)
        ids_crc = zlib.crc32(ids.astype("<u4").tobytes(), ids_crc)
        text_crc, back_crc = zlib.crc32(part.encode(), text_crc), zlib.crc32(back.encode(), back_crc)
        same &= part == back
    return n, ids_crc, text_crc, back_crc, same


def _round_trip(batches, path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path)
    for b in slices(batches, "text"):
        texts = [t or "" for t in b.column("text").to_pylist()]
        long = {i: _long_figures(encoder, t) for i, t in enumerate(texts) if len(t) > PART}
        rows = _figures(encoder, ["" if i in long else t for i, t in enumerate(texts)])
        n, ids_crc, text_crc, back_crc, same = zip(*(long.get(i, r) for i, r in enumerate(rows)), strict=True)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_crc, pa.int64()),
             pa.array(text_crc, pa.int64()), pa.array(back_crc, pa.int64()), pa.array(same, pa.bool_())],
            names=["doc_id", "n_ids", "ids_crc32", "text_crc32", "decoded_crc32", "round_trip"])


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32, text_crc32, decoded_crc32 and round_trip (the two
    texts are equal): every text encoded and decoded again where it is read, so
    no ids travel.  Only U+2581, which the model itself takes for a blank, does
    not come back.  Rows as of :func:`encode`."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(read, partial(_round_trip, path=model or default_model()),
                     "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, decoded_crc32 long, round_trip boolean")
