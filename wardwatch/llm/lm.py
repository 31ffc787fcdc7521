"""Language-model scoring with a log-bilinear model.

Words are counted over all training documents.  The most frequent ones are units
of their own; the others share a unit with those of a like ending.  The number of
units grows with the tokens.  A unit is predicted from the units before it: each has a vector, a position weighs its
components, and the sum q meets the vectors of the next unit's class and of the
unit within its class (as many classes as units in one).  Both steps are soft-
maxes over a few matrix products, so every unit's probability is normalised at
the cost of a small multiple of their number's root.  A shared unit's words
divide its probability by their smoothed counts.

Training is noise-contrastive estimation in numpy: in each round a share of the
training documents is dealt out to shards of SHARD bytes, whatever the splits of the
input; every shard is gone through from the same start, and the results are averaged
by the tokens seen, summed up on the executors.  The rounds together go through every
training document, and there is one more for every fourfold of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, cut, fold, map_arrow, slices, sum_rows, text_bytes
from .textops import mix, prefix_hashes, span_hashes

LEAST, MOST = 16, 128          # classes, and units in each, at least and at most (6 MB of parameters a task)
SIZE = 24                      # components of a vector
CONTEXT = 3
NOISE = 16
SHARD = 16_000_000             # bytes of text that a task trains on in a round, about
BATCH = 64                     # tokens of a training step for each class
KNOWN = 1_000_000              # words whose counts every task holds, at most
FLUSH = 2_000_000              # distinct words that a counting task holds
SLAB = 16_384                  # tokens scored at once
SLICE = 1 << 19
AVERAGERS = 32
BUCKETS = 4096                 # of documents, dealt out to the rounds


def classes_of(tokens: int) -> int:
    """Classes, and units in each, for so many training tokens: a multiple of eight
    that grows as their fourth root, so units as their square root, within bounds."""
    return int(np.clip(8 * round(tokens ** 0.25 / 16), LEAST, MOST))


def rounds_of(size: int) -> int:
    """Rounds for so many bytes of training text."""
    return 2 + int(np.log2(max(1.0, size / SHARD)) / 2)


# --- words ----------------------------------------------------------------------


def _parts(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, bool, bool]]:
    """(texts, rows, begins, ends): short texts together; a long one in several
    parts, cut after white space."""
    short = [i for i, t in enumerate(texts) if len(t) <= 2 * SLICE]
    if short:
        yield [texts[i] for i in short], np.array(short), True, True
    for i, t in enumerate(texts):
        lo = 0
        while len(t) > 2 * SLICE and lo < len(t):
            hi = min(len(t), lo + SLICE)
            while hi < len(t) and not t[hi - 1: hi].isspace():
                hi += 1
            yield [t[lo:hi]], np.array([i]), lo == 0, hi == len(t)
            lo = hi


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending (last two bytes as a number) of every word, and word offsets by
    text.  A-Z count as a-z; words end at blanks and bytes 9 to 13."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    raw = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, stops = edge[::2], edge[1::2]
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    tail = raw[stops - 1].astype(np.int64) if len(stops) else np.zeros(0, np.int64)
    ending = tail * 256 + np.where(stops - starts > 1, raw[np.maximum(stops - 2, 0)], 0)
    return span_hashes(prefix_hashes(raw), starts, stops), ending, np.searchsorted(starts, bounds)


def _counts(batches) -> Iterator[pa.RecordBatch]:
    """Distinct words of a task's texts with their number and ending."""
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def merged():
        key = np.concatenate([k for k, _, _ in kept])
        own, first, back = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n, _ in kept])).astype(np.int64)
        return own, n, np.concatenate([e for _, _, e in kept])[first]

    def rows(own, n, ending):
        return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n), pa.array(ending.astype(np.int32))],
                                          names=["h", "n", "ending"])

    for b in slices(batches, "text", SLICE):
        for texts, _, _, _ in _parts(b.column("text").to_pylist()):
            key, ending, _ = words(texts)
            own, first, n = np.unique(key, return_index=True, return_counts=True)
            kept.append((own, n, ending[first]))
            held += len(own)
        if held > FLUSH:
            kept = [merged()]
            held = len(kept[0][0])
            if held > FLUSH // 2:
                yield rows(*kept[0])
                kept, held = [], 0
    if kept:
        yield rows(*merged())


@dataclass
class Vocabulary:
    """Corpus counts, and what every task holds of them."""
    tokens: int                # N, ends included
    distinct: int              # V, the end included
    texts: int                 # count of the end token
    key: np.ndarray            # hashes of the known words, sorted
    count: np.ndarray
    unit: np.ndarray           # their units
    end_unit: int
    ending_unit: np.ndarray    # unit of each group of endings
    rest_count: np.ndarray     # by group: tokens and words that have no unit of
    rest_words: np.ndarray     # their own
    share: np.ndarray          # probability of each unit

    @property
    def classes(self) -> int:
        return math.isqrt(len(self.share))


def _group(ending: np.ndarray, groups: int) -> np.ndarray:
    """The group of each ending; each group has a shared unit."""
    return (mix(ending.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def count_words(training: DataFrame) -> DataFrame:
    """(h, n, ending): every distinct word of all training texts."""
    return (map_arrow(training.select(text_bytes().alias("text")), _counts, "h long, n long, ending int")
            .groupBy("h").agg(F.sum("n").alias("n"), F.first("ending").alias("ending")))


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """Collects totals (by ending, at most 65,536) and at most KNOWN words: those that
    occur at least 2**p times, with the least p that leaves no more."""
    steps = (counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p"))
             .agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).orderBy(F.desc("p")).collect())
    held, least = 0, 62
    for row in steps:
        held += row["words"]
        if held > KNOWN:
            break
        least = row["p"]
    top = collected(counts.filter(F.col("n") >= (1 << least)))
    by_ending = collected(counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")))
    n = int(sum(r["n"] for r in steps)) + texts
    classes = classes_of(n)
    units, groups = classes * classes, 2 * classes - 1
    group = _group(by_ending["ending"], groups)
    rest_count = np.bincount(group, by_ending["n"], groups).astype(float)
    rest_words = np.bincount(group, by_ending["words"], groups).astype(float)
    key = top["h"].view(np.uint64)
    order = np.argsort(key)
    key, count, ending = key[order], top["n"][order], _group(top["ending"][order], groups)
    own = np.lexsort((key, -count))[: units - 1 - groups]
    np.subtract.at(rest_count, ending[own], count[own])
    np.subtract.at(rest_words, ending[own], 1)
    mass = np.concatenate([[texts + 0.5], count[own] + 0.5, rest_count + 0.5 * (rest_words + 1),
                           np.zeros(units - 1 - groups - len(own)) + 1e-3])
    place = np.empty(units, np.int64)                  # units in the order of their mass
    place[np.argsort(-mass, kind="stable")] = np.arange(units)
    share = np.empty(units)
    share[place] = mass / mass.sum()
    ending_unit = place[1 + len(own): 1 + len(own) + groups]
    unit = ending_unit[ending] if len(ending) else np.zeros(0, np.int64)
    unit[own] = place[1: 1 + len(own)]
    return Vocabulary(n, int(sum(r["words"] for r in steps)) + (texts > 0), texts, key, count,
                      unit.astype(np.int32), int(place[0]), ending_unit, rest_count, rest_words, share)


def _lookup(voc: Vocabulary, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash stands among the known words, and whether it does."""
    if not len(voc.key):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    own, back = np.unique(key, return_inverse=True)
    at = np.minimum(np.searchsorted(voc.key, own), len(voc.key) - 1)
    return at[back], (voc.key[at] == own)[back]


def _sequence(unit: np.ndarray, offsets: np.ndarray, end: int, before: np.ndarray,
              closes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units with an end after every text, their contexts, offsets by text).  A
    context is the CONTEXT units before; before a text stand ``before``."""
    flat = np.insert(unit, offsets[1:], end) if closes else unit
    at = offsets + np.arange(len(offsets)) if closes else offsets
    place = np.arange(len(flat)) - np.repeat(at[:-1], np.diff(at))
    context = np.empty((len(flat), CONTEXT), np.int64)
    for j in range(CONTEXT):
        context[:, j] = np.where(place > j, np.roll(flat, j + 1), before[np.clip(j - place, 0, CONTEXT - 1)])
    return flat, context, at


# --- the model --------------------------------------------------------------------


@dataclass
class Model:
    context: np.ndarray        # units by components
    weight: np.ndarray         # positions by components
    group: np.ndarray          # classes by components
    group_bias: np.ndarray
    unit: np.ndarray           # units by components
    unit_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.weight, self.group, self.group_bias, self.unit, self.unit_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @property
    def classes(self) -> int:
        return len(self.group_bias)

    @classmethod
    def of(cls, flat: np.ndarray, classes: int) -> Model:
        units = classes * classes
        shapes = [(units, SIZE), (CONTEXT, SIZE), (classes, SIZE), (classes,), (units, SIZE), (units,)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return cls(*(p.reshape(s).astype(np.float32) for p, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)))


def start(share: np.ndarray, seed: int = 9) -> Model:
    """A model that predicts every unit by its share, whatever comes before."""
    rng, classes = np.random.default_rng(seed), math.isqrt(len(share))
    group = share.reshape(classes, classes).sum(axis=1)
    return Model.of(np.concatenate([
        rng.normal(0, 0.1, len(share) * SIZE), 1.0 / (1 + np.repeat(np.arange(CONTEXT), SIZE)),
        rng.normal(0, 0.1, classes * SIZE), np.log(group),
        rng.normal(0, 0.1, len(share) * SIZE), np.log(share) - np.log(np.repeat(group, classes))]), classes)


def _hidden(m: Model, context: np.ndarray) -> np.ndarray:
    q = m.context[context[:, 0]] * m.weight[0]
    for j in range(1, CONTEXT):
        q += m.context[context[:, j]] * m.weight[j]
    return q


def _scatter(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by ``index``."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    order = np.argsort(index, kind="stable")
    own = index[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out[own[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Trainer:
    """AdaGrad steps on the noise-contrastive loss: each true class (and unit in its
    class) against NOISE drawn by their shares, shared by a batch."""

    def __init__(self, model: Model, share: np.ndarray, seed: int, rate: float = 0.3):
        self.m, self.rate, self.rng, self.tokens = model, rate, np.random.default_rng(seed), 0
        self.classes, self.batch = model.classes, BATCH * model.classes
        self.group_share = share.reshape(self.classes, self.classes).sum(axis=1)
        self.unit_share = share.reshape(self.classes, self.classes) / self.group_share[:, None]
        self.group_ends = np.cumsum(self.group_share)
        self.unit_ends = np.cumsum(self.unit_share, axis=1)
        self.log_group = np.log(NOISE * self.group_share).astype(np.float32)
        self.log_unit = np.log(NOISE * self.unit_share).ravel().astype(np.float32)
        self.seen = [np.full(a.shape, 1.0, np.float32) for a in model.arrays()]

    @staticmethod
    def _contrast(q, true, noise, vec, bias, log_share):
        """Gradients of one softmax's contrast: to q, and (rows, values, sums) to the
        vectors and biases.  ``bias`` and ``log_share`` are of all vectors."""
        mine, other = vec[true], vec[noise]
        pos = _sigmoid(np.einsum("nd,nd->n", q, mine) + (bias - log_share)[true]) - 1
        neg = _sigmoid(q @ other.T + (bias - log_share)[noise])
        return (pos[:, None] * mine + neg @ other, np.concatenate([true, noise]),
                np.concatenate([pos[:, None] * q, neg.T @ q]), np.concatenate([pos, neg.sum(axis=0)]))

    def step(self, target: np.ndarray, context: np.ndarray) -> None:
        m, n, classes = self.m, len(target), self.classes
        group = target // classes
        order = np.argsort(group, kind="stable")               # classes one after another
        target, context, group = target[order], context[order], group[order]
        ends = np.searchsorted(group, np.arange(classes + 1))
        q = _hidden(m, context)
        noise = np.minimum(np.searchsorted(self.group_ends, self.rng.random(NOISE)), classes - 1)
        to_q, rows, values, ones = self._contrast(q, group, noise, m.group, m.group_bias, self.log_group)
        grads = [None, None, _scatter(rows, values, classes), np.bincount(rows, ones, classes)]
        draws = (self.rng.random((classes, NOISE, 1)) > self.unit_ends[:, None, :]).sum(axis=2)
        draws = np.minimum(draws, classes - 1) + np.arange(classes)[:, None] * classes
        found = []
        for c in np.flatnonzero(np.diff(ends)):
            mine = slice(ends[c], ends[c + 1])
            more, *rest = self._contrast(q[mine], target[mine], draws[c], m.unit, m.unit_bias, self.log_unit)
            to_q[mine] += more
            found.append(rest)
        rows, values, ones = (np.concatenate(x) for x in zip(*found, strict=True))
        grads += [_scatter(rows, values, classes * classes), np.bincount(rows, ones, classes * classes)]
        grads[1] = np.stack([np.einsum("nd,nd->d", to_q, m.context[context[:, j]]) for j in range(CONTEXT)])
        grads[0] = _scatter(context.T.ravel(), np.concatenate([to_q * w for w in m.weight]), classes * classes)
        for a, g, s in zip(m.arrays(), grads, self.seen, strict=True):
            g = (g * (64 / n)).astype(np.float32)
            s += g * g
            a -= self.rate * g / np.sqrt(s)
        self.tokens += n


def _train(batches, voc, flat, seed: int) -> Iterator[pa.RecordBatch]:
    """One task's steps from the shared start: its parameters times its tokens."""
    v = voc.value
    trainer = Trainer(Model.of(flat.value.copy(), v.classes), v.share, seed)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def steps(rest: bool) -> None:
        nonlocal waiting
        if not waiting:
            return
        target = np.concatenate([t for t, _ in waiting])
        context = np.concatenate([c for _, c in waiting])
        last = len(target) if rest else len(target) // trainer.batch * trainer.batch
        for lo in range(0, last, trainer.batch):
            trainer.step(target[lo: lo + trainer.batch], context[lo: lo + trainer.batch])
        waiting = [(target[last:], context[last:])]

    for b in slices(batches, "text", SLICE):
        before = np.full(CONTEXT, v.end_unit)
        for texts, _, begins, closes in _parts(b.column("text").to_pylist()):
            if begins:
                before = np.full(CONTEXT, v.end_unit)
            flat_units, context, _ = _units(v, texts, before, closes)[:3]
            before = _carry(before, flat_units)
            waiting.append((flat_units, context))
            steps(False)
    steps(True)
    if trainer.tokens:
        params = trainer.m.flat().astype(np.float64) * trainer.tokens
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([trainer.tokens], pa.int64()),
                                          pa.array([params.tobytes()], pa.binary())],
                                         names=["task", "tokens", "params"])


def _carry(before: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The last CONTEXT units, the latest first."""
    return np.concatenate([units[::-1][:CONTEXT], before])[:CONTEXT]


def _units(v: Vocabulary, texts: list[bytes], before: np.ndarray, closes: bool):
    key, ending, offsets = words(texts)
    ending = _group(ending, len(v.ending_unit))
    at, known = _lookup(v, key)
    unit = v.ending_unit[ending]
    if len(v.key):
        unit = np.where(known, v.unit[at], unit)
    flat, context, where = _sequence(unit.astype(np.int64), offsets, v.end_unit, before, closes)
    return flat, context, where, key, ending, offsets, at, known


def _summed(batches) -> Iterator[pa.RecordBatch]:
    """Sums of the tasks' parameters, one row at a time."""
    total, tokens = None, 0
    for b in batches:
        for params, n in zip(b.column("params").to_pylist(), b.column("tokens").to_pylist(), strict=True):
            x = np.frombuffer(params, np.float64)
            total = x.copy() if total is None else total + x
            tokens += n
    if tokens:
        yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                         names=["tokens", "params"])


def train(training: DataFrame, voc: Vocabulary, rounds: int | None = None, share: int | None = None) -> Model:
    """Rounds of parallel training; round i takes the documents whose hash modulo
    ``share`` is i modulo share, dealt out evenly to shards.  There are as many rounds
    as shares at least, so that every training document is gone through.  By default
    the size of the text gives the rounds, each with its own share."""
    sc = training.sparkSession.sparkContext
    bucket = F.pmod(F.xxhash64("doc_id", F.lit("lm")), F.lit(BUCKETS))
    size = collected(training.groupBy(bucket.alias("b")).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("bytes")))    # at most BUCKETS rows
    rounds = rounds or rounds_of(int(size["bytes"].sum()))
    share = share or rounds
    rounds = max(rounds, share)
    shared, model = sc.broadcast(voc), start(voc.share)
    for i in range(rounds):
        flat = sc.broadcast(model.flat())
        part = training.filter(bucket % share == i % share).select(text_bytes().alias("text"))
        shards = math.ceil(size["bytes"][size["b"] % share == i % share].sum() / SHARD)
        own = map_arrow(part.repartition(max(1, shards)), partial(_train, voc=shared, flat=flat, seed=i),
                        "task int, tokens long, params binary")
        sums = map_arrow(own.repartition(AVERAGERS, "task").select("tokens", "params"), _summed, "tokens long, params binary")
        for total in map_arrow(sums.repartition(1), _summed, "tokens long, params binary").collect():   # one row, or none
            model = Model.of(np.frombuffer(total["params"], np.float64) / total["tokens"], voc.classes)
    return model


def _log_softmax_at(scores: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Overwrites ``scores``."""
    mine, top = scores[np.arange(len(scores)), column], scores.max(axis=1)
    scores -= top[:, None]
    return mine - top - np.log(np.exp(scores, out=scores).sum(axis=1))


def log_probabilities(m: Model, target: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target unit after its context, normalised
    over all units."""
    out, classes = np.empty(len(target)), m.classes
    for lo in range(0, len(target), SLAB):
        order = lo + np.argsort(target[lo: lo + SLAB], kind="stable")      # classes one after another
        group, column = np.divmod(target[order], classes)
        q = _hidden(m, context[order])
        found = _log_softmax_at(q @ m.group.T + m.group_bias, group)
        ends = np.searchsorted(group, np.arange(classes + 1))
        for c in np.flatnonzero(np.diff(ends)):
            mine, own = slice(ends[c], ends[c + 1]), slice(c * classes, (c + 1) * classes)
            found[mine] += _log_softmax_at(q[mine] @ m.unit[own].T + m.unit_bias[own], column[mine])
        out[order] = found
    return out


# --- scoring ----------------------------------------------------------------------


def _score(batches, voc, flat) -> Iterator[pa.RecordBatch]:
    """Per text: what its known words, ends and units score, and a list of the
    words whose counts are elsewhere."""
    v = voc.value
    m = Model.of(flat.value, v.classes)
    whole = np.log10(v.tokens + 0.5 * (v.distinct + 1))
    end_base = np.log10(v.texts + 0.5) - whole
    rest = np.log10(v.rest_count + 0.5 * (v.rest_words + 1))
    base_of = np.log10(v.count + 0.5)
    shared = np.isin(v.unit, v.ending_unit)
    for b in slices(batches, "text", SLICE):
        n = b.num_rows
        tokens, known_n = np.ones(n, np.int64), np.full(n, int(v.texts > 0), np.int64)
        base, score = np.full(n, end_base), np.zeros(n)
        far = []
        before = np.full(CONTEXT, v.end_unit)
        for texts, rows, begins, closes in _parts(b.column("text").to_pylist()):
            if begins:
                before = np.full(CONTEXT, v.end_unit)
            units, context, where, key, ending, offsets, at, known = _units(v, texts, before, closes)
            before = _carry(before, units)
            tokens[rows] += np.diff(offsets)
            known_n[rows] += sum_rows(known.astype(np.int64), offsets)
            gain = np.zeros(len(key))
            word_base = np.zeros(len(key))
            if len(v.key):
                word_base = np.where(known, base_of[at] - whole, 0)
                gain = np.where(known & shared[at], base_of[at] - rest[ending], 0)
            base[rows] += sum_rows(word_base, offsets)
            score[rows] += sum_rows(gain, offsets)
            score[rows] += sum_rows(log_probabilities(m, units, context), where) / np.log(10)
            row = np.repeat(rows, np.diff(offsets))[~known]
            order = np.lexsort((key[~known], row))
            far.append((row[order], key[~known][order], ending[~known][order]))
        row, key, ending = (np.concatenate(x) for x in zip(*far, strict=True))
        if len(far) > 1:
            order = np.lexsort((key, row))
            row, key, ending = row[order], key[order], ending[order]
        first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        times = np.diff(np.append(first, len(key)))
        items = pa.StructArray.from_arrays(
            [pa.array(key[first].view(np.int64)), pa.array(ending[first].astype(np.int32)),
             pa.array(times.astype(np.int32))], names=["h", "ending", "n"])
        ends = pa.array(np.searchsorted(row[first], np.arange(n + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array(tokens), pa.array(known_n), pa.array(base),
             pa.array(score), pa.ListArray.from_arrays(ends, items)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "far"])


def score(docs: DataFrame, rounds: int | None = None, share: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row
    for each row of ``docs``; scores are log10 probabilities of the whole text.

    Learned from the rows whose crc32(doc_id as text) modulo 5 is not 1.  Null
    texts count as empty: a single end token.  Repeated rows are scored alike,
    and count as often as they occur; ties in count are broken by a word's hash.
    With no training rows every word is unknown.  Further columns are left out;
    no rows: no rows.
    """
    ours = docs.select("doc_id", "text", (fold() == 1).alias("held_out"))
    training = ours.filter("not held_out")
    counts = cut(count_words(training))
    voc = vocabulary(counts, training.count())
    model = train(training, voc, rounds, share)
    sc = docs.sparkSession.sparkContext
    read = ours.select("doc_id", "held_out", text_bytes().alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    near = cut(map_arrow(read, partial(_score, voc=sc.broadcast(voc), flat=sc.broadcast(model.flat())),
                         f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
                         "score double, far array<struct<h: long, ending: int, n: int>>")
               .withColumn("row", F.monotonically_increasing_id()))
    rest = docs.sparkSession.createDataFrame(
        [(i, float(np.log10(c + 0.5 * (w + 1)))) for i, (c, w) in enumerate(zip(voc.rest_count, voc.rest_words, strict=True))],
        "ending int, rest double")
    whole = float(np.log10(voc.tokens + 0.5 * (voc.distinct + 1)))
    few = counts.select("h", F.col("n").alias("c"))
    far = (near.select("row", F.explode("far").alias("w")).select("row", "w.*")
           .join(few, "h", "left").join(F.broadcast(rest), "ending")           # 2 * MOST - 1 rows at most
           .withColumn("own", F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)))
           .groupBy("row").agg(
               F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).cast("long").alias("far_known"),
               F.sum(F.col("n") * (F.col("own") - whole)).alias("far_base"),
               F.sum(F.col("n") * (F.col("own") - F.col("rest"))).alias("far_score")))
    return near.drop("far").join(far, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(voc.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("far_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("far_score", F.lit(0.0))).alias("score"))
