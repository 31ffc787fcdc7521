"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score = w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions cost as much as the features themselves.  Features
are built in numpy for many texts at once, on the executors, for fitting and
scoring alike; the machine is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, fold, map_arrow, ship, slices, sum_rows
from .textops import class_table, codepoints, prefix_hashes, span_hashes

WORDS = 1 << 13                # hash buckets of words
RANK = 8
TRAIN_DOCS = 12_000            # labelled documents that are fitted on, at most about
EPOCHS = 6
THRESHOLD = 0.3
SLICE = 1 << 18
LONG = 1 << 20                 # characters of a text that are worked on at once

#: Bounds of the bins of a share, and of a length (in doublings).
SHARES = np.array([.002, .005, .01, .02, .05, .1, .15, .2, .3, .4, .5, .6, .7, .8, .9, .97])
LENGTHS = 2.0 ** np.arange(1, 17)
BINS = len(SHARES) + 2         # one for below, one for a missing value
SIGNS = "|!#$%&*<>{}=_@"       # signs that are counted one by one
#: Statistics binned by SHARES, then those binned by LENGTHS.
SHARE_STATS = ["upper", "digit", "blank", "punctuation", "sign", "line", "repeat", "distinct",
               "ends_in_sign", "one_letter", "length_given", *SIGNS]
LENGTH_STATS = ["words", "characters", "word_length", "n_chars"]
FEATURES = WORDS + BINS * (len(SHARE_STATS) + len(LENGTH_STATS))


@dataclass
class Model:
    bias: float
    weight: np.ndarray         # features
    factor: np.ndarray         # features by rank


def _parts(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Texts with their rows, those of over LONG characters cut after a blank."""
    short = [i for i, t in enumerate(texts) if len(t) <= LONG]
    if short:
        yield [texts[i] for i in short], np.array(short)
    for i, t in enumerate(texts):
        lo = 0
        while len(t) > LONG and lo < len(t):
            hi = lo + LONG
            while hi < min(len(t), lo + 2 * LONG) and not t[hi - 1].isspace():
                hi += 1
            yield [t[lo:hi]], np.array([i])
            lo = hi


def _raw(texts: list[str], rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Word buckets by row as keys (row * WORDS + bucket) with counts, and counts of
    everything that the statistics are made of, each by row."""
    cp, ends = codepoints(texts)
    space = class_table("space", str.isspace)[cp]
    letter = class_table("letter", str.isalpha)[cp]
    upper = class_table("upper", str.isupper)[cp]
    digit = class_table("digit", str.isdigit)[cp]
    stats: dict[str, np.ndarray] = {}

    def put(name: str, by_text: np.ndarray) -> None:
        stats[name] = np.bincount(rows, by_text, n)

    def count(name: str, mask: np.ndarray) -> None:
        put(name, sum_rows(mask.astype(np.int64), ends))

    plain = np.isin(cp, [ord(c) for c in ".,;:'\"-?()"])
    put("characters", np.diff(ends))
    count("letter", letter)
    count("upper", upper)
    count("digit", digit)
    count("blank", space)
    count("punctuation", plain)
    count("sign", ~(letter | digit | space | plain))
    count("line", cp == 10)
    for c in SIGNS:
        count(c, cp == ord(c))
    # words: runs without white space, hashed in lower case
    lower = np.where(upper & (cp < 0x250), _lower_table()[np.minimum(cp, 0x24F)], cp)
    before = np.concatenate([[True], space[:-1]])
    before[ends[:-1][ends[:-1] < len(cp)]] = True
    starts = np.flatnonzero(before & ~space)
    after = np.concatenate([space[1:], [True]])
    after[ends[1:][ends[1:] > 0] - 1] = True
    stops = np.flatnonzero(after & ~space) + 1
    key = span_hashes(prefix_hashes(lower), starts, stops)
    at = np.searchsorted(starts, ends)
    row = rows[np.searchsorted(ends, starts, "right") - 1] if len(starts) else np.zeros(0, np.int64)
    put("words", np.diff(at))
    by_row = lambda mask: np.bincount(row[mask], minlength=n).astype(float)
    stats["ends_in_sign"] = by_row(~(letter | digit | plain)[stops - 1]) if len(stops) else np.zeros(n)
    stats["one_letter"] = by_row(stops - starts == 1) if len(stops) else np.zeros(n)
    again = np.concatenate([[False], (key[1:] == key[:-1]) & (row[1:] == row[:-1])]) if len(key) \
        else np.zeros(0, bool)
    stats["repeat"] = by_row(again)
    bucket, times = np.unique(row * WORDS + (key % np.uint64(WORDS)).astype(np.int64), return_counts=True)
    return bucket, times, stats


def _lower_table() -> np.ndarray:
    """Lower case of the code points below U+0250 whose lower case is one of them."""
    return np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, range(0x250))],
                    np.uint32)


def features(texts: list[str | None], n_chars: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: feature numbers, values, and offsets by text.  Words enter by
    the square root of their share, statistics and metadata by their bin."""
    n = len(texts)
    clean = [t or "" for t in texts]
    keys, times, stats = [], [], {}
    for part, rows in _parts(clean):
        k, c, more = _raw(part, rows, n)
        keys.append(k)
        times.append(c)
        stats = {name: stats.get(name, 0) + x for name, x in more.items()}
    key, back = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
    count = np.bincount(back, np.concatenate(times) if times else None, len(key))
    row = key // WORDS
    chars, words = np.maximum(stats["characters"], 1), np.maximum(stats["words"], 1)
    value = np.sqrt(count / words[row])
    given = np.array([np.nan if c is None else c for c in n_chars], float)
    share = {name: stats[name] / chars for name in
             ("digit", "blank", "punctuation", "sign", "line", *SIGNS)}
    share |= {"upper": stats["upper"] / np.maximum(stats["letter"], 1), "repeat": stats["repeat"] / words,
              "distinct": np.bincount(row, minlength=n) / np.minimum(words, WORDS),
              "ends_in_sign": stats["ends_in_sign"] / words, "one_letter": stats["one_letter"] / words,
              "length_given": given / np.maximum(chars, given) / 2}
    length = {"words": stats["words"], "characters": stats["characters"],
              "word_length": (stats["characters"] - stats["blank"]) / words, "n_chars": given}
    binned = [np.where(np.isnan(share[s]), BINS - 1, np.searchsorted(SHARES, share[s])) for s in SHARE_STATS]
    binned += [np.where(np.isnan(length[s]), BINS - 1, np.searchsorted(LENGTHS, length[s])) for s in LENGTH_STATS]
    dense = WORDS + np.arange(len(binned)) * BINS + np.stack(binned, axis=1)
    index = np.concatenate([key % WORDS, dense.ravel()])
    owner = np.concatenate([row, np.repeat(np.arange(n), len(binned))])
    value = np.concatenate([value, np.full(dense.size, len(binned) ** -0.5)])
    order = np.argsort(owner, kind="stable")
    return (index[order].astype(np.int32), value[order].astype(np.float32),
            np.searchsorted(owner[order], np.arange(n + 1)))


def raw_scores(model: Model, index: np.ndarray, value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The machine's value of each sparse row, in time linear in the features."""
    vx = model.factor[index] * value[:, None]
    sums = sum_rows(vx, at)
    return (model.bias + sum_rows(model.weight[index] * value, at)
            + 0.5 * ((sums ** 2).sum(axis=1) - sum_rows((vx ** 2).sum(axis=1), at)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, rank: int = RANK,
          epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5, batch: int = 64) -> Model:
    """Logistic loss by AdaGrad over shuffled batches of sparse rows."""
    rng = np.random.default_rng(11)
    share = np.clip((label.sum() + 1) / (len(label) + 2), 1e-3, 1 - 1e-3)
    model = Model(float(np.log(share / (1 - share))), np.zeros(FEATURES, np.float32),
                  rng.normal(0, 0.05, (FEATURES, rank)).astype(np.float32))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, rank), 1e-6, np.float32), 1e-6
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo: lo + batch]
            index = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            at = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in pick])])
            p = 1 / (1 + np.exp(-np.clip(raw_scores(model, index, value, at), -30, 30)))
            err = ((p - label[pick]) / len(pick)).astype(np.float32)
            each = np.repeat(err, np.diff(at)) * value
            own, back = np.unique(index, return_inverse=True)
            g_w = np.bincount(back, each, len(own)).astype(np.float32) + decay * model.weight[own]
            vx = model.factor[index] * value[:, None]
            grad = each[:, None] * (np.repeat(sum_rows(vx, at), np.diff(at), axis=0) - vx)
            g_v = np.stack([np.bincount(back, grad[:, f], len(own)) for f in range(rank)], axis=1)
            g_v = g_v.astype(np.float32) + decay * model.factor[own]
            seen_w[own] += g_w ** 2
            seen_v[own] += g_v ** 2
            seen_b += err.sum() ** 2
            model.weight[own] -= rate * g_w / np.sqrt(seen_w[own])
            model.factor[own] -= rate / 2 * g_v / np.sqrt(seen_v[own])
            model.bias -= float(rate * err.sum() / np.sqrt(seen_b))
    return model


def _sparse(batches):
    for b in slices(batches, "text", SLICE):
        index, value, at = features(b.column("text").to_pylist(), b.column("n_chars").to_pylist())
        spans = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("quality"),
             pa.array([index[s:e].tobytes() for s, e in spans], pa.binary()),
             pa.array([value[s:e].tobytes() for s, e in spans], pa.binary())],
            names=["doc_id", "quality", "idx", "val"])


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on the documents outside the held-out fold (crc32 of the doc_id as text,
    modulo 5, is 0) with a label 0 or 1: all of them up to ``train_docs``, else a
    hash sample of about that many.  A document with several labels counts as
    the lowest; a repeated doc_id counts once."""
    known = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("quality"))
             .filter("__id is not null and quality in (0, 1)").filter(fold("__id") != 0)
             .groupBy("__id").agg(F.min("quality").alias("quality")))
    n = known.count()
    if not n:
        return Model(0.0, np.zeros(FEATURES, np.float32), np.zeros((FEATURES, RANK), np.float32))
    if n > train_docs:
        share = F.pmod(F.xxhash64("__id", F.lit("quality")), F.lit(1 << 20))
        known = known.filter(share < int(train_docs / n * (1 << 20)) + 1)
    sample = docs.select("doc_id", "text", _n_chars(docs)).join(       # about train_docs rows of 12 bytes
        F.broadcast(known), F.col("doc_id").cast("long") == F.col("__id"))
    ship(docs.sparkSession)
    rows = collected(map_arrow(sample.select(F.col("__id").alias("doc_id"), "quality", "text", "n_chars"),
                     _sparse, "doc_id long, quality int, idx binary, val binary") \
        .dropDuplicates(["doc_id"]).orderBy("doc_id"))
    return train([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
                  for i, v in zip(rows["idx"], rows["val"], strict=True)], rows["quality"].astype(float))


def _n_chars(docs: DataFrame):
    """The table's own length column as metadata, if it has one."""
    return (F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")).alias("n_chars")


def _score(batches, model):
    m = model.value
    for b in slices(batches, "__text", SLICE):
        found = features(b.column("__text").to_pylist(), b.column("__n_chars").to_pylist())
        p = 1 / (1 + np.exp(-np.clip(raw_scores(m, *found).astype(float), -30, 30)))
        names = [x for x in b.schema.names if x not in ("__text", "__n_chars")]
        yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(p)],
                                         names=[*names, "__score"])


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with __score, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*keep, F.col("text").alias("__text"), _n_chars(docs).alias("__n_chars"))
    kinds = docs.select(*keep).schema.simpleString()[len("struct<"):-1]
    return map_arrow(read, partial(_score, model=shared), f"{kinds}, __score double")


def classify(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``.

    Only the text and its length column enter a score.  Null texts count as
    empty and are scored like any other; repeated rows are scored alike; without
    labels every score is 0.5; no rows give no rows; further columns are left
    out.
    """
    ours = docs.withColumn("held_out", fold() == 0)
    return (score(ours, fit(docs, labels, train_docs), ["doc_id", "held_out"])
            .select("doc_id", "held_out", F.col("__score").alias("score"),
                    (F.col("__score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS,
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted as label 1."""
    return (score(docs, fit(docs, labels, train_docs), docs.columns)
            .filter(F.col("__score") >= threshold).select(*docs.columns))
