"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is fitted on a bounded sample of labelled documents; its matrix of
log-probabilities (buckets by languages) goes to every task, which scores
whole texts in numpy: the n-grams of many texts are hashed at once, their rows
of the matrix gathered and summed by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, fold, map_arrow, slices, sum_rows
from .textops import class_table, codepoints, mix

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_DOCS = 20_000            # documents that the model is fitted on, at most about
TRAIN_PARTS = 32
FULL_WEIGHT = 4_000            # characters up to which a training text counts in full
UNKNOWN = "und"
MIN_SCORE = 0.5
SLICE = 1 << 18
LONG = 1 << 20                 # characters of a text that are worked on at once
BLANK = np.uint64(33)          # symbol of all that is no letter; a letter is its code point plus 1
NOTHING = np.zeros(0, np.uint64)


@dataclass
class Model:
    langs: list[str]
    log_prior: np.ndarray      # languages
    log_prob: np.ndarray       # buckets by languages


def _letters() -> np.ndarray:
    return class_table("letter", str.isalpha)


def _parts(texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray, bool]]:
    """(texts in lower case, rows, begins): those of at most LONG characters
    together; a longer one in parts, one after another.  A blank ends every text."""
    lower = [(t or "").lower() + " " for t in texts]
    short = [i for i, t in enumerate(lower) if len(t) <= LONG]
    if short:
        yield [lower[i] for i in short], np.array(short), True
    for i, t in enumerate(lower):
        if len(t) > LONG:
            for lo in range(0, len(t), LONG):
                yield [t[lo: lo + LONG]], np.array([i]), lo == 0


def _grams(texts: list[str], buckets: int, before: np.ndarray = NOTHING
           ) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """For each order the buckets of all n-grams and their offsets by text,
    whether each text has a letter, and the last symbols.  What is no letter counts
    as one blank; n-grams of blanks only are left out.  ``before`` are the last
    symbols of the part before (of one text): n-grams that begin there and end here
    count here."""
    cp, ends = codepoints(texts)
    letter = _letters()[cp]
    doc = np.repeat(np.arange(len(texts)), np.diff(ends))
    follows = len(before) > 0 and before[-1] != BLANK
    keep = letter | np.concatenate([[follows], letter])[: len(letter)]
    x = np.concatenate([before, np.where(letter, cp, 32).astype(np.uint64)[keep] + np.uint64(1)])
    doc = np.concatenate([np.zeros(len(before), np.int64), doc[keep]])
    letter = x != BLANK
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    h = np.zeros(len(x), np.uint64)
    inside = np.ones(len(x), bool)
    for n in range(1, max(ORDERS) + 1):
        m = len(x) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + x[n - 1:]
        inside = inside[:m] & (doc[n - 1:] == doc[:m])
        if n in ORDERS:
            ok = inside & letter[:m] if n == 1 else inside.copy()
            ok[: max(0, len(before) - n + 1)] = False
            at = np.flatnonzero(ok)
            bucket = (mix(h[at] + np.uint64(n)) % np.uint64(buckets)).astype(np.int32)
            out.append((bucket, np.searchsorted(at, starts)))
    seen = sum_rows(letter.astype(np.int64), starts) > 0
    return out, seen, x[len(x) - min(len(x), max(ORDERS) - 1):]


def _counts(batches, langs: list[str], buckets: int):
    total = np.zeros((len(langs), buckets))
    row = {lang: i for i, lang in enumerate(langs)}
    for b in slices(batches, "text", SLICE):
        texts = b.column("text").to_pylist()
        lang = np.array([row[x] for x in b.column("lang").to_pylist()])
        weight = np.array([min(1.0, FULL_WEIGHT / max(1, len(t))) for t in texts])
        last = NOTHING
        for parts, rows, begins in _parts(texts):
            grams, _, last = _grams(parts, buckets, NOTHING if begins else last)
            for bucket, at in grams:
                which = np.repeat(lang[rows], np.diff(at)).astype(np.int64)
                total += np.bincount(which * buckets + bucket, np.repeat(weight[rows], np.diff(at)),
                                     total.size).reshape(total.shape)
    lang, bucket = np.nonzero(total)
    if len(lang):
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)),
             pa.array(total[lang, bucket])], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, buckets: int = BUCKETS) -> Model:
    """Fit on the rows of ``docs`` (text, lang) whose text and lang are not null:
    all of them up to ``train_docs``, else a hash sample of about that many.  Texts
    of over FULL_WEIGHT characters weigh as much as one of that length, so that no
    single text stands for its language."""
    usable = docs.filter("text is not null and lang is not null")
    share = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20))
    by_lang = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    langs, sizes = [r["lang"] for r in by_lang], np.array([r["n"] for r in by_lang], np.float64)
    if not langs:
        return Model([], np.zeros(0), np.zeros((buckets, 0)))
    sample = usable if sizes.sum() <= train_docs else usable.filter(
        share < int(train_docs / sizes.sum() * (1 << 20)) + 1)
    rows = (map_arrow(sample.select("text", "lang").repartition(TRAIN_PARTS),
                      partial(_counts, langs=langs, buckets=buckets), "lang int, bucket int, n double")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    rows = collected(rows)
    counts = np.zeros((buckets, len(langs)))
    counts[rows["bucket"], rows["lang"]] = rows["n"]
    counts += 0.5
    return Model(langs, np.log(sizes / sizes.sum()),
                 np.log(counts / counts.sum(axis=0)))


def classify(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Predicted languages and their posterior probabilities; a text that is null
    or has no letter gets ``und`` and 0, and so do all when nothing was learned."""
    n = len(texts)
    if not model.langs:
        return [UNKNOWN] * n, np.zeros(n)
    like, seen = np.tile(model.log_prior, (n, 1)), np.zeros(n, bool)
    last = NOTHING
    for parts, rows, begins in _parts(texts):
        grams, letters, last = _grams(parts, model.log_prob.shape[0], NOTHING if begins else last)
        for bucket, at in grams:
            like[rows] += sum_rows(model.log_prob[bucket], at)
        seen[rows] |= letters
    best = like.argmax(axis=1)
    score = 1 / np.exp(like - like.max(axis=1, keepdims=True)).sum(axis=1)
    return ([model.langs[k] if ok else UNKNOWN for k, ok in zip(best, seen, strict=True)],
            np.where(seen, score, 0.0))


def _score(batches, model):
    for b in slices(batches, "__text", SLICE):
        langs, score = classify(b.column("__text").to_pylist(), model.value)
        kept = [c for i, c in enumerate(b.columns) if b.schema.names[i] != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(langs, pa.string()), pa.array(score)],
            names=[*(x for x in b.schema.names if x != "__text"), "__lang", "__score"])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with __lang and __score for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*keep, F.col("text").alias("__text"))
    kinds = docs.select(*keep).schema.simpleString()[len("struct<"):-1]
    return map_arrow(read, partial(_score, model=shared),
                     ", ".join(x for x in (kinds, "__lang string, __score double") if x))


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``.

    Learned from text and lang of the rows outside the held-out fold (crc32 of
    the doc_id as text, modulo 5, is 0); only the text enters a prediction.  Null
    texts and texts without a letter get ``und`` with score 0.  Repeated rows
    are predicted alike, ties between languages go to the alphabetically first,
    no rows give no rows, and further columns are left out.
    """
    ours = docs.select("doc_id", "text", "lang", (fold() == 0).alias("held_out"))
    model = fit(ours.filter("not held_out"), train_docs)
    return (predict(ours, model, ["doc_id", "held_out"])
            .select("doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score")))


def keep_identified(docs: DataFrame, train_docs: int = TRAIN_DOCS,
                    min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a known language: not
    ``und`` and predicted with at least ``min_score``."""
    ours = docs.withColumn("__held_out", fold() == 0)
    model = fit(ours.filter("not __held_out").select("doc_id", "text", "lang"), train_docs)
    seen = predict(ours.drop("__held_out"), model, docs.columns)
    return (seen.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= min_score))
            .select(*docs.columns))
