import math
import zlib
from collections import Counter

import numpy as np
import pytest

from wardwatch.llm import lm
from wardwatch.llm.common import table


UNITS, GROUPS = 1024, 63


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def expected(docs):
    """Base score and counts by the definition; a row's key is its place."""
    rows = [(r["doc_id"], tokens(r["text"])) for r in docs.select("doc_id", "text").collect()]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    count = Counter(t for (_, ts), h in zip(rows, held, strict=True) if not h for t in ts)
    n, v = sum(count.values()), len(count)
    whole = n + 0.5 * (v + 1)
    return sorted((d is None, d or 0, h, len(ts), sum(count[t] > 0 for t in ts), n,
                   round(sum(math.log10((count[t] + 0.5) / whole) for t in ts), 3))
                  for (d, ts), h in zip(rows, held, strict=True))


def found(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 3)) for r in rows)


def close(a, b):
    return len(a) == len(b) and all(x[:-1] == y[:-1] and abs(x[-1] - y[-1]) < 0.01 for x, y in zip(a, b, strict=True))


def test_base_and_gain_over_it(spark, small):
    docs = table(spark, small, "documents")
    rows = lm.score(docs).collect()
    assert close(found(rows), expected(docs))
    for held in (False, True):
        own = [r for r in rows if r["held_out"] == held]
        assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)


@pytest.mark.parametrize("known", [1_000_000, 5])
def test_awkward_rows_near_and_far_words(awkward, monkeypatch, known):
    """With few known words most counts come by the join; scores stay the same."""
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = lm.score(awkward, share=1).collect()
    assert close(found(rows), expected(awkward))
    assert all(r["score"] < 0 for r in rows)
    again = {}
    for r in rows:
        assert abs(again.setdefault((r["doc_id"], r["n_tokens"]), r["score"]) - r["score"]) < 1e-4


@pytest.mark.parametrize(("rounds", "share"), [(None, None), (1, 3)])
def test_rounds_train_on_every_document(awkward, monkeypatch, rounds, share):
    monkeypatch.setattr(lm, "SHARD", 10_000)                    # as a large corpus
    read, parts, as_it_was = [], [], lm.map_arrow

    def noted(df, fn, schema):
        if getattr(fn, "func", None) is lm._train:
            read.extend(bytes(r["text"]) for r in df.collect())
            parts.append(df.rdd.getNumPartitions())
        return as_it_was(df, fn, schema)

    training = awkward.filter("doc_id is null or doc_id < 100")
    voc = lm.vocabulary(lm.count_words(training), training.count())
    monkeypatch.setattr(lm, "map_arrow", noted)
    lm.train(training, voc, rounds, share)
    assert sorted(read) == sorted((r["text"] or "").encode() for r in training.collect())
    size = sum(len(t) + 1 for t in read)
    assert len(parts) == (share or lm.rounds_of(size)) and size / 10_000 <= sum(parts) < size / 10_000 + len(parts)


def test_model_and_rounds_grow_with_the_tokens():
    sizes = [lm.classes_of(10 ** k) for k in range(14)]
    assert sizes == sorted(sizes) and sizes[0] == lm.LEAST and sizes[-1] == lm.MOST and len(set(sizes)) > 4
    assert [lm.rounds_of(lm.SHARD * n) for n in (0, 1, 4, 16, 4 ** 10)] == [2, 2, 3, 4, 12]


@pytest.mark.parametrize("known", [1_000_000, 3])
def test_score_word_by_word(awkward, monkeypatch, known):
    """The score of every text by the model's definition, a word at a time: the soft-max
    of the class, that of the unit in it, and a shared unit's division by counts."""
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in awkward.select("doc_id", "text").collect()]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    kept = {}
    made = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda counts, texts: kept.setdefault("voc", made(counts, texts)))

    def fixed(training, voc, rounds, share):
        model, rng = lm.start(voc.share), np.random.default_rng(5)
        for a in model.arrays():
            a += rng.normal(0, 0.3, a.shape).astype(np.float32)
        return kept.setdefault("model", model)

    monkeypatch.setattr(lm, "train", fixed)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], round(r["score"], 6)) for r in lm.score(awkward).collect())
    voc, m = kept["voc"], kept["model"]
    count = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in t.lower().split())
    hashes = {w: int(lm.words([w])[0][0]) for _, t in rows for w in t.lower().split()}
    own = {int(k): int(u) for k, u in zip(voc.key, voc.unit, strict=True)}
    shared = {int(u): g for g, u in enumerate(voc.ending_unit)}
    c = m.classes

    def unit_of(w):
        g = int(lm._group(np.array([w[-1] * 256 + (w[-2] if len(w) > 1 else 0)]), len(voc.ending_unit))[0])
        return own.get(hashes[w], int(voc.ending_unit[g])), g

    seen = {}

    def log_p(u, context):
        if (u, context) not in seen:
            q = sum(m.context[x].astype(float) * m.weight[j] for j, x in enumerate(context))
            a = m.group.astype(float) @ q + m.group_bias
            k = u // c
            b = m.unit[k * c: k * c + c].astype(float) @ q + m.unit_bias[k * c: k * c + c]
            seen[u, context] = (a[k] - math.log(sum(math.exp(x) for x in a)) + b[u % c] - math.log(sum(math.exp(x) for x in b)))
        return seen[u, context]

    want = []
    for d, t in rows:
        words, total, context = t.lower().split(), 0.0, (voc.end_unit,) * lm.CONTEXT
        for w in words:
            u, g = unit_of(w)
            total += log_p(u, context) / math.log(10)
            if u in shared:
                total += math.log10((count[w] + 0.5) / (voc.rest_count[g] + 0.5 * (voc.rest_words[g] + 1)))
            context = (u, *context[:-1])
        total += log_p(voc.end_unit, context) / math.log(10)
        want.append((d is None, d or 0, len(words) + 1, total))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-5 * max(1, abs(b[3])) + 1e-3, (a, b)


def test_clashing_columns_no_rows_and_no_training(clashing, empty, spark):
    assert lm.score(clashing).columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert lm.score(empty).count() == 0
    only = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = lm.score(spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}


def small_vocabulary():
    texts = [b"the cat the dog", b"a cat", b"the the bird sings"] * 30
    key, ending, _ = lm.words(texts)
    own, first, n = np.unique(key, return_index=True, return_counts=True)
    share = np.random.default_rng(0).random(UNITS)
    return lm.Vocabulary(len(key) + 90, len(own) + 1, 90, own, n, np.arange(1, len(own) + 1, dtype=np.int32), 0,
                         np.arange(UNITS - GROUPS, UNITS), np.zeros(GROUPS), np.zeros(GROUPS),
                         share / share.sum()), texts


def test_probabilities_are_normalised():
    voc, _ = small_vocabulary()
    model = lm.start(voc.share)
    rng = np.random.default_rng(1)
    for a in model.arrays():
        a += rng.normal(0, 0.5, a.shape).astype(np.float32)
    for _ in range(3):
        context = np.tile(rng.integers(0, UNITS, lm.CONTEXT), (UNITS, 1))
        assert abs(np.exp(lm.log_probabilities(model, np.arange(UNITS), context)).sum() - 1) < 1e-4


def test_start_predicts_shares():
    voc, _ = small_vocabulary()
    zero = lm.start(voc.share)
    zero.context[:] = 0
    got = lm.log_probabilities(zero, np.arange(UNITS), np.zeros((UNITS, lm.CONTEXT), np.int64))
    assert np.allclose(np.exp(got), voc.share, rtol=1e-3)


def test_training_learns_what_follows():
    voc, texts = small_vocabulary()
    units, context, _ = lm._units(voc, texts, np.zeros(lm.CONTEXT, np.int64), True)[:3]
    trainer = lm.Trainer(lm.start(voc.share), voc.share, 1)
    before = lm.log_probabilities(trainer.m, units, context).mean()
    for _ in range(60):
        trainer.step(units, context)
    after = lm.log_probabilities(trainer.m, units, context).mean()
    assert after > before + 1 and trainer.tokens == 60 * len(units)


def test_contrast_gradient_by_differences():
    """Loss of a batch: -log s(pos) - sum over noise of log(1 - s(neg))."""
    rng = np.random.default_rng(3)
    q, vec, bias = rng.normal(size=(5, 4)), rng.normal(size=(6, 4)), rng.normal(size=6)
    share, true, noise = rng.normal(size=6), np.array([0, 1, 1, 5, 2]), np.array([3, 3, 0])

    def loss(vec, bias, q):
        s = lambda x: 1 / (1 + np.exp(-x))
        return -(np.log(s((q * vec[true]).sum(1) + bias[true] - share[true])).sum()
                 + np.log(1 - s(q @ vec[noise].T + bias[noise] - share[noise])).sum())

    to_q, rows, values, ones = lm.Trainer._contrast(q, true, noise, vec, bias, share)
    g_vec, g_bias = lm._scatter(rows, values, 6), np.bincount(rows, ones, 6)
    for array, grad, f in ((vec, g_vec, lambda a: loss(a, bias, q)), (bias, g_bias, lambda a: loss(vec, a, q)),
                           (q, to_q, lambda a: loss(vec, bias, a))):
        for i in np.ndindex(array.shape):
            d = np.zeros(array.shape)
            d[i] = 1e-5
            assert abs((f(array + d) - f(array - d)) / 2e-5 - grad[i]) < 1e-5


def test_words_and_contexts():
    key, _, at = lm.words([b"The\x0bcat  the", b"", b" x\xc2\xa0y "])
    assert at.tolist() == [0, 3, 3, 4] and key[0] == key[2] != key[1]
    flat, context, where = lm._sequence(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]), 0, np.zeros(3, np.int64), True)
    assert flat.tolist() == [5, 6, 7, 0, 0, 8, 0] and where.tolist() == [0, 4, 5, 7]
    assert context.tolist() == [[0, 0, 0], [5, 0, 0], [6, 5, 0], [7, 6, 5], [0, 0, 0], [0, 0, 0], [8, 0, 0]]


def test_long_texts_in_parts_keep_their_contexts(monkeypatch):
    voc, _ = small_vocabulary()
    text = b"the cat the dog a bird sings the " * 40
    whole = lm._units(voc, [text], np.zeros(lm.CONTEXT, np.int64), True)[:2]
    monkeypatch.setattr(lm, "SLICE", 50)
    before, units, contexts = np.zeros(lm.CONTEXT, np.int64), [], []
    parts = list(lm._parts([text]))
    assert len(parts) > 10 and b"".join(p[0][0] for p in parts) == text
    for texts, _, _, closes in parts:
        u, c, _ = lm._units(voc, texts, before, closes)[:3]
        before = lm._carry(before, u)
        units.append(u)
        contexts.append(c)
    assert (np.concatenate(units) == whole[0]).all() and (np.concatenate(contexts) == whole[1]).all()
