import math
import zlib
from collections import Counter

import numpy as np

from wardwatch.llm import langid, quality
from wardwatch.llm.common import table


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- language ID -----------------------------------------------------------------


def grams(text, buckets):
    """Buckets of all n-grams, one by one."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    x = [ord(c) + 1 for w in letters.split() for c in w + " "]
    out = []
    for n in langid.ORDERS:
        for i in range(len(x) - n + 1):
            if n == 1 and x[i] == 33:
                continue
            h = 0
            for v in x[i: i + n]:
                h = (h * 0x100000001B3 + v) % 2 ** 64
            out.append(int(langid.mix(np.array([h + n], np.uint64))[0]) % buckets)
    return sorted(out)


_BUCKET = {}


def grams_of(text, buckets):
    """As ``grams``, each distinct n-gram hashed once."""
    x = [ord(c) + 1 for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split() for c in w + " "]
    out = []
    for n in langid.ORDERS:
        for i in range(len(x) - n + 1):
            own = tuple(x[i: i + n])
            if own == (33,):
                continue
            if own not in _BUCKET:
                h = 0
                for v in own:
                    h = (h * 0x100000001B3 + v) % 2 ** 64
                _BUCKET[own] = int(langid.mix(np.array([h + n], np.uint64))[0]) % buckets
            out.append(_BUCKET[own])
    return out


def test_grams_as_one_by_one():
    texts = ["The cat.", "", "été  à 12 b", "x", "  lead", "9", "a b"]
    found, seen, _ = langid._grams([t.lower() + " " for t in texts], 1 << 15)
    for i, t in enumerate(texts):
        got = sorted(int(b) for bucket, at in found for b in bucket[at[i]: at[i + 1]])
        want = grams(t, 1 << 15)
        if any(c.isalpha() for c in t):
            assert got == want, t
        assert seen[i] == any(c.isalpha() for c in t)


def test_held_out_accuracy(spark, small):
    docs = table(spark, small, "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_texts(awkward, clashing, empty):
    rows = langid.identify(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (100, 101, 102, 103):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[105]["lang_pred"] == "en"
    assert sum(by_id[i]["lang_pred"] == ["en", "de", "fr", "es"][i % 4] for i in range(80)) >= 78
    assert langid.identify(clashing).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert langid.identify(empty).count() == 0
    kept = {r["doc_id"] for r in langid.keep_identified(clashing).collect()}
    assert not kept & {100, 101, 102, 103} and kept >= set(range(80))
    assert langid.keep_identified(clashing).columns == clashing.columns


def test_long_texts_in_parts_score_alike(monkeypatch, awkward):
    model = langid.fit(awkward.filter("lang is not null"))
    texts = ["der hund und die katze " * 50, None, "the dog", "1"]
    whole = langid.classify(texts, model)
    monkeypatch.setattr(langid, "LONG", 97)
    parts = langid.classify(texts, model)
    assert whole[0] == parts[0] == ["de", "und", "en", "und"]


def test_a_cut_changes_no_gram(monkeypatch):
    """Parts of any size hold the n-grams of the whole text, those at a cut too."""
    text = "Der  Hund -- 123 und\u0130 die ΣΑΣ Katze, " * 3 + "9" * 40 + "ende"
    want = grams(text, 1 << 15)
    for size in (1, 2, 3, 7, 50, 1000):
        monkeypatch.setattr(langid, "LONG", size)
        got, last = [], langid.NOTHING
        for parts, _, begins in langid._parts([text]):
            found, _, last = langid._grams(parts, 1 << 15, langid.NOTHING if begins else last)
            got += [int(b) for bucket, _ in found for b in bucket]
        assert sorted(got) == want, size


def test_posterior_as_one_by_one(spark, small):
    """Counts, priors, likelihoods and predictions of a whole table, in plain Python."""
    docs = table(spark, small, "documents")
    rows = docs.select("doc_id", "text", "lang").collect()
    model = langid.fit(docs, train_docs=10 ** 9)
    size = model.log_prob.shape[0]
    count = {lang: Counter() for lang in model.langs}
    for r in rows:
        weight = min(1.0, langid.FULL_WEIGHT / max(1, len(r["text"] or "")))
        for b in grams_of(r["text"], size):
            count[r["lang"]][b] += weight
    total = {lang: sum(c.values()) + 0.5 * size for lang, c in count.items()}
    prior = Counter(r["lang"] for r in rows)
    found = langid.classify([r["text"] for r in rows], model)
    for r, lang, score in zip(rows[::7], found[0][::7], found[1][::7], strict=True):
        like = [math.log(prior[x] / len(rows))
                + sum(math.log((count[x][b] + 0.5) / total[x]) for b in grams_of(r["text"], size)) for x in model.langs]
        assert lang == model.langs[int(np.argmax(like))]
        assert abs(score - 1 / sum(math.exp(x - max(like)) for x in like)) < 1e-6


def test_nothing_learned(spark, awkward):
    from pyspark.sql import functions as F
    rows = langid.identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}


def test_training_sample_is_bounded(spark, small):
    docs = table(spark, small, "documents")
    model = langid.fit(docs, train_docs=200)
    assert model.langs == ["de", "en", "es", "fr"]
    assert langid.classify(["der und die das ist nicht"], model)[0] == ["de"]


# --- quality -----------------------------------------------------------------------


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Model(0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 4)))
    for n in (0, 1, 2, 9):
        i = rng.choice(quality.FEATURES, n, replace=False)
        x = rng.normal(size=n)
        pairs = sum(m.factor[i[a]] @ m.factor[i[b]] * x[a] * x[b] for a in range(n) for b in range(a))
        want = m.bias + m.weight[i] @ x + pairs
        assert np.isclose(quality.raw_scores(m, i, x, np.array([0, n]))[0], want)


def plain_score(m, text, n_chars):
    """The whole score of a text: bias, weights and every pair, one by one."""
    index, value, at = quality.features([text], [n_chars])
    own = {}
    for i, v in zip(index[at[0]: at[1]], value[at[0]: at[1]], strict=True):
        own[int(i)] = own.get(int(i), 0.0) + float(v)
    items = sorted(own.items())
    z = m.bias + sum(m.weight[i] * v for i, v in items)
    for k, (i, v) in enumerate(items):
        for j, w in items[:k]:
            z += sum(float(a) * float(b) for a, b in zip(m.factor[i], m.factor[j], strict=True)) * v * w
    return 1 / (1 + math.exp(-z))


def test_whole_score_as_one_by_one():
    rng = np.random.default_rng(2)
    m = quality.Model(0.1, rng.normal(0, 0.1, quality.FEATURES), rng.normal(0, 0.1, (quality.FEATURES, quality.RANK)))
    texts, given = ["The cat & the dog!\nTHE END", "", None, "x " * 90, "a" * 30 + " 12 %%"], [26, None, 0, 180, 7]
    got = 1 / (1 + np.exp(-quality.raw_scores(m, *quality.features(texts, given))))
    assert np.allclose(got, [plain_score(m, t, n) for t, n in zip(texts, given, strict=True)], atol=1e-6)


def test_gradient_lowers_the_loss():
    rows = [(np.array([0 if k % 2 else 1, 5]), np.array([1.0, 1.0], np.float32)) for k in range(200)]
    label = np.array([float(k % 2) for k in range(200)])
    m = quality.train(rows, label, epochs=10)
    p = [quality.raw_scores(m, i, v, np.array([0, 2]))[0] for i, v in rows[:2]]
    assert p[1] > 0 > p[0]


def test_word_features_by_hand():
    index, value, at = quality.features(["The the cat&&&", None], [None, 3])
    words = index[at[0]: at[1]] < quality.WORDS
    assert np.allclose(sorted(value[at[0]: at[1]][words] ** 2), [1 / 3, 2 / 3])
    assert (index[at[1]: at[2]] >= quality.WORDS).all()
    assert at[2] - at[1] == len(quality.SHARE_STATS) + len(quality.LENGTH_STATS)


def test_long_texts_in_parts_give_equal_features(monkeypatch):
    texts = ["word, other! " * 40, "x", None]
    whole = quality.features(texts, [1, 2, 3])
    monkeypatch.setattr(quality, "LONG", 50)
    parts = quality.features(texts, [1, 2, 3])
    a, b = (sorted(zip(f[0][: f[2][1]], np.round(f[1][: f[2][1]], 4), strict=True)) for f in (whole, parts))
    assert a == b


def test_held_out_quality(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.classify(docs, labels).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.93 * len(held)
    good, bad = ([r["score"] for r in held if truth[r["doc_id"]] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_awkward_quality(spark, awkward, clashing, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(3, 0, 0), (None, 1, 0), (4, None, 0), (9, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep_good(clashing, labels).columns == clashing.columns
    assert quality.classify(empty, labels).count() == 0
    none = quality.classify(awkward, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.classify(awkward.drop("n_chars"), labels).count() == awkward.count()
