import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wardwatch.llm import packing, tokens
from wardwatch.llm.common import table
from wardwatch.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text, tokenizer=Tokenizer.from_file(PATH)):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_as_the_library_gives_them():
    rng = random.Random(4)
    texts = ["", " ", "it's 'tis we'll x'rex '", "\n\nfoo\n bar \n", "<|endoftext|> a <|endoftext|>", "١٢ ½ Ⅷ　全角​ z",
             "a   b\t\tc  ", "!'s ''s 's't", "'", "y" * 3000]
    texts += ["".join(rng.choice("ab 's\n\t1!é'lredmv　") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    found, at = Encoder.of(PATH).encode(texts)
    for i, t in enumerate(texts):
        assert found[at[i]: at[i + 1]].tolist() == ids_of(t), t


def test_very_long_texts_by_parts(monkeypatch):
    monkeypatch.setattr(tokens, "PART", 150)
    encoder, rng = Encoder.of(PATH), random.Random(8)
    for letters in ("ab 's\n\t1!é'lredmv　", "日本語，。", "aB9+/xQ", "y", "it's we'll 12, ", ["<|endoftext|>", " a", "|>", "b1"]):
        for n in (149, 150, 151, 1500, 3000):
            text = "".join(rng.choice(letters) for _ in range(n))
            found = list(encoder.parts(text))
            assert np.concatenate(found).tolist() == ids_of(text), text
            assert letters in ("y",) or len(text) < 1500 or len(found) > 1
            cut = packing._long_pieces(iter(found), 64)
            assert np.concatenate(cut).tolist() == ids_of(text) and {len(c) for c in cut[:-1]} <= {64}


def test_long_and_short_texts_in_one_batch(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tokens, "PART", 500)
    texts = ["a b c", None, "word and 12 " * 900, "", "short"]
    rows = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = [r for b in packing._pieces([rows], PATH, 64, True) for r in b.to_pylist()]
    for i, t in enumerate(texts):
        own = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in own for x in r["ids"]] == ids_of(t) and {r["doc_tokens"] for r in own} == {len(ids_of(t))}
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])


def test_forgetting_changes_nothing(monkeypatch):
    from wardwatch.llm import spans
    monkeypatch.setattr(spans, "KEPT", 10)
    encoder = Encoder(PATH)
    for text in ("one two three", "four five six seven eight", "one nine ten", " ".join(map(str, range(50)))):
        found, at = encoder.encode([text, "two"])
        assert found[: at[1]].tolist() == ids_of(text)


def first_fit(sizes, room):
    """The plain quadratic form."""
    free, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if b == len(free):
            free.append(room)
        out[i] = (b, room - free[b])
        free[b] -= sizes[i]
    return [out[i] for i in range(len(sizes))]


def test_tournament_tree_is_first_fit_decreasing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 50, 257):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == first_fit(sizes.tolist(), 100)


def check(docs, rows, length):
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = ids_of(r["text"])
        for s in range(0, len(ids), length):
            part = ids[s: s + length]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            want[(r["doc_id"], s, len(part), crc, len(ids))] += 1
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sequences


def test_whole_table_with_little_padding(spark, small):
    docs = table(spark, small, "documents")
    rows = packing.pack(docs).collect()
    sequences = check(docs, rows, 1024)
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) * 1024 < 1.01 * tokens + 1024


def test_awkward_rows_in_small_groups(awkward, clashing, empty):
    check(awkward, packing.pack(awkward, length=64, group=20).collect(), 64)
    assert packing.pack(clashing).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert packing.pack(empty).count() == 0


def test_sequences_hold_the_ids(awkward):
    found = packing.sequences(awkward, length=128).collect()
    assert all(0 < len(r["ids"]) <= 128 for r in found)
    want = Counter(i for r in awkward.collect() for i in ids_of(r["text"]))
    assert Counter(i for r in found for i in r["ids"]) == want
