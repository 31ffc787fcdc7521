"""Packing documents into sequences: first-fit decreasing with a tournament tree.

Documents are tokenised where they are read and cut into full sequences and a
rest, a very long one part by part; only the pieces' numbers travel on.  Rests are dealt at random into groups
of about ``GROUP`` pieces; each group packs its own, longest first, always into
the first bin that has room.  A tournament tree over the bins' free room finds
that bin in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tokenizing
from .common import cut, group_pandas, map_arrow, slices
from .tokens import Encoder

LENGTH = 1024
GROUP = 4096                   # pieces that one group packs, on average
VOCABULARY = "byte_bpe_50k.json"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    return public_tokenizers.path(VOCABULARY)


def _batch(doc_id: pa.Array, start: np.ndarray, ids: list[np.ndarray], tokens: np.ndarray,
           with_ids: bool) -> pa.RecordBatch:
    arrays = [doc_id, pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
              pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(tokens, pa.int64())]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    if with_ids:
        arrays.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _long_pieces(parts: Iterator[np.ndarray], length: int) -> list[np.ndarray]:
    """The pieces of one text whose ids come part by part."""
    out, rest = [], np.zeros(0, "<u4")
    for ids in parts:
        rest = np.concatenate([rest, ids.astype("<u4")])
        full = len(rest) // length * length
        out += [rest[s: s + length] for s in range(0, full, length)]
        rest = rest[full:]
    return out + [rest] * (len(rest) > 0)


def _pieces(batches, path: str, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path)
    for b in slices(batches, "text"):
        texts = [t or "" for t in b.column("text").to_pylist()]
        doc_id, short = b.column("doc_id"), [i for i, t in enumerate(texts) if len(t) <= tokenizing.PART]
        for i in sorted(set(range(len(texts))) - set(short)):
            found = _long_pieces(encoder.parts(texts[i]), length)
            n = sum(map(len, found))
            yield _batch(doc_id.take(pa.array([i] * len(found))), np.arange(len(found)) * length, found,
                         np.full(len(found), n), with_ids)
        if not short:
            continue
        ids, at = encoder.encode([texts[i] for i in short])
        ids, tokens = ids.astype("<u4"), np.diff(at)
        count = -(-tokens // length)
        row = np.repeat(np.arange(len(short)), count)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * length
        lo = at[row] + start
        hi = lo + np.minimum(length, tokens[row] - start)
        yield _batch(doc_id.take(pa.array(np.array(short)[row])), start,
                     [ids[s:e] for s, e in zip(lo.tolist(), hi.tolist(), strict=True)], tokens[row], with_ids)


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Each document's ids, ended by id 0, cut at multiples of ``length``: doc_id,
    start, length, ids_crc32, doc_tokens and, if asked for, ids."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(read, partial(_pieces, path=tokenizer or default_tokenizer(), length=length,
                                   with_ids=with_ids), PIECES + ", ids array<int>" * with_ids)


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (1 to ``room``): longest first, equal sizes in
    order, each into the first bin with room.  Node k of the tree holds the most
    free room below it; its children are 2k and 2k + 1."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    tree = [room] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, k = int(sizes[i]), 1
        while k < leaves:
            k *= 2
            if tree[k] < size:
                k += 1
        bins[i], offsets[i] = k - leaves, room - tree[k]
        tree[k] -= size
        while k > 1:
            k //= 2
            tree[k] = max(tree[2 * k], tree[2 * k + 1])
    return bins, offsets


def _pack_group(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
    bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), length)
    rows["sequence_id"] = (rows["part"].to_numpy() << 32 | bins) << 1
    return rows.drop(columns=["part"]).assign(offset=offsets)


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None,
         group: int = GROUP) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a
    piece; a sequence's pieces fill it from 0 without gaps, to at most ``length``.

    Null texts count as empty: a single id 0.  Repeated rows, also those without
    doc_id, are packed each on its own.  Full pieces are sequences themselves.
    Further columns are left out; no rows: no rows.
    """
    cutting = pieces(docs, length, tokenizer).withColumn("draw", F.rand(7))
    found = cut(cutting)
    full = (found.filter(F.col("length") == length).drop("draw")
            .withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1)
            .withColumn("offset", F.lit(0).cast("long")))
    rests = found.filter(F.col("length") < length)
    parts = max(1, rests.count() // group)
    dealt = rests.withColumn("part", F.floor(F.col("draw") * parts).cast("long")).drop("draw")
    packed = group_pandas(dealt, ["part"], partial(_pack_group, length=length),
                          PIECES + ", sequence_id long, offset long")
    return packed.unionByName(full)


def sequences(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None,
              group: int = GROUP) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (unpadded)."""
    placed = pack(docs, length, tokenizer, group)
    where = ["doc_id", "start", "length", "ids_crc32"]
    texts = pieces(docs, length, tokenizer, with_ids=True).select(*where, "ids").dropDuplicates(where)
    same = [placed[c].eqNullSafe(texts[c]) for c in where]
    return (placed.join(texts, same).select("sequence_id", "offset", "ids")
            .groupBy("sequence_id").agg(F.flatten(F.transform(
                F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")))
