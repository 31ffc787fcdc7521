"""SimHash near-duplicates: fingerprints, and links by deletion variants.

Fingerprints are counted in numpy over Arrow slices; linking is DataFrame work
on the distinct fingerprints only, so exact copies and copies with equal
fingerprints meet once.

Two fingerprints within ``max_bits`` = 2 bits, cut into two halves, differ in at
least one half by at most one bit.  Each half is indexed under 32 variants with
one bit deleted; equal variants are candidates, confirmed by counting the
differing bits.  A variant shared by more than ``FULL`` fingerprints is not
paired off: its members go to a finer index (six of eight bytes equal), and
what crowds even that meets by two-bit deletions, where equality alone proves
the link and each group needs only edges to its smallest member.  Every step
emits a bounded number of rows a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, cut, map_arrow, slices, stored, text_bytes
from .components import components

SEED = 42
FULL = 32                      # members up to which a variant's pairs are compared


def _hashes(words: list[bytes], shingle: int) -> list[int]:
    """XXH64 of every run of ``shingle`` words; of all words if there are fewer."""
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED)
            for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)]


def _windows(data: bytes, shingle: int, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Words of a long text in runs of about ``size`` bytes; each run begins with
    the last ``shingle - 1`` words of the one before, so no shingle is lost."""
    kept: list[bytes] = []
    rest = b""
    for lo in range(0, len(data), size):
        part = rest + data[lo: lo + size]
        words = part.split()
        open_end = lo + size < len(data) and words and not part[-1:].isspace()
        rest = words.pop() if open_end else b""
        words = kept + words
        if len(words) >= shingle:
            yield words
            kept = words[len(words) - shingle + 1:]
        else:
            kept = words
    last = kept + ([rest] if rest else [])
    if rest and len(last) >= shingle or len(data.split(None, shingle - 1)) < shingle:
        yield last


def _bit_counts(hashes: list[int]) -> tuple[np.ndarray, int]:
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's lower-cased words (no words: 0)."""
    counts, n = np.zeros(64, np.int64), 0
    data = text.lower()
    runs = [data.split()] if len(data) <= SLICE_BYTES else _windows(data, shingle)
    for words in runs:
        if found := _hashes(words, shingle):
            more, k = _bit_counts(found)
            counts, n = counts + more, n + k
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big") if n else 0


def _fingerprints(batches, shingle: int):
    for b in slices(batches, "text"):
        found = np.fromiter((fingerprint(t, shingle) for t in b.column("text").to_pylist()),
                            np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found.view(np.int64))],
                                         names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row a document, fp the fingerprint's bits as a bigint."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return map_arrow(read, partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


# Variants as (key, fp): one-bit deletions of either half; six equal bytes of
# eight; two-bit deletions of the whole.  Each kind's mark is part of the key.
_HALVES = """explode(transform(sequence(0, 63), b -> if(b < 32,
    ((fp & 4294967295L) & ~shiftleft(1L, b)), (shiftrightunsigned(fp, 32) & ~shiftleft(1L, b - 32)))
    | shiftleft(cast(b as bigint), 32)))"""


def _masked(masks: list[int]) -> str:
    """Mark in ``kind``, kept bits in ``key``."""
    signed = ", ".join(f"{m - (1 << 64) if m >> 63 else m}L" if m != 1 << 63
                       else "shiftleft(1L, 63)" for m in masks)
    return f"posexplode(transform(array({signed}), m -> fp & m))"


_BYTES = _masked([sum(0xFF << (8 * i) for i in range(8) if i not in gone)
                  for gone in combinations(range(8), 2)])
#: Deleting every choice of that many bits: equal keys are then links.
_DELETED = {
    1: "explode(transform(sequence(0, 63), i -> named_struct('kind', i, 'key', fp & ~shiftleft(1L, i))))",
    2: """explode(flatten(transform(sequence(1, 63), i -> transform(sequence(0, i - 1), j ->
        named_struct('kind', i * 64 + j, 'key', fp & ~(shiftleft(1L, i) | shiftleft(1L, j)))))))""",
}


#: Fingerprints with an equal half share all 32 variants of it: such a pair counts
#: in the first alone.  (``x``: the bits that differ.)
_ONCE = """(shiftrightunsigned(key, 32) % 32 = 0 or
    if(shiftrightunsigned(key, 32) < 32, x & 4294967295L, shiftrightunsigned(x, 32)) != 0)"""


def _edges_by(variants: DataFrame, keys: list[str], max_bits: int,
              once: str = "true") -> tuple[DataFrame, DataFrame]:
    """Links among fingerprints that share a variant, and the members of those
    variants that are too full to compare in pairs."""
    groups = cut(variants.groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                 .filter("n > 1"))
    close = f"bit_count(x) <= {max_bits} and {once}"
    two = groups.filter("n = 2").withColumn("x", F.expr("a ^ b")).filter(close).select("a", "b")
    # both sides are shuffled at every size: the groups grow with the fingerprints
    members = cut(variants.join(groups.filter("n > 2").select(*keys, "n").hint("merge"), keys))
    some = (members.filter(F.col("n") <= FULL).groupBy(*keys).agg(F.sort_array(F.collect_list("fp")).alias("fps"))
            .select(*keys, F.expr(f"""explode(flatten(transform(fps, (a, i) -> transform(filter(transform(
                slice(fps, i + 2, size(fps)), b -> a ^ b), x -> {close}), x -> struct(a, a ^ x as b)))))""")
                    .alias("pair")).select("pair.*"))
    crowded = members.filter(F.col("n") > FULL).select("fp").distinct()
    return two.union(some), crowded


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints ``fp`` within ``max_bits``
    (1 or 2) bits into their components; every edge is such a pair, though
    within a crowd only those to a common member are kept."""
    if max_bits not in _DELETED:
        raise ValueError("two halves with one deleted bit each cover 1 or 2 differing bits")
    # 64 variants each: spread the fingerprints first, over as many tasks as a shuffle has
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    near, crowd = _edges_by(fps.select("fp", F.expr(_HALVES).alias("key")), ["key"], max_bits, _ONCE)
    crowd = cut(crowd)
    if not crowd.isEmpty():
        more, dense = _edges_by(crowd.select("fp", F.expr(_BYTES).alias("kind", "key")),
                                ["kind", "key"], max_bits)
        stars = (dense.select("fp", F.expr(_DELETED[max_bits]).alias("v")).groupBy("v")
                 .agg(F.min("fp").alias("a"), F.collect_set("fp").alias("fps")))    # at most 4
        near = near.union(more).union(stars.select("a", F.explode("fps").alias("b")).filter("a != b"))
    return near.distinct()


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and of every fingerprint its component's name
    (smallest doc_id, or null) and the one fingerprint under that name that stands for it."""
    marked = cut(fingerprints(docs, shingle))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    joined = components(links(distinct.select("fp"), max_bits)) \
        .select(F.col("node").alias("fp"), "root")
    rooted = cut(distinct.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    first = F.min(F.struct(F.col("first_id").isNull().alias("nameless"), "first_id", "fp"))
    # dealt out anew, so that Spark can split a component that holds many fingerprints
    names = (rooted.groupBy("root").agg(first.alias("first"))
             .select("root", F.col("first.first_id").alias("component_id"), F.col("first.fp").alias("stays"))
             .repartition("root", "stays"))
    return marked, rooted.join(names, "root").select("fp", "component_id", "stays")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id joined to
    it by links, itself included) and fp (the bits), one row for each row of
    ``docs`` (any further columns are left out).

    Null and empty texts have fingerprint 0 and link like any other; repeated
    rows stay and link; rows without doc_id link too but never name a component
    (component_id is null where no member has an id); no rows: no rows.
    """
    marked, named = _grouped(docs, shingle, max_bits)
    return (marked.join(named.select("fp", "component_id"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "fp"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate component, all columns
    kept: a row of its smallest doc_id; without any id, a row of its smallest
    fingerprint.  Rows that share a doc_id are told apart by their fingerprints, so
    of two texts under one id each stays in its own component.

    Only ids travel where the dropped ones fit a broadcast; they are written, so
    that the planner knows their size.  Rows without an id of their own are few as a
    rule; their texts are marked once more.
    """
    marked, named = _grouped(docs, shingle, max_bits)
    stays = cut(named.filter("fp = stays").select(F.col("fp").alias("__fp"), F.col("component_id").alias("__of")))
    own = F.col("doc_id").cast("long") == F.col("__id")
    verdict = cut(marked.filter("doc_id is not null").join(stays, F.col("fp") == F.col("__fp"), "left")
                  .groupBy(F.col("doc_id").alias("__id"))
                  .agg(F.coalesce(F.bool_or(F.col("doc_id") == F.col("__of")), F.lit(False)).alias("keep"),
                       F.count(F.lit(1)).alias("n")))
    kept = docs.filter("doc_id is not null").join(
        stored(verdict.filter("not keep").select("__id"), "dropped"), own, "left_anti")
    again = stored(verdict.filter("keep and n > 1").select("__id"), "repeated")
    unsure = None
    if not again.isEmpty():
        unsure, kept = kept.join(again, own, "left_semi"), kept.join(again, own, "left_anti")
    if not marked.filter("doc_id is null").isEmpty():
        nameless = docs.filter("doc_id is null")
        unsure = nameless if unsure is None else unsure.unionByName(nameless)
    if unsure is None:
        return kept
    text = F.xxhash64(text_bytes())
    found = cut(fingerprints(unsure.select(text.alias("doc_id"), "text"), shingle)
                .select(F.col("doc_id").alias("__text"), F.col("fp").alias("__fp")).distinct()
                .join(stays, "__fp"))
    mine = (text == F.col("__text")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__of"))
    return kept.unionByName(unsure.join(found, mine).dropDuplicates(["__fp"]).select(*docs.columns))
