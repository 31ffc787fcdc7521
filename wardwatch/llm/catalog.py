"""Named queries of the operators: key -> callable(spark, sf_dir) -> DataFrame,
each over its whole table, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, embed_dedup, filter_audit, hard_negatives, langid, licenses, lm, packing, pieces, quality,
               sharding, simhash, topk)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


# SQL of op7 and op12: vectors that take part, as integers, and their inner product
_INTEGERS = """select vec_id, label, list_transform(embedding, lambda e: cast(floor(256 * cast(e as double)) as bigint)) as x
  from embeddings where vec_id is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0"""
_PRODUCT = "cast(list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) as bigint)"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), length=1024)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).drop("fp")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), sharding.EIGHT, sharding.NINE)


def op11_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, vectors.filter("vec_id % 100 = 0"), positives=5, negatives=5, low=80, high=100)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_license_scan, op2_packing, op3_embedding_near_dedup, op4_lm_scoring, op5_sentencepiece,
    op6_quality_classifier, op7_top_k_search, op8_language_id, op9_simhash_near_dedup, op10_sharding,
    op11_approximate_neighbours, op12_hard_negatives, op13_filter_audit)}

#: DuckDB twins.  The other operators need XXH64, CRC32, tokenizers, trained models or
#: iteration; tests/llm holds each against a brute-force version.
SQL: dict[str, str] = {
    "op7_top_k_search": f"""
with v as ({_INTEGERS}), scored as (
  select q.vec_id as query_id, c.vec_id, max({_PRODUCT.format(a="q.x", b="c.x")}) as score
  from v q join v c on q.vec_id != c.vec_id and len(q.x) = len(c.x) where q.vec_id % 50 = 0 group by q.vec_id, c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5""",
    "op12_hard_negatives": f"""
with v as ({_INTEGERS}),
one as (select vec_id, x, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label
        from v where label is not null),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, {_PRODUCT.format(a="a.x", b="c.x")} as score
  from one a join one c on a.vec_id != c.vec_id and len(a.x) = len(c.x) where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5""",
    "op13_filter_audit": """
with words as (
  select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
flags as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels group by doc_id),
docs as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(min(words.doc_id) over (partition by text) < words.doc_id, false)] as fails
  from words left join flags on words.doc_id = flags.doc_id),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (select a.f || b.f || c.f || d.f || e.f as filter_order from letters a, letters b, letters c, letters d, letters e
           where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (select filter_order, step, ascii(substr(filter_order, step, 1)) - 64 as own,
                 list_transform(range(1, step), lambda i: ascii(substr(filter_order, cast(i as integer), 1)) - 64) as earlier
          from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
masks as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from docs group by part, fails),
told as (select part, filter_order, step, own, n, good, toxic, fails[own] as fail,
                coalesce(list_bool_or(list_transform(earlier, lambda i: fails[i])), false) as gone,
                len(list_filter(fails, lambda x: x)) as many
         from masks, steps),
counted as (
  select part, filter_order, step, own,
         sum(case when not fail and not gone then n else 0 end) as kept,
         sum(case when fail and not gone then n else 0 end) as removed,
         sum(case when fail and gone then n else 0 end) as redundant,
         sum(case when fail and many = 1 then n else 0 end) as unique_fails,
         sum(case when fail and not gone then good else 0 end) as good_lost,
         sum(case when fail and not gone then toxic else 0 end) as toxic_lost
  from told group by part, filter_order, step, own)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from counted""",
}
