"""Registered queries of the corpus operators, one per operator, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import ann, fingerprints, line_dedup, lm, merkle, mixing, packing, parity_join, sharding, simhash, substrings, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register
def op1_document_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


@register
def op2_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@register
def op3_substring_dedup(spark, sf_dir):
    kept = substrings.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@register
def op4_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir))


@register
def op5_lm_scoring(spark, sf_dir):
    return lm.score_documents(documents(spark, sf_dir))


@register
def op6_ngram_jaccard_join(spark, sf_dir):
    return parity_join.near_duplicates(documents(spark, sf_dir))


@register
def op7_nearest_neighbours(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(table, ann.valid_vectors(table).where("vec_id % 100 = 0"))


@register
def op8_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir), sharding.topology(8), sharding.topology(9))


@register
def op9_mixing(spark, sf_dir):
    rows = mixing.calibrated(documents(spark, sf_dir), F.col("source"), F.col("lang"))
    return rows.select("doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
                       F.col("__probability").alias("probability"), F.col("__kept").alias("kept"))


@register
def op10_line_dedup(spark, sf_dir):
    return line_dedup.without_repeated_lines(documents(spark, sf_dir)).select("doc_id", "text")


# Winnowing and extension find every repeated run of two lines and every repeated long line, so plain SQL over all runs agrees.
ORACLE["op10_line_dedup"] = r"""
with lines as (
  select doc_id, i, line, trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') as key
  from (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents)),
filled as (
  select doc_id, i, key, row_number() over w as pos, lead(key) over w as next_key, lead(i) over w as next_i
  from lines where key <> '' window w as (partition by doc_id order by i)),
runs as (
  select doc_id, pos, key || chr(10) || next_key as run, [i, next_i] as places from filled where next_key is not null
  union all
  select doc_id, pos, key, [i] from filled where len(string_split(key, ' ')) >= LONG),
ordered as (select *, row_number() over (partition by run order by doc_id, pos) as nth from runs),
gone as (select distinct doc_id, unnest(places) as i from ordered where nth > 1)
select d.doc_id, coalesce(k.text, case when d.text is not null then '' end) as text
from documents d left join (
  select l.doc_id, string_agg(line, chr(10) order by l.i) as text
  from lines l left join gone g on l.doc_id = g.doc_id and l.i = g.i where g.i is null group by l.doc_id) k on d.doc_id = k.doc_id
""".replace("LONG", str(line_dedup.LONG_WORDS))


@register
def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(documents(spark, sf_dir))


ORACLE["op11_merkle_manifest"] = merkle.oracle_sql()


@register
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register
def op13_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))
