"""The corpus pipeline: documents -> clean, deduplicated, mixed, packed token sequences.

Five stages, each one operator of ``forgeline.llm`` over all rows that the one
before has kept; each result is written as Parquet in the shared folder and
read back as the next stage's documents.  All stages but the last return the
columns of ``documents``.  ``n_chars`` follows the text where a stage changes it.

Tokenisation can't be expressed in SQL, so there is no oracle; the stages are
tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import line_dedup, mixing, packing, parity_join, toxicity
from forgeline.llm.common import plainly_named, stored

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the toxicity model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: later runs of repeated lines go; a document that consists of nothing else goes with them."""
    plain = plainly_named(docs, "doc_id", "text", "n_chars")
    left = line_dedup.without_repeated_lines(plain.withColumn("__was", F.octet_length("text")))
    emptied = F.coalesce((F.col("__was") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]") & (F.octet_length("text") < F.col("__was")), F.lit(False))
    left = left.where(~emptied)
    if "n_chars" in docs.columns:
        changed = F.octet_length("text") < F.col("__was")
        left = left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near copies the document with the smallest id stays."""
    return parity_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: a sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token pieces in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
