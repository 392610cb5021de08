"""A cleaning pipeline over ``documents``: toxicity, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; ``run`` writes each result as Parquet in the shared folder and reads it
back for the next stage.  Stages cannot be said in SQL (learned model, XXH64
fingerprints, decoders), so ``ORACLE_SQL`` is None and tests compare with
a brute-force version.

Defined cases, for every stage: an empty table passes through as one; null and
empty texts are scored like any text without words, have the fingerprint zero,
no benchmark window, no secret and no tokens; rows that repeat are judged alike,
and the near-duplicate stage keeps one of them; a row with a null ``doc_id`` is
never held out and stays in the near-duplicate stage; columns beside ``doc_id``,
``text`` and ``n_chars`` are carried as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import decontam, queries, secrets, simhash, toxicity
from eventlens.llm.common import stage_table, table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF model scores under 0.3; learned from the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~queries.held_out())
    return toxicity.clean(docs, toxicity.train(docs.where(~queries.held_out()), labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each component of fingerprints within 4 bits."""
    return simhash.one_of_each(docs, words=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text masked and n_chars counted anew where the text changed."""
    masked = secrets.redact(docs.withColumn("__was", F.col("text")))
    chars = F.when(F.col("text") != F.col("__was"), F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).drop("__was")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their digest and that of the decoded bytes."""
    return queries.tokens_of(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("byte_level_bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
