"""Documents to clean, deduplicated, tokenised training text in five stages.

Every stage takes (spark, docs, sf_dir) and returns a table, written as Parquet before the next one
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from webglean.llm import bpe, decontam, jaccard_join, pii, toxicity
from webglean.llm.queries import MULTI_RANKS, PII_KEY, table
from webglean.session import cut_lineage

# No SQL: the first stage is a learned model.
ORACLE_SQL = None


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects. It learns from the stage's input."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, to="_toxic").filter(F.col("_toxic") < toxicity.REJECT).drop("_toxic")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Documents without an id, and rows that share one, are told apart by nothing and all stay if the
    id does.
    """
    found = jaccard_join.join_components(docs)
    others = found.filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti")


def keep_unknown_to_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_people(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced; ``n_chars`` follows the text."""
    clean = pii.replace_pii(docs, PII_KEY, count=None)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)
    ))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of the ids and of what they decode to."""
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), MULTI_RANKS, public_tokenizers.PATTERN)
    # Written: in one plan every task would hold two Python workers at a time, and each of them, as workers
    # change places, in the end what encoding remembers.
    ids = cut_lineage(ids.drop("text"))
    return bpe.decode(ids, MULTI_RANKS).select(
        "doc_id", "lang", "source", "n_tokens", "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", keep_harmless),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_unknown_to_benchmarks),
    ("PII", hide_people),
    ("byte-level BPE", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's table is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
