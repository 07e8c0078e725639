"""A training corpus from raw documents, in five stages that each work on all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakequality.llm import decontaminate, host_rules, minhash, mixing, sharding
from lakequality.llm.queries import MIX, N_SHARDS, labelled_domains
from lakequality.llm.tables import read, session, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return host_rules.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the least id."""
    return minhash.remove_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark"), mode="document")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates ask for; a rate below one may leave a document out."""
    return mixing.remix(docs, labelled_domains(spark, sf_dir), MIX)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every record."""
    return sharding.assign(docs, N_SHARDS).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

# Tokenising, signatures and the draw of copies have no SQL form that gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored and read back before the next."""
    docs = read(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
