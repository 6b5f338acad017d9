"""A corpus from raw documents to token ids: five stages, each written and read again.

Every stage gets what its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigforge.llm import decontaminate, minhash, mixing, tokens, toxicity
from sigforge.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    return toxicity.remove(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return minhash.remove(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document as files hold them: doc_id, start, n_tokens, ids_crc32."""
    return tokens.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", token_ids),
]

#: None: learning, Newton steps and file formats have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
