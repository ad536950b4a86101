"""A corpus pipeline: toxicity filter, near-duplicates, personal data, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but
the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cladeworks.llm import mixing, packing, pii, simhash, toxicity
from cladeworks.runtime import ensure_checkpoint_dir, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model flags go."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group of linked fingerprints."""
    return simhash.deduplicate(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become tags; no document goes."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document; the one at a source's cut keeps its first words."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences along the Hilbert curve."""
    return packing.pack(docs, cached_words=CACHED_WORDS)


#: Words that packing remembers; its workers have served other stages and share the executor's memory with them.
CACHED_WORDS = 300_000

STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: The fitted and iterative stages are beyond SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
