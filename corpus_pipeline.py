"""A training corpus from ``documents``: each stage takes the rows that the one before kept.

The stages keep the columns of documents, but for the last, which returns the shard and
slot of every row that is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.common import intermediates, read_table, written
from tillroll.llm.decontaminate import decontaminated
from tillroll.llm.language_id import language_filter
from tillroll.llm.mixing import mixed_documents
from tillroll.llm.queries import MIX, domain_of
from tillroll.llm.sharding import resharded_store
from tillroll.llm.simhash import simhash_dedup


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return language_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints stays."""
    return simhash_dedup(docs, shingle=3, max_bits=2)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"), n=5, share=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated to fit the budgets of their sources."""
    return mixed_documents(docs, domain_of(), **MIX)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A store of 16 shards is rewritten to 24 of equal bytes, where rows move."""
    return resharded_store(docs, shards=24, old_shards=16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The language network and the fingerprints have no SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote goes once its result is written, and a
    stage's result once the next one has it; the last stage's store and tables stay."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with intermediates(spark) as made:
            docs = written(stage(spark, docs, sf_dir), name)
            result = made.pop()
            made += [last] if last else []
        last = result
    return STAGES[-1][1](spark, docs, sf_dir)
