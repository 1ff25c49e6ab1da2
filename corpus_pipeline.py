"""From raw documents to packed sequences: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the columns
of ``docs``.  ``run`` writes each stage's rows as Parquet in the shared folder and reads them as the next one's documents; what a stage has
written besides is deleted then.  Null texts are empty documents, null ids are ids like others, and rows that repeat are worked
on one by one, unless a stage says otherwise; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, exact_dedup, packing, quality, simhash
from tessera.llm.common import discard_since, made, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the trusted text's n-gram model is within their language's threshold.

    A tie with the threshold stays, as does everything where nothing is trusted.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id; null ids count as smallest, of ties any one."""
    return exact_dedup.drop_exact(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more (Jaccard of the sets), that with the smallest id.

    Null and empty texts are one group; rows of one id and text stay together, as does a group without ids.
    """
    return simhash.drop_near(docs, **simhash.FIVE_WORDS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage; null and empty texts have none, an empty benchmark drops nothing."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and where they lie in sequences of 2048 tokens; a null text is the end's id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("exact dedup", no_copies),
    ("near dedup", no_near_copies),
    ("benchmark decontamination", no_benchmark),
    ("packing", packed),
]

#: The model, the fingerprints and the token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        mark = made()
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard_since(spark, mark, 1)
    return STAGES[-1][1](spark, docs, sf_dir)
