"""The corpus pipeline: documents in, a mixed training corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; between stages the rows are a written table.

1. quality: rows that the rule ensemble scores below 0.3 go.
2. near_duplicates: one row of each component of the Jaccard join stays (five
   words, similarity 0.8).
3. substring_dedup: repeated chunks are cut out of the texts.
4. decontaminate: documents that hold a benchmark window go.
5. mix: rows are repeated or left out so that sources meet their targets; a
   column ``copy`` numbers a row's repeats from 1.

Stages 1 to 4 return the columns of ``documents``.  ``n_chars`` follows a cut.
Empty tables, null texts and rows without an id pass as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm import decontaminate as benchmark_hits
from textkiln.llm import jaccard_join, mixing, quality, substring_dedup
from textkiln.llm.common import doc_remainder, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(doc_remainder("doc_id", 5) != 0)
    return quality.keep(docs, quality.fit(docs, labels), 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, words=5, percent=80)


def cut_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.size(substring_dedup.spans_column(docs)) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark_hits.decontaminate(docs, table(spark, sf_dir, "benchmark"), action="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_substrings),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

# Trees, hashes and random transfers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
