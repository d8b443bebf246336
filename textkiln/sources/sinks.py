"""Sinks for the token data and the tokenizer.

Everything is written through Spark writers into a folder given by the caller
(a shared file system or object store on a cluster).  The tokenizer artefacts
are bounded by the vocabulary size; their text forms are written as single
part files with ``coalesce(1)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.operators.bpe import MERGES_SCHEMA, BpeModel


def save_tokenizer(spark: SparkSession, model: BpeModel, path: str) -> None:
    """``merges`` and ``vocab`` tables plus the two file forms
    (``vocab.json`` content and ``merges.txt`` lines, ``#version: 0.2`` first)."""
    model.merges_df(spark).write.mode("overwrite").parquet(f"{path}/merges")
    model.vocab_df(spark).write.mode("overwrite").parquet(f"{path}/vocab")
    spark.createDataFrame([(model.vocab_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/vocab.json")
    lines = model.merges_txt().rstrip("\n").split("\n")
    spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string").orderBy("i").select(
        "value").coalesce(1).write.mode("overwrite").text(f"{path}/merges.txt")


def load_tokenizer(spark: SparkSession, path: str) -> BpeModel:
    rows = spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges").orderBy("rank").collect()
    return BpeModel([(r["left_id"], r["right_id"], r["new_id"]) for r in rows])


def load_tokenizer_files(spark: SparkSession, path: str) -> BpeModel:
    """S11 read back from the two file forms (both bounded by the vocabulary size)."""
    vocab = spark.read.text(f"{path}/vocab.json", wholetext=True).first()["value"]
    merges = spark.read.text(f"{path}/merges.txt", wholetext=True).first()["value"]
    return BpeModel.from_files(vocab, merges)


def save_token_splits(tokens: DataFrame, path: str) -> None:
    """One table partitioned by ``split`` (train / val)."""
    tokens.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Reads one split; the filter prunes the other partition folder."""
    return spark.read.parquet(path).where(F.col("split") == split)


def save_meta(spark: SparkSession, path: str, vocab_size: int, **extra: int) -> None:
    """One-row metadata table."""
    cols = {"vocab_size": vocab_size, **extra}
    spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} long" for k in cols)).write.mode("overwrite").parquet(path)


def load_meta(spark: SparkSession, path: str) -> dict:
    rows = spark.read.parquet(path).collect()
    if not rows:
        raise FileNotFoundError(f"no metadata at {path}")
    return rows[0].asDict()
