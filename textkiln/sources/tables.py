"""Driver tables: explicit schemas and a column-pruned loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()),
        T.StructField("r_name", T.StringType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()),
        T.StructField("s_acctbal", T.DoubleType()),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table with its declared schema (no inference).

    Selecting ``columns`` here keeps the parquet ``ReadSchema`` narrow even
    before Catalyst prunes, which matters for ``pages.html`` and
    ``documents.text``.
    """
    df = spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
