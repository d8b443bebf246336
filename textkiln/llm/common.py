"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.session import scratch_path

# Spark removes a query's shuffle files when the query ends, instead of when
# the driver happens to collect its garbage; a job that ran to a written table
# needs them no longer.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``.

    Cuts lineage, survives lost executors, and gives later joins plain scans
    on both sides, so that adaptive execution may split their hot keys.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Written tables of one job, by name; dropped ones free their space at
    once, when later tables have taken over what they held."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job, self.paths = spark, job, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, f"{self.job}-{name}")
        with _shuffle_cleanup(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch whose ``column`` holds about ``most_bytes`` at
    most, one row at least: Python objects made of a part stay small even
    where rows are very long."""
    if not len(batch):
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def utf8_parts(column: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes; null is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def doc_remainder(doc_id: Column | str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``, the documented train/held-out rule."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key`` (all rows when
    there are fewer), the same ones in every run."""
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) < F.lit(int(1_000_000 * most / n)))
