"""ST1: incremental corpus append of newly landed pages.

A stateless Structured Streaming query: file source over the landing folder
(explicit schema; ``pathGlobFilter`` selects the page files), the same page
extraction as the batch path, and a parquet append sink with a checkpoint.
The sink is partitioned by ``status``: one pass writes texts to ``status=ok``
and failed pages, with their error, to ``status=quarantine``, both exactly
once by the sink's own log.
``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can run it like a batch job; a rerun with the same checkpoint only
picks up new files (the reference appends duplicates on every rerun).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.operators import html_text as H
from textkiln.sources.tables import SCHEMAS


def landed_files(spark: SparkSession, path: str) -> tuple[str, str]:
    """Landing folder and file glob of a landed table: a folder lands all its
    files, a single file lies in its parent (a stream reads folders only)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(at).isDirectory():
        return path, "*"
    return at.getParent().toString(), at.getName()


def page_text_stream(spark: SparkSession, landing_dir: str, file_glob: str = "*.parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS["pages"]).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    pages = reader.parquet(landing_dir)
    return H.page_results(pages)


def read_sink(spark: SparkSession, sink_dir: str, status: str = "ok") -> DataFrame:
    """The appended rows of one status; the other folder is pruned."""
    return spark.read.parquet(sink_dir).where(F.col("status") == status)


def committed_batches(spark: SparkSession, checkpoint_dir: str) -> int:
    """Micro-batches committed so far with this checkpoint.  Spark keeps the
    newest commits only, so the highest batch id counts, not the files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


def append_pages(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint_dir: str,
                 file_glob: str = "*.parquet", max_files_per_trigger: int | None = None) -> int:
    """Run one available-now pass over what has landed, ``max_files_per_trigger``
    files a micro-batch; returns the number of micro-batches it committed.

    A pass that fails raises; the next one with the same checkpoint repeats the
    batch it failed in, with the same files.  Rows of a batch that had reached
    the sink but not the checkpoint's commit are not written again: the sink's
    log names the batches it holds, and ``read_sink`` reads only files in it."""
    before = committed_batches(spark, checkpoint_dir)
    stream = page_text_stream(spark, landing_dir, file_glob, max_files_per_trigger)
    q = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("status")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return committed_batches(spark, checkpoint_dir) - before
