"""A corpus that stays readable while it is rebuilt (S7, S8), counted by the
pass that writes it (S14, A3).

Layout under one folder::

    generations/corpus_run=<id>/status=ok|quarantine/   the rows of one run
    commits/                                            one small file a run

A run writes its rows into a generation of its own and then adds one row to
``commits``; readers follow ``commits`` only.  A run that fails leaves a
generation nobody reads, so a failed ``fresh`` run keeps the corpus as it was,
and a running one is invisible.  ``fresh`` starts over: readers take the
generations from the newest fresh commit on.  One writer at a time.

The counters of a run are metrics observed while its rows are written: no
second job reads them again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.text import frame_document

COMMIT_SCHEMA = ("version long, generation string, fresh boolean, run_id string, columns string, "
                 "written long, empty long, quarantined long, n_chars long, n_bytes long")
COUNTERS = ["written", "empty", "quarantined", "n_chars", "n_bytes"]


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished run, with its counters; no rows before the first."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/commits")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def _folder(path: str, generation: str) -> str:
    return f"{path}/generations/corpus_run={generation}"


def _live(spark: SparkSession, path: str) -> list:
    """Commits that readers follow, oldest first (as many as there were runs)."""
    rows = commits(spark, path).orderBy("version").collect()
    fresh = [i for i, r in enumerate(rows) if r["fresh"]]
    return rows[fresh[-1]:] if fresh else rows


def write_results(results: DataFrame, path: str, fresh: bool = False, run_id: str | None = None, text_col: str = "text") -> dict:
    """Add (or, ``fresh``, put in place of all earlier ones) the rows of
    ``results``, whose ``status`` is ``ok`` or ``quarantine``; returns the counters.

    ``written`` counts the ok rows, ``empty`` those of them whose text is the
    empty string; characters and bytes are those of the framed ok texts.
    Without ``run_id`` a second call adds the rows again, as running twice does;
    with it a run that has been committed is not repeated."""
    spark = results.sparkSession
    past = commits(spark, path)
    if run_id is not None:
        done = past.where(F.col("run_id") == run_id).first()
        if done:
            return {c: done[c] for c in COUNTERS}
    ok = F.col("status") == "ok"
    framed = frame_document(text_col)
    seen = Observation(f"corpus-{uuid.uuid4().hex[:12]}")
    counted = results.observe(
        seen,
        F.count_if(ok).alias("written"),
        F.count_if(ok & (F.col(text_col) == "")).alias("empty"),
        F.count_if(~ok).alias("quarantined"),
        F.sum(F.when(ok, F.length(framed)).cast("long")).alias("n_chars"),
        F.sum(F.when(ok, F.octet_length(framed)).cast("long")).alias("n_bytes"),
    )
    generation = uuid.uuid4().hex
    counted.write.partitionBy("status").parquet(_folder(path, generation))
    counters = {c: int(seen.get.get(c) or 0) for c in COUNTERS}
    version = (past.agg(F.max("version")).first()[0] or 0) + 1
    row = (version, generation, fresh, run_id, results.schema.json(), *counters.values())
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return counters


def write_corpus(corpus: DataFrame, path: str, fresh: bool = False, run_id: str | None = None, text_col: str = "text") -> dict:
    """``write_results`` for a table of texts; a null text goes to quarantine."""
    status = F.when(F.col(text_col).isNotNull(), "ok").otherwise("quarantine")
    return write_results(corpus.withColumn("status", status), path, fresh, run_id, text_col)


def read_corpus(spark: SparkSession, path: str, status: str = "ok") -> DataFrame:
    """The rows of one status in the live generations; the others are pruned."""
    live = _live(spark, path)
    if not live:
        raise FileNotFoundError(f"no committed corpus at {path}")
    schema = T.StructType.fromJson(json.loads(live[-1]["columns"]))
    reader = spark.read.schema(schema).option("basePath", f"{path}/generations")
    rows = reader.parquet(*[_folder(path, r["generation"]) for r in live])
    return rows.where(F.col("status") == status).drop("corpus_run")


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the generations no reader follows; run it while nobody writes.
    Returns their number."""
    keep = {f"corpus_run={r['generation']}" for r in _live(spark, path)}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/generations")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    unread = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in keep]
    for p in unread:
        fs.delete(p, True)
    return len(unread)
