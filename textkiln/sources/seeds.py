"""Seed lists.

A seed list is a text with one item per line; blank lines and lines whose
stripped form starts with ``#`` are skipped; items are stripped; the file order
is kept as ``seed_pos`` (1-based).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions.text import PY_SPACE, py_nonblank, py_splitlines, py_strip, seed_item_array
from textkiln.operators.positions import ordered_offsets, row_index
from textkiln.session import materialised


class EmptyInputError(ValueError):
    """S3: the list or corpus is missing or holds nothing usable."""


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Stop with a typed error when ``df`` has no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df


def text_lines(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``(key, line_no, line)`` for every line of every text (0-based ``line_no``)."""
    return texts.select(key, F.posexplode(py_splitlines(text_col)).alias("line_no", "line"))


def seed_items(lines: DataFrame, order: list[str]) -> DataFrame:
    """Apply the seed rule to ``lines(<order cols>, line)`` and number the
    survivors 1-based in ``order`` without a single-partition window."""
    # Tested on the raw line (same truth value as on the stripped item), so
    # the strip regex runs once, on survivors only, after the filter.
    comment = F.col("line").rlike(f"^{PY_SPACE}*#")
    items = lines.where(py_nonblank("line") & ~comment).withColumn("item", py_strip("line")).drop("line")
    numbered = row_index(items, order, out="seed_pos")
    return numbered.withColumn("seed_pos", F.col("seed_pos") + 1)


def text_seed_items(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``(seed_pos, item)`` over the lines of all texts, in ``key`` order (a
    unique key): the seed rule as one pattern, a prefix sum over the narrow
    ``(key, n)`` columns of the written items, and the place inside the text.
    No item text is sorted or range partitioned."""
    items = texts.select(F.col(key).alias("_key"), seed_item_array(text_col).alias("_items")).where("size(_items) > 0")
    items = materialised(items.select("_key", F.size("_items").alias("_n"), "_items"), "seed-items")
    starts = ordered_offsets(items.select("_key", "_n"), ["_key"], "_n", out="_start").select("_key", "_start")
    return items.join(starts, "_key").select("_start", F.posexplode("_items").alias("_i", "item")).select(
        (F.col("_start") + F.col("_i") + 1).alias("seed_pos"), "item")


def read_seed_file(spark: SparkSession, path: str) -> DataFrame:
    """Read a seed file (or folder of them, in path order) -> ``(seed_pos, item)``.

    ``spark.read.text`` breaks lines at ``\\n``, ``\\r\\n`` and ``\\r``; the other
    breaks of ``str.splitlines()`` are found inside each of its lines, so the
    file form agrees with the table form.  The order is (file, split, line,
    place in the line).  S3: a missing path or a list without items stops with
    ``EmptyInputError``.
    """
    from pyspark.errors import AnalysisException

    try:
        raw = spark.read.text(path)
    except AnalysisException as exc:
        raise EmptyInputError(f"seed list {path} is missing") from exc
    lines = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_no"),
        seed_item_array("value").alias("items"),
    )
    items = lines.select("file", "split", "line_no", F.posexplode("items").alias("part", "item"))
    numbered = row_index(items, ["file", "split", "line_no", "part"], out="seed_pos")
    return require_nonempty(numbered.select((F.col("seed_pos") + 1).alias("seed_pos"), "item"), f"seed list {path}")
