"""Corpus assembly.

A corpus is a table ``(doc_pos, text)``; the one-file form of the reference
(documents joined by a blank line) exists only at the export sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.functions.text import frame_document, py_nonblank, strip_reference_sections
from textkiln.operators.html_text import MIN_PARAGRAPH_LEN
from textkiln.sources.seeds import text_lines


def long_lines(texts: DataFrame, key: str, min_len: int = MIN_PARAGRAPH_LEN) -> DataFrame:
    """F2 on the lines of a text column: ``(key, line_no, line, n_chars)`` with
    ``n_chars >= min_len`` code points."""
    lines = text_lines(texts, key).withColumn("n_chars", F.length("line"))
    return lines.where(F.col("n_chars") >= min_len)


def keep_nonempty_older(text_col: str = "text"):
    """Keep when not the empty string (whitespace-only is kept)."""
    return F.col(text_col) != ""


def keep_nonempty_newer(text_col: str = "text"):
    """Keep when ``text.strip()`` is not empty."""
    return py_nonblank(text_col)


def clean_extracts(extracts: DataFrame, text_col: str = "extract") -> DataFrame:
    """Newer collector: cut reference sections, then keep non-blank texts
    (tested after the cut, stored unstripped)."""
    cut = extracts.withColumn("text", strip_reference_sections(text_col))
    return cut.where(keep_nonempty_newer("text"))


def last_per_title(extracts: DataFrame, order_col: str = "arrival_pos") -> DataFrame:
    """A4: the last arriving text per title wins: ``(title, text)``.

    ``max_by`` is a partial/final hash aggregate, so a hot title is combined
    map-side before the shuffle."""
    return extracts.groupBy("title").agg(F.max_by("text", order_col).alias("text"))


def join_titles(titles: DataFrame, extracts: DataFrame) -> DataFrame:
    """Titles without an extract drop (inner); both sides are keyed on
    ``title`` and distinct, so Catalyst may sort-merge or hash as sizes say."""
    return titles.join(extracts, "title", "inner")


def frame(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """Each text followed by a blank line, also an empty text."""
    return corpus.withColumn("framed", frame_document(text_col))


def corpus_stats(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """P6, A3, A5 of the framed corpus: documents, characters, bytes, KiB."""
    framed = frame_document(text_col)
    agg = corpus.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length(framed)).cast("long").alias("n_chars"),
        F.sum(F.octet_length(framed)).cast("long").alias("n_bytes"),
    )
    # Python formats size/1024 with ".1f": round half to even on the binary value.
    return agg.withColumn("size_kib", F.bround(F.col("n_bytes") / F.lit(1024.0), 1))


def union_collectors(*parts: DataFrame) -> DataFrame:
    """Several collectors append to one corpus (bag union, no dedup)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_corpus(corpus: DataFrame, path: str, fresh: bool = False) -> None:
    """Append (default; rerunning duplicates content like the
    reference) or overwrite with ``fresh``."""
    corpus.write.mode("overwrite" if fresh else "append").parquet(path)


def export_corpus_text(corpus: DataFrame, path: str, order_col: str = "doc_pos", text_col: str = "text") -> None:
    """One-file text form for tools that want it: documents in ``order_col``
    order, each followed by a blank line.  Spark writes the sorted range
    partitions as ordered part files; concatenating them gives the file."""
    framed = corpus.select(order_col, F.concat(F.col(text_col), F.lit("\n")).alias("value"))
    framed.orderBy(order_col).select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
