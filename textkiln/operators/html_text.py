"""Landed pages -> blocks -> main text.

One ``mapInArrow`` pass parses each page and returns its blocks as an array
column, so the page text is assembled inside the same row: the whole path from
scan to text has **no shuffle** and scales with the number of input splits.
A page that fails to parse becomes a quarantine row instead of failing the job.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.arrow_parts import parts
from textkiln.functions.html_blocks import extract_blocks

# Fixed value: shortest block kept, in code points (inclusive).
MIN_PARAGRAPH_LEN = 40

BLOCK_TYPE = T.StructType([
    T.StructField("block_pos", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("text", T.StringType()),
])
PARSED_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("blocks", T.ArrayType(BLOCK_TYPE)),
    T.StructField("error", T.StringType()),
])

_ARROW_BLOCK = pa.struct([("block_pos", pa.int32()), ("tag", pa.string()), ("text", pa.string())])
_ARROW_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("blocks", pa.list_(_ARROW_BLOCK)), ("error", pa.string())])


# HTML that is parsed before its blocks go back to Spark.
PART_BYTES = 1 << 20


def _parse_batches(batches):
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("html")), 0).to_numpy(zero_copy_only=False)
        yield from _parsed(parts(batch, sizes, PART_BYTES))


def _parsed(batches):
    for batch in batches:
        ids = batch.column("page_id")
        urls = batch.column("url")
        htmls = batch.column("html").to_pylist()
        out_blocks, out_err = [], []
        for html in htmls:
            try:
                found = extract_blocks(html)
                out_blocks.append([{"block_pos": i, "tag": t, "text": s} for i, (t, s) in enumerate(found)])
                out_err.append(None)
            except Exception as exc:  # noqa: BLE001 - per-row quarantine (S14)
                out_blocks.append(None)
                out_err.append(f"{type(exc).__name__}: {exc}")
        yield pa.RecordBatch.from_arrays(
            [ids, urls, pa.array(out_blocks, pa.list_(_ARROW_BLOCK)), pa.array(out_err, pa.string())],
            schema=_ARROW_OUT,
        )


def parse_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` -> ``(page_id, url, blocks array<struct>, error)``; narrow, no shuffle."""
    return pages.select("page_id", "url", "html").mapInArrow(_parse_batches, PARSED_SCHEMA)


def kept_text(blocks: Column, min_len: int = MIN_PARAGRAPH_LEN) -> Column:
    """P3 + F2 on the block array: keep long blocks, join with newline, in order."""
    kept = F.filter(blocks, lambda b: F.length(b["text"]) >= min_len)
    return F.array_join(F.transform(kept, lambda b: b["text"]), "\n")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Every block of every good page: ``(page_id, block_pos, tag, text, n_chars, kept)``."""
    parsed = parse_pages(pages).where(F.col("error").isNull())
    return (
        parsed.select("page_id", F.explode("blocks").alias("b"))
        .select(
            "page_id",
            F.col("b.block_pos").alias("block_pos"),
            F.col("b.tag").alias("tag"),
            F.col("b.text").alias("text"),
        )
        .withColumn("n_chars", F.length("text"))
        .withColumn("kept", F.col("n_chars") >= MIN_PARAGRAPH_LEN)
    )


def page_results(pages: DataFrame, min_len: int = MIN_PARAGRAPH_LEN) -> DataFrame:
    """Every page, failed ones with their ``error`` and no text, in one pass:
    ``(page_id, url, text, n_blocks, n_chars, error, status)``; ``status`` is
    ``ok`` or ``quarantine``."""
    parsed = parse_pages(pages)
    ok = F.col("error").isNull()
    return parsed.select(
        "page_id",
        "url",
        F.when(ok, kept_text(F.col("blocks"), min_len)).alias("text"),
        F.when(ok, F.size(F.filter("blocks", lambda b: F.length(b["text"]) >= min_len))).alias("n_blocks"),
        "error",
        F.when(ok, "ok").otherwise("quarantine").alias("status"),
    ).withColumn("n_chars", F.length("text"))


def page_text(pages: DataFrame, min_len: int = MIN_PARAGRAPH_LEN) -> DataFrame:
    """Main text per page: ``(page_id, url, text, n_blocks, n_chars)``."""
    good = page_results(pages, min_len).where(F.col("status") == "ok")
    return good.select("page_id", "url", "text", "n_blocks", "n_chars")


def page_quarantine(pages: DataFrame) -> DataFrame:
    """Pages whose extraction failed: ``(page_id, error)``."""
    return parse_pages(pages).where(F.col("error").isNotNull()).select("page_id", "error")
