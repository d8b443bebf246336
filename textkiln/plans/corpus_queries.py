"""Queries for pages, seeds and corpus assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.text import strip_reference_sections
from textkiln.operators import corpus as C
from textkiln.operators import html_text as H
from textkiln.plans.catalog import query
from textkiln.plans.sql_text import DOC_LINES, EXTRACT_ROWS, nonblank, ref_cut, strip
from textkiln.sources import landed
from textkiln.sources.seeds import text_seed_items
from textkiln.sources.tables import load, table_path


@query("page_text")
def page_text(spark, sf_dir):
    """Flagship: main text of every landed page (blocks >= 40 chars, newline-joined)."""
    out = H.page_text(load(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.col("n_blocks").cast("long"), F.col("n_chars").cast("long"))


@query("page_blocks")
def page_blocks(spark, sf_dir):
    out = H.page_blocks(load(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", F.col("block_pos").cast("long"), "tag", "text", F.col("n_chars").cast("long"), "kept")


@query("page_quarantine", """
SELECT page_id, 'ValueError: page has no html' AS error FROM pages WHERE html IS NULL
""")
def page_quarantine(spark, sf_dir):
    """The pages that page_text leaves out, with the reason."""
    return H.page_quarantine(load(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("min_paragraph_filter", f"""
WITH {DOC_LINES}
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line, CAST(length(line) AS BIGINT) AS n_chars
FROM doc_lines WHERE length(line) >= 40
""")
def min_paragraph_filter(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    out = C.long_lines(docs, "doc_id")
    return out.select("doc_id", F.col("line_no").cast("long"), "line", F.col("n_chars").cast("long"))


@query("seed_lines", f"""
WITH {DOC_LINES},
s AS (SELECT doc_id, line_no, {strip('line')} AS item FROM doc_lines)
SELECT CAST(row_number() OVER (ORDER BY doc_id, line_no) AS BIGINT) AS seed_pos, item
FROM s WHERE {nonblank('item')} AND NOT starts_with(item, '#')
""")
def seed_lines(spark, sf_dir):
    """S1/S2/F1/W1 over the lines of ``documents`` read as one long seed list."""
    return text_seed_items(load(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")


@query("corpus_frame", """
SELECT doc_id, text || chr(10) || chr(10) AS framed, CAST(length(text) + 2 AS BIGINT) AS n_chars FROM documents
""")
def corpus_frame(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return C.frame(docs).select("doc_id", "framed", F.length("framed").cast("long").alias("n_chars"))


_REF_DOCS_SQL = """
ref_docs AS (
  SELECT doc_id, CASE doc_id % 3
      WHEN 0 THEN text || chr(10) || 'Literatur' || chr(10) || 'A. Autor: Titel.'
      WHEN 1 THEN text || chr(10) || 'Weblinks ' || chr(10) || chr(10) || 'x' || chr(10) || 'Quellen' || chr(10) || 'y'
      ELSE text END AS text
  FROM documents
)"""


def _ref_docs(spark, sf_dir):
    d = load(spark, sf_dir, "documents", "doc_id", "text")
    k = F.col("doc_id") % 3
    text = (
        F.when(k == 0, F.concat("text", F.lit("\nLiteratur\nA. Autor: Titel.")))
        .when(k == 1, F.concat("text", F.lit("\nWeblinks \n\nx\nQuellen\ny")))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", text.alias("text"))


@query("strip_references", f"""
WITH {_REF_DOCS_SQL}
SELECT doc_id, {ref_cut('text')} AS text, CAST(length(text) AS BIGINT) AS n_chars_before,
       CAST(length({ref_cut('text')}) AS BIGINT) AS n_chars
FROM ref_docs
""")
def strip_references(spark, sf_dir):
    docs = _ref_docs(spark, sf_dir)
    out = docs.select("doc_id", strip_reference_sections("text").alias("cut"), F.length("text").cast("long").alias("n_chars_before"))
    return out.select("doc_id", F.col("cut").alias("text"), "n_chars_before", F.length("cut").cast("long").alias("n_chars"))


def _parsed_extracts(spark, sf_dir):
    return landed.parse_extract_responses(landed.extract_responses(spark, sf_dir))


@query("api_extracts_parse", f"""
WITH {EXTRACT_ROWS}
SELECT arrival_pos, page_key, title, extract FROM extract_rows
""")
def api_extracts_parse(spark, sf_dir):
    p = _parsed_extracts(spark, sf_dir)
    return p.where(F.col("error").isNull()).select("arrival_pos", "page_key", "title", "extract")


@query("extract_quarantine", """
SELECT CASE WHEN doc_id % 50 = 17 THEN 'quarantine' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY 1
""")
def extract_quarantine(spark, sf_dir):
    p = _parsed_extracts(spark, sf_dir)
    status = F.when(F.col("error").isNull(), "ok").otherwise("quarantine")
    return p.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("nonempty_docs", f"""
WITH {EXTRACT_ROWS}
SELECT arrival_pos, title, extract,
       extract <> '' AS keep_older,
       {nonblank(ref_cut('extract'))} AS keep_newer
FROM extract_rows
""")
def nonempty_docs(spark, sf_dir):
    p = _parsed_extracts(spark, sf_dir).where(F.col("error").isNull())
    return p.select(
        "arrival_pos", "title", "extract",
        C.keep_nonempty_older("extract").alias("keep_older"),
        C.keep_nonempty_newer(strip_reference_sections("extract")).alias("keep_newer"),
    )


_LAST_SQL = f"""
{EXTRACT_ROWS},
cleaned AS (SELECT arrival_pos, title, {ref_cut('extract')} AS text FROM extract_rows),
last_extract AS (
  SELECT title, arg_max(text, arrival_pos) AS text FROM cleaned WHERE {nonblank('text')} GROUP BY title
)"""


def _last_extracts(spark, sf_dir):
    p = _parsed_extracts(spark, sf_dir).where(F.col("error").isNull())
    return C.last_per_title(C.clean_extracts(p, "extract"))


@query("last_extract_per_title", f"""
WITH {_LAST_SQL}
SELECT title, text FROM last_extract
""")
def last_extract_per_title(spark, sf_dir):
    return _last_extracts(spark, sf_dir)


@query("title_extract_join", f"""
WITH {_LAST_SQL},
wanted AS (SELECT DISTINCT 'Doc ' || CAST(doc_id // 2 AS VARCHAR) AS title FROM labels)
SELECT w.title, l.text FROM wanted w JOIN last_extract l ON w.title = l.title
""")
def title_extract_join(spark, sf_dir):
    wanted = load(spark, sf_dir, "labels", "doc_id").select(landed.extract_title(F.col("doc_id")).alias("title")).distinct()
    return C.join_titles(wanted, _last_extracts(spark, sf_dir)).select("title", "text")


@query("corpus_union", """
SELECT 'documents' AS collector, CAST(doc_id AS VARCHAR) AS item_key, text FROM documents
UNION ALL
SELECT 'conversations', CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), text FROM conversations
UNION ALL
SELECT 'benchmark', CAST(item_id AS VARCHAR), text FROM benchmark
""")
def corpus_union(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text").select(
        F.lit("documents").alias("collector"), F.col("doc_id").cast("string").alias("item_key"), "text")
    conv = load(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.lit("conversations").alias("collector"),
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("item_key"), "text")
    bench = load(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.lit("benchmark").alias("collector"), F.col("item_id").cast("string").alias("item_key"), "text")
    return C.union_collectors(docs, conv, bench)


@query("corpus_stats", """
SELECT CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(length(text) + 2) AS BIGINT) AS n_chars,
       CAST(sum(strlen(text) + 2) AS BIGINT) AS n_bytes,
       round_even(CAST(sum(strlen(text) + 2) AS DOUBLE) / 1024.0, 1) AS size_kib
FROM documents
""")
def corpus_stats(spark, sf_dir):
    return C.corpus_stats(load(spark, sf_dir, "documents", "text"))


@query("corpus_store", """
SELECT CAST(v AS BIGINT) AS version, v = 2 AS fresh, CAST(count(text) AS BIGINT) AS written,
       CAST(count(*) FILTER (WHERE text = '') AS BIGINT) AS empty,
       CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS quarantined,
       CAST(coalesce(sum(length(text) + 2), 0) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(strlen(text) + 2), 0) AS BIGINT) AS n_bytes,
       CAST(CASE WHEN v = 2 THEN count(text) ELSE 0 END AS BIGINT) AS n_read
FROM documents, range(1, 3) r(v) GROUP BY v
""")
def corpus_store(spark, sf_dir):
    """All documents appended, then built afresh; the counters of
    both writes, and what a reader finds of each (nothing of the first)."""
    from textkiln.session import scratch_path
    from textkiln.sources import corpus_store as R

    path = scratch_path(spark, "corpus")
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    R.write_corpus(docs, path)
    R.write_corpus(docs, path, fresh=True)
    n = R.read_corpus(spark, path).count()
    return R.commits(spark, path).select(
        "version", "fresh", *R.COUNTERS, F.when(F.col("fresh"), F.lit(n)).otherwise(0).cast("long").alias("n_read"))


@query("page_store", """
SELECT CASE WHEN lost THEN 'quarantine' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS n_counted, CAST(count(*) AS BIGINT) AS n_read
FROM (SELECT html IS NULL OR page_id % 50 = 17 AS lost FROM pages) GROUP BY lost
""")
def page_store(spark, sf_dir):
    """Page texts written with the failed pages (every 50th body was
    lost on the way) beside them; per status the counter of the writing pass
    and the rows a reader finds."""
    from textkiln.session import scratch_path
    from textkiln.sources import corpus_store as R

    path = scratch_path(spark, "pages")
    got = R.write_results(H.page_results(landed.lost_bodies(load(spark, sf_dir, "pages", "page_id", "url", "html"))), path)
    counted = F.when(F.col("status") == "ok", F.lit(got["written"])).otherwise(F.lit(got["quarantined"]))
    rows = R.read_corpus(spark, path).select("status").unionAll(R.read_corpus(spark, path, "quarantine").select("status"))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n_read")).select("status", counted.cast("long").alias("n_counted"), "n_read")


@query("corpus_append_stream")
def corpus_append_stream(spark, sf_dir):
    """ST1: page texts appended by an available-now stream over the landed
    table, one file or a folder of them; run twice with one checkpoint, the
    second run adds nothing."""
    from textkiln.session import scratch_path
    from textkiln.streaming.append import append_pages, landed_files, read_sink

    base = scratch_path(spark, "append")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    folder, glob = landed_files(spark, table_path(sf_dir, "pages"))
    append_pages(spark, folder, sink, ckpt, file_glob=glob)
    append_pages(spark, folder, sink, ckpt, file_glob=glob)
    return read_sink(spark, sink).select("page_id", "url", "text", F.col("n_blocks").cast("long"), F.col("n_chars").cast("long"))
