import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textkiln.operators import html_text as H
from textkiln.sources.tables import load
from textkiln.streaming.append import append_pages, read_sink

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402


def test_stream_equals_batch_and_rerun_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="textkiln-stream-")
    sink, ckpt = f"{base}/sink", f"{base}/ckpt"
    append_pages(spark, SF001, sink, ckpt, file_glob="pages.parquet")
    first = read_sink(spark, sink)
    n = first.count()
    batch = H.page_text(load(spark, SF001, "pages"))
    assert n == batch.count() == 50
    assert first.select("page_id", "text").exceptAll(batch.select("page_id", "text")).count() == 0
    append_pages(spark, SF001, sink, ckpt, file_glob="pages.parquet")
    assert spark.read.parquet(sink).count() == n


def test_stream_keeps_failed_pages_in_quarantine(spark, tmp_path):
    land, sink, ckpt = (str(tmp_path / x) for x in ("land", "sink", "ckpt"))
    pages = load(spark, SF001, "pages").limit(3)
    lost = pages.limit(1).withColumn("page_id", F.lit(-1).cast(pages.schema["page_id"].dataType)).withColumn("html", F.lit(None).cast("string"))
    pages.unionByName(lost).write.parquet(land)
    append_pages(spark, land, sink, ckpt)
    assert read_sink(spark, sink).count() == 3
    kept = read_sink(spark, sink, "quarantine").collect()
    assert [r["page_id"] for r in kept] == [-1] and kept[0]["error"] and kept[0]["text"] is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 1
    assert df.columns == ["page_id", "url", "text", "n_blocks", "n_chars"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["min_paragraph_filter", "corpus_frame", "strip_references", "api_extracts_parse", "nonempty_docs",
        "last_extract_per_title", "title_extract_join", "corpus_union", "corpus_stats", "member_kinds",
        "category_walk", "title_batches", "split_summary", "training_windows", "split_loss", "sample_next_token",
        "seed_lines", "collect_newer", "collect_older", "sampled_loss", "corpus_store", "page_store"]


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "documents", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp
