"""ST1: many micro-batches, a batch that fails half way, and a failure between
the sink and the checkpoint's commit; the sink holds the batch result once."""

import os
import shutil

import pytest

from conftest import SF001
from textkiln.operators import html_text as H
from textkiln.plans.corpus_queries import corpus_append_stream
from textkiln.sources.tables import load
from textkiln.streaming.append import append_pages, committed_batches, read_sink

FILES = 6


def _land(spark, folder):
    """Six files of pages, landed in order of their names."""
    os.makedirs(folder)
    pages = load(spark, SF001, "pages")
    pages.repartitionByRange(FILES, "page_id").write.parquet(folder + "-parts")
    parts = sorted(n for n in os.listdir(folder + "-parts") if n.endswith(".parquet"))
    assert len(parts) == FILES
    for i, name in enumerate(parts):
        to = f"{folder}/page-{i}.parquet"
        shutil.copy(f"{folder}-parts/{name}", to)
        os.utime(to, (1_700_000_000 + i, 1_700_000_000 + i))
    return pages


def _rows(df):
    return sorted((r["page_id"], r["url"], r["text"]) for r in df.select("page_id", "url", "text").collect())


@pytest.fixture
def dirs(tmp_path):
    return tuple(str(tmp_path / x) for x in ("land", "sink", "ckpt"))


def test_one_file_a_batch(spark, dirs):
    land, sink, ckpt = dirs
    pages = _land(spark, land)
    assert append_pages(spark, land, sink, ckpt, max_files_per_trigger=1) == FILES
    assert _rows(read_sink(spark, sink)) == _rows(H.page_text(pages))
    assert append_pages(spark, land, sink, ckpt, max_files_per_trigger=1) == 0
    assert committed_batches(spark, ckpt) == FILES


def test_batch_that_fails_half_way(spark, dirs):
    land, sink, ckpt = dirs
    pages = _land(spark, land)
    # Two files a batch: the second batch reads a good file and a broken one.
    with open(f"{land}/page-3.parquet", "rb") as f:
        good = f.read()
    with open(f"{land}/page-3.parquet", "wb") as f:
        f.write(b"PAR1 cut off")
    os.utime(f"{land}/page-3.parquet", (1_700_000_003, 1_700_000_003))
    with pytest.raises(Exception):
        append_pages(spark, land, sink, ckpt, max_files_per_trigger=2)
    assert committed_batches(spark, ckpt) == 1
    whole = _rows(H.page_text(pages))
    kept = _rows(read_sink(spark, sink))
    assert 0 < len(kept) < len(whole) and set(kept) < set(whole)
    with open(f"{land}/page-3.parquet", "wb") as f:
        f.write(good)
    os.utime(f"{land}/page-3.parquet", (1_700_000_003, 1_700_000_003))
    assert append_pages(spark, land, sink, ckpt, max_files_per_trigger=2) == 2
    assert _rows(read_sink(spark, sink)) == whole


def test_failure_between_sink_and_commit(spark, dirs):
    land, sink, ckpt = dirs
    pages = _land(spark, land)
    append_pages(spark, land, sink, ckpt, max_files_per_trigger=2)
    whole = _rows(H.page_text(pages))
    # As if the driver had died after the sink took the last batch: its commit is missing.
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    assert committed_batches(spark, ckpt) == 2
    assert append_pages(spark, land, sink, ckpt, max_files_per_trigger=2) == 1
    assert _rows(read_sink(spark, sink)) == whole


@pytest.mark.parametrize("parts", [1, FILES])
def test_query_reads_a_file_or_a_folder(spark, tmp_path, parts):
    pages = load(spark, SF001, "pages")
    table = str(tmp_path / "pages.parquet")
    if parts == 1:
        shutil.copy(f"{SF001}/pages.parquet", table)
    else:
        pages.repartitionByRange(parts, "page_id").write.parquet(table)
    assert _rows(corpus_append_stream(spark, str(tmp_path))) == _rows(H.page_text(pages))
