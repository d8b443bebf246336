"""Generations and commits against plain lists."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textkiln.operators import html_text as H
from textkiln.sources import corpus_store as R
from textkiln.sources.tables import load

DOCS = [(0, "erste Seite"), (1, ""), (2, "dritte\nSeite ü"), (3, None)]
COUNTS = {"written": 3, "empty": 1, "quarantined": 1, "n_chars": 13 + 2 + 16, "n_bytes": 13 + 2 + 17}


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(DOCS, "doc_pos long, text string").repartition(3)


def _texts(spark, path, status="ok"):
    return sorted(r["doc_pos"] for r in R.read_corpus(spark, path, status).collect())


def test_counters_come_with_the_write(spark, corpus, tmp_path):
    path = str(tmp_path / "c")
    assert R.write_corpus(corpus, path) == COUNTS
    assert _texts(spark, path) == [0, 1, 2] and _texts(spark, path, "quarantine") == [3]


def test_append_repeats_unless_the_run_is_named(spark, corpus, tmp_path):
    path = str(tmp_path / "c")
    R.write_corpus(corpus, path)
    R.write_corpus(corpus, path)
    assert _texts(spark, path) == [0, 0, 1, 1, 2, 2]
    assert R.write_corpus(corpus, path, run_id="monday") == R.write_corpus(corpus, path, run_id="monday") == COUNTS
    assert len(_texts(spark, path)) == 9
    assert R.commits(spark, path).count() == 3


def test_fresh_replaces_and_vacuum_frees(spark, corpus, tmp_path):
    path = str(tmp_path / "c")
    R.write_corpus(corpus, path)
    R.write_corpus(corpus.where("doc_pos = 0"), path, fresh=True)
    assert _texts(spark, path) == [0]
    R.write_corpus(corpus.where("doc_pos = 2"), path)
    assert _texts(spark, path) == [0, 2]
    assert R.vacuum(spark, path) == 1 and R.vacuum(spark, path) == 0
    assert _texts(spark, path) == [0, 2] and len(os.listdir(f"{path}/generations")) == 2


def test_failed_fresh_run_leaves_the_corpus(spark, corpus, tmp_path):
    path = str(tmp_path / "c")
    R.write_corpus(corpus, path)
    broken = corpus.withColumn("text", F.when(F.col("doc_pos") == 2, F.raise_error(F.lit("disk gone"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="disk gone"):
        R.write_corpus(broken, path, fresh=True)
    assert _texts(spark, path) == [0, 1, 2] and R.commits(spark, path).count() == 1
    R.write_corpus(corpus.where("doc_pos < 2"), path, fresh=True)
    assert _texts(spark, path) == [0, 1]
    assert R.vacuum(spark, path) >= 1 and _texts(spark, path) == [0, 1]


def test_failed_commit_is_not_read(spark, corpus, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    R.write_corpus(corpus, path)
    with monkeypatch.context() as m:
        # The rows are written; the run ends before its commit.
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            R.write_corpus(corpus, path, fresh=True)
    assert len(os.listdir(f"{path}/generations")) == 2 and _texts(spark, path) == [0, 1, 2]


def test_empty_and_missing(spark, corpus, tmp_path):
    path = str(tmp_path / "c")
    with pytest.raises(FileNotFoundError):
        R.read_corpus(spark, path)
    assert R.vacuum(spark, path) == 0
    assert set(R.write_corpus(corpus.where("doc_pos < 0"), path).values()) == {0}
    assert _texts(spark, path) == []
    R.write_corpus(corpus, path)
    assert _texts(spark, path) == [0, 1, 2]


def test_pages_without_html_are_counted(spark, tmp_path):
    pages = load(spark, SF001, "pages", "page_id", "url", "html")
    n = pages.count()
    landed = pages.withColumn("html", F.when(F.col("page_id") % 10 != 3, F.col("html")))
    lost = landed.where("html IS NULL").count()
    got = R.write_results(H.page_results(landed), str(tmp_path / "p"))
    assert lost > 0 and (got["written"], got["quarantined"]) == (n - lost, lost)
    bad = R.read_corpus(spark, str(tmp_path / "p"), "quarantine")
    assert bad.where("error = 'ValueError: page has no html' AND text IS NULL").count() == lost
