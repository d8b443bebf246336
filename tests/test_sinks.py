"""Sinks: corpus append / overwrite (S7, S8), text export (S9), token splits
(S12), metadata (S13) and tokenizer files (S11)."""

import glob

from textkiln.operators import bpe as B
from textkiln.operators.corpus import export_corpus_text, write_corpus
from textkiln.sources.sinks import load_meta, load_split, load_tokenizer, save_meta, save_token_splits, save_tokenizer

DOCS = [(0, "erste Seite"), (1, ""), (2, "dritte\nSeite  ")]


def test_append_duplicates_and_fresh_overwrites(spark, tmp_path):
    corpus = spark.createDataFrame(DOCS, "doc_pos long, text string")
    path = str(tmp_path / "corpus")
    write_corpus(corpus, path)
    write_corpus(corpus, path)
    assert spark.read.parquet(path).count() == 2 * len(DOCS)
    write_corpus(corpus, path, fresh=True)
    assert spark.read.parquet(path).count() == len(DOCS)


def test_export_frames_every_document(spark, tmp_path):
    corpus = spark.createDataFrame(DOCS, "doc_pos long, text string").repartition(3)
    path = str(tmp_path / "corpus_txt")
    export_corpus_text(corpus, path)
    parts = sorted(glob.glob(f"{path}/part-*"))
    text = "".join(open(p, encoding="utf-8").read() for p in parts)
    assert text == "".join(t + "\n\n" for _, t in DOCS)


def test_token_splits_and_meta(spark, tmp_path):
    tokens = spark.createDataFrame([(i, i % 5, "train" if i < 9 else "val") for i in range(10)],
                                   "pos long, token_id int, split string")
    path = str(tmp_path / "tokens")
    save_token_splits(tokens, path)
    val = load_split(spark, path, "val")
    assert [r["pos"] for r in val.collect()] == [9]
    assert load_split(spark, path, "train").count() == 9
    save_meta(spark, str(tmp_path / "meta"), 321, n_tokens=10)
    assert load_meta(spark, str(tmp_path / "meta")) == {"vocab_size": 321, "n_tokens": 10}


def test_tokenizer_save_load(spark, tmp_path):
    docs = spark.createDataFrame([(0, "aaab aaab abab ab ab ab")], "doc_id long, text string")
    model = B.train_bpe(docs, vocab_size=262)
    path = str(tmp_path / "tok")
    save_tokenizer(spark, model, path)
    back = load_tokenizer(spark, path)
    assert back.merges == model.merges
    merges_txt = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/merges.txt/part-*")))
    assert merges_txt == model.merges_txt()
    vocab_json = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/vocab.json/part-*")))
    assert B.BpeModel.from_files(vocab_json, merges_txt).merges == model.merges
