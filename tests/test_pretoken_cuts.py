"""Tokens cut in one Arrow pass against the JVM's pattern, words merged together against one by one."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textkiln.functions.text import frame_document
from textkiln.operators import bpe as B
from textkiln.operators import pretokens as P
from textkiln.operators import token_stream as S

ODD = "aéZß1٣ \t\n\x0b\x85\xa0  '''sstdmrvel.,-😀𒀀́漢\x00 "


def odd_docs(spark):
    rnd = random.Random(5)
    texts = ["", None, " ", "\n", "'s", "''s", "x'll y'l", "'re've", " 's", "a 's'd", " 'm", *("".join(rnd.choices(ODD, k=rnd.randint(0, 40))) for _ in range(3000))]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def broken_docs(spark):
    rnd = random.Random(6)
    rows = [b"\xed\xa0\x80 a", b"a\xc3", b"\xf4\x90\x80\x80", b"\xc0\xaf", *(bytes(rnd.choices(range(256), k=rnd.randint(0, 20))) for _ in range(500))]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))


@pytest.mark.parametrize("made", [odd_docs, broken_docs])
def test_counts_are_those_of_the_pattern(spark, made):
    docs = made(spark)
    want, got = P.pretoken_counts(P.line_pretokens(docs)), P.line_pretoken_counts(docs)
    assert want.exceptAll(got).count() == 0 == got.exceptAll(want).count()


@pytest.mark.parametrize("frame", [True, False])
def test_documents_are_cut_as_by_the_pattern(spark, monkeypatch, frame):
    monkeypatch.setattr(P, "PART_BYTES", 2000)
    classes = np.frombuffer(P.char_classes(spark).value, np.uint8)
    for docs in (odd_docs(spark), broken_docs(spark)):
        body = frame_document("text") if frame else F.col("text")
        want = {r.doc_id: r.w or [] for r in docs.select("doc_id", P.pretokenize(body).alias("w")).collect()}
        batch = docs.select("doc_id", P.cuttable(body).alias("text")).toArrow().combine_chunks().to_batches()[0].slice(3)
        got, n = {}, 0
        for part, tokens in P.cut_parts(batch, classes, lines=False):
            got |= zip(part.column(0).to_pylist(), tokens.to_pylist(), strict=True)
            n += 1
        assert n > 1 and got == {k: w for k, w in want.items() if k >= 3}


def test_words_merged_together_equal_one_by_one(monkeypatch):
    monkeypatch.setattr(B, "PART_ROWS", 100)
    rnd = random.Random(7)
    ranks, symbols = {}, list(range(1, 7))
    while len(ranks) < 60:
        pair = rnd.choice(symbols), rnd.choice(symbols)
        if pair not in ranks:
            ranks[pair] = (len(ranks), 100 + len(ranks))
            symbols.append(100 + len(ranks) - 1)
    rows = [[], [1], [1] * 9, [2] * 60, *([rnd.randint(1, 6) for _ in range(rnd.randint(0, 70))] for _ in range(900))]
    syms = pa.array([[9], *rows], pa.list_(pa.int32())).slice(1)
    assert B._Merges(ranks).apply(syms).to_pylist() == [B._lowest_first(list(r), ranks) for r in rows]
    assert B._Merges({}).apply(syms).to_pylist() == rows
    assert B._Merges(ranks).apply(syms.slice(0, 0)).to_pylist() == []


def test_word_cache_keeps_what_occurs_again(monkeypatch):
    monkeypatch.setattr(B._encoder, "MOST", 3)
    ranks = {(B.BYTE_ID[97], B.BYTE_ID[98]): (0, 257)}
    encode = B._encoder(ranks)
    for words, counts in ((["ab", "é", "abab"], [2, 1, 5]), (["abab", "é", "c", "", "xab"], [1, 2, 2, 1, 9])):
        starts, sizes, ids = encode.many(pa.array(words), np.array(counts))
        got = [ids[a : a + n].tolist() for a, n in zip(starts, sizes, strict=True)]
        assert got == [B._lowest_first([B.BYTE_ID[b] for b in w.encode()], ranks) for w in words]
    assert encode.words.to_pylist() == ["ab", "abab", "é"] and encode("abab") == [257, 257]


def test_offsets_of_encoded_texts_write_no_arrays(spark):
    docs = spark.createDataFrame([(3, "ab ab"), (1, "ab"), (2, None)], "doc_id long, text string")
    stream = S.bpe_stream(B.BpeModel([(B.BYTE_ID[97], B.BYTE_ID[98], 257)]), docs)
    end = B.BYTE_ID[10]
    rows = [tuple(r) for r in stream.offsets.orderBy("doc_id").collect()]
    assert rows == [(1, 3, 0, 257, end), (2, 0, 3, None, None), (3, 5, 3, 257, end)]
    assert "_table" not in vars(stream)
    assert [tuple(r) for r in stream._table.select("doc_id", "n", "doc_start", "first_id", "last_id").orderBy("doc_id").collect()] == rows


def test_packed_symbols_come_back():
    rows = [[5], [], [1, 2, 70000], [], [3, 4]]
    packed = B._packed(pa.array([[9, 9], *rows, [8]], pa.list_(pa.int32())).slice(1, 5))
    assert B._unpacked(packed).to_pylist() == rows
    assert B._unpacked(packed.slice(2, 3)).to_pylist() == rows[2:]
    assert B._unpacked(packed.slice(0, 0)).to_pylist() == []
    batch = pa.record_batch([packed, pa.array([7, 1, 2, 1, 3])], names=["syms", "freq"])
    got = {(p // B.PAIR_SHIFT, p % B.PAIR_SHIFT): c for b in B._pairs([batch, batch.slice(1)]) for p, c in zip(*b.to_pydict().values(), strict=True)}
    assert got == {(1, 2): 2, (2, 70000): 2, (3, 4): 3}
