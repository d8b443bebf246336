"""Sampled loss from the windows' pairs alone, over ids packed as binary."""

import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textkiln.functions.text import frame_document
from textkiln.operators import next_token as N
from textkiln.operators import pretokens as P
from textkiln.operators import token_stream as S


def small_docs(spark):
    rnd = random.Random(3)
    texts = [None, "", "x", *(" ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 60))) for _ in range(60)), " ".join(rnd.choices("abcdefgh", k=900))]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_no_pair_of_the_stream_gets_a_row(spark, monkeypatch):
    """Losses of whole short documents, of steps between them and of one long one, with windows that overlap."""
    stream, _ = S.pretoken_stream(small_docs(spark))
    pairs = {r["pos"]: (r["split"], r["x"], r["y"]) for r in stream.pairs().collect()}
    c = Counter((x, y) for split, x, y in pairs.values() if split == "train")
    cx = Counter(x for split, x, _ in pairs.values() if split == "train")
    loss = {p: -math.log((c[x, y] + 1) / (cx[x] + stream.vocab_size)) for p, (_, x, y) in pairs.items()}
    sums = defaultdict(float)
    for r in stream.window_starts(4, 30, 40, 9).collect():
        sums[r["split"], r["step"] // 2 * 250] += sum(loss[p] for p in range(r["g0"], r["g0"] + 40))

    def rows(self):
        raise AssertionError("pairs of the whole stream")

    monkeypatch.setattr(S.IdStream, "pairs", rows)
    got = {(r["split"], r["step"]): r for r in N.sampled_loss(stream, 2, 2, 250, 30, 40, 9).collect()}
    assert set(got) == set(sums) and len(got) == 4
    for key, r in got.items():
        assert r["n_windows"] == 60 and abs(r["loss"] - sums[key] / (60 * 40)) < 2e-6


def test_filter_lets_pass_what_is_held_and_no_more_than_its_bits(spark):
    held = [N._key(x, x * 7 % 50) for x in range(50)] + [-1 - x for x in range(50)]
    bits = N._filter_bits(spark.createDataFrame([(k,) for k in held], "key long"))
    ids = np.arange(50, dtype=np.int32)
    ids[1::2] = ids[0::2] * 7 % 50  # pairs (x, 7 x) at even places
    batch = pa.record_batch([pa.array([0, 50], pa.int64()), S.packed_array(np.tile(ids, 2), np.array([0, 50, 100]))], names=["pos", "packed"])
    for most in (1, 7, 1000):
        found = Counter()
        for b in N._train_counts(bits, 76, most)([batch]):
            found.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
        # Pairs begin at 0 to 48 and 50 to 74: the last train position (75) starts none.
        at = [*range(49), *range(25)]
        want = Counter(N._key(int(ids[i]), int(ids[i + 1])) for i in at) + Counter(-1 - int(ids[i]) for i in at)
        own = set(N._bit(np.array(held)).tolist())
        assert found == {k: n for k, n in want.items() if int(N._bit(np.array([k]))[0]) in own}


def test_held_keys_are_summed(monkeypatch):
    monkeypatch.setattr(N, "HELD_KEYS", 10)
    rnd = random.Random(1)
    rows = [[(rnd.randrange(9 if i < 20 else 10**6), rnd.randrange(5)) for _ in range(8)] for i in range(40)]
    tables = (pa.table({"key": [k for k, _ in t], "n": [n for _, n in t]}) for t in rows)
    got, want = Counter(), Counter()
    for b in N._summed(tables):
        for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            got[k] += n
    for k, n in (kn for t in rows for kn in t):
        want[k] += n
    assert +got == +want and list(N._summed(iter([]))) == []


def test_words_of_many_parts_are_looked_up_together(spark, monkeypatch):
    docs = small_docs(spark)
    texts = docs.select("doc_id", "doc_id", P.cuttable(frame_document("text")).alias("text")).toArrow().rename_columns(["rid", "doc_id", "text"])
    want = {r["doc_id"]: r["w"] or [] for r in docs.select("doc_id", P.pretokenize(frame_document("text")).alias("w")).collect()}
    head = pa.array([" a", " b", "c"]), pa.array([5, 6, 7], pa.int32())
    known = dict(zip(head[0].to_pylist(), head[1].to_pylist(), strict=True))
    classes = P.char_classes(spark)
    for part_bytes, words in ((40, 1), (40, 500), (10**6, 1), (10**6, 10**6)):
        monkeypatch.setattr(S, "CACHED_BYTES", part_bytes)
        monkeypatch.setattr(S, "PART_WORDS", words)
        got = {}
        for b in S._lookup(SimpleNamespace(value=head), classes)(texts.to_batches(7)):
            flat, sizes = S.unpacked_array(b.column("ids"))
            ends = np.cumsum(sizes)
            for i, rid in enumerate(b.column("rid").to_pylist()):
                got[rid] = flat[ends[i] - sizes[i] : ends[i]].tolist(), b.column("rare")[i].as_py()
                assert b.column("n")[i].as_py() == sizes[i]
        assert got == {k: ([known.get(t, S.RARE) for t in w], [t for t in w if t not in known]) for k, w in want.items()}


@pytest.mark.parametrize("rows", [1, 2, 5, 100])
def test_lists_that_span_batches(rows):
    table = pa.table({"rid": [1, 1, 1, 1, 1, 1, 2, 5, 5, 9], "place": list(range(10))}).combine_chunks()
    got = [(r, p) for b in S._lists(iter(table.to_batches(rows))) for r, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert got == [(1, [0, 1, 2, 3, 4, 5]), (2, [6]), (5, [7, 8]), (9, [9])]
    assert list(S._lists(iter([]))) == []


def test_ids_are_packed_and_back(monkeypatch):
    lists = [[3, 1], None, [], [2**31 - 2], None, [7, 8, 9]]
    batch = pa.record_batch([pa.array(range(6)), pa.array([2, 0, 0, 1, 0, 3]), pa.array([0, 2, 2, 2, 3, 3]), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "n", "doc_start", "ids"])
    whole = [b for part in (batch.slice(0, 4), batch.slice(4)) for b in S._whole([part])]
    assert [v for b in whole for v in zip(b.column("first_id").to_pylist(), b.column("last_id").to_pylist(), strict=True)] == [(v[0], v[-1]) if v else (None, None) for v in lists]
    monkeypatch.setattr(S, "PART_PACKED", 4)
    back = S._unpacked(b.select(["doc_id", "packed"]).slice(1) for b in whole)
    assert [v for b in back for v in b.column("ids").to_pylist()] == [*lists[1:4], lists[5]]
