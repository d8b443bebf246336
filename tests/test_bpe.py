"""BPE against the installed `tokenizers` library (independent implementation)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textkiln.functions.bytelevel import BYTE_CHAR, BYTE_ID, to_bytelevel
from textkiln.operators import bpe as B
from textkiln.plans import token_queries as Q
from textkiln.plans.catalog import QUERIES, SMALL_ORACLES
from textkiln.sources.tables import load

tokenizers = pytest.importorskip("tokenizers")


def lib_train(texts, vocab_size):
    d = tempfile.mkdtemp(prefix="textkiln-bpe-")
    path = os.path.join(d, "corpus.txt")
    with open(path, "w", encoding="utf-8") as f:
        for t in texts:
            f.write(t + "\n\n")
    tk = tokenizers.ByteLevelBPETokenizer()
    tk.train(files=[path], vocab_size=vocab_size, min_frequency=2, special_tokens=["<|endoftext|>"], show_progress=False)
    tk.save_model(d)
    with open(os.path.join(d, "merges.txt"), encoding="utf-8") as f:
        merges = [l.rstrip("\n") for l in f][1:]
    return tk, merges


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def ours(spark, texts, vocab_size):
    return B.train_bpe(docs_of(spark, texts), vocab_size=vocab_size)


def test_alphabet_ids_follow_library(spark):
    tk, _ = lib_train(["abc abc"], 300)
    vocab = tk.get_vocab()
    for b in range(256):
        assert vocab[BYTE_CHAR[b]] == BYTE_ID[b]
    assert vocab["<|endoftext|>"] == 0


def test_tie_breaking(spark):
    texts = ["ab xy\nab xy\nab xy"]
    m = ours(spark, texts, 1000)
    _, lib = lib_train(texts, 1000)
    assert m.merges_txt().splitlines()[1:] == lib
    assert lib[:3] == ["a b", "x y", "Ġ xy"]


def test_min_frequency_stops(spark):
    m = ours(spark, ["abc"], 1000)
    assert m.merges == [] and m.vocab_size == 257


def test_overlapping_pairs_counted(spark):
    texts = ["aaa\naaa\naaa\nxy\nxy\nxy\nxy\nxy"]
    m = ours(spark, texts, 1000)
    _, lib = lib_train(texts, 1000)
    assert m.merges_txt().splitlines()[1:] == lib
    assert lib[0] == "a a"


def test_special_token_in_training_text_is_ordinary(spark):
    texts = ["<|endoftext|>"] * 50
    m = ours(spark, texts, 300)
    _, lib = lib_train(texts, 300)
    assert m.merges_txt().splitlines()[1:] == lib
    assert "endoftext" in m.tokens().values()


def test_trailing_blanks_depend_on_context(spark):
    texts = ["foo  \nbar"] * 50
    m = ours(spark, texts, 300)
    tk, lib = lib_train(texts, 300)
    assert m.merges_txt().splitlines()[1:] == lib
    probe = spark.createDataFrame([(0, "foo  \n"), (1, "foo  \nbar")], "k long, t string")
    enc = {r["k"]: r["ids"] for r in B.encode_texts(m, probe, "k", F.col("t"), frame=False).collect()}
    tok = m.tokens()
    assert [tok[i] for i in enc[0]] == ["foo", "ĠĠĊ"]
    assert [tok[i] for i in enc[1]] == ["foo", "Ġ", "Ġ", "Ċ", "bar"]
    assert list(enc[0]) == tk.encode("foo  \n").ids and list(enc[1]) == tk.encode("foo  \nbar").ids


def test_special_token_is_text_of_a_reloaded_tokenizer(spark, tmp_path):
    """A tokenizer loaded from its two files registers nothing as special."""
    from tokenizers import ByteLevelBPETokenizer

    m = ours(spark, ["ab ab ab"], 300)
    (tmp_path / "vocab.json").write_text(m.vocab_json(), encoding="utf-8")
    (tmp_path / "merges.txt").write_text(m.merges_txt(), encoding="utf-8")
    lib = ByteLevelBPETokenizer(str(tmp_path / "vocab.json"), str(tmp_path / "merges.txt"))
    text = "a<|endoftext|>b ab"
    df = spark.createDataFrame([(0, text)], "k long, t string")
    row = B.encode_texts(m, df, "k", F.col("t"), frame=False).select("ids", B.decode_ids(m, F.col("ids")).alias("d")).first()
    assert list(row["ids"]) == lib.encode(text).ids and 0 not in row["ids"] and row["d"] == text
    zero = df.select(B.decode_ids(m, F.array(F.lit(0))).alias("d")).first()["d"]
    assert zero == lib.decode([0], skip_special_tokens=True) == "<|endoftext|>"


def test_sf0001_parity_with_library(spark):
    docs = load(spark, SF001, "documents", "doc_id", "text")
    rows = docs.orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]
    m = B.train_bpe(docs, vocab_size=257 + 64)
    tk, lib = lib_train(texts, 257 + 64)
    assert m.merges_txt().splitlines()[1:] == lib
    assert tk.get_vocab() == {t: i for i, t in m.tokens().items()}
    enc = {r["doc_id"]: list(r["ids"]) for r in B.encode_documents(m, docs).collect()}
    for r in rows:
        assert enc[r["doc_id"]] == tk.encode(r["text"] + "\n\n").ids
    dec = B.encode_documents(m, docs).select("doc_id", B.decode_ids(m, F.col("ids")).alias("t")).collect()
    text_of = {r["doc_id"]: r["text"] for r in rows}
    assert all(r["t"] == text_of[r["doc_id"]] + "\n\n" for r in dec)


def test_file_forms_roundtrip(spark):
    m = ours(spark, ["ab ab ab cd cd cd"], 300)
    back = B.BpeModel.from_files(m.vocab_json(), m.merges_txt())
    assert back.merges == m.merges
    assert m.merges_txt().startswith("#version: 0.2\n")


def test_vocabulary_check():
    B.check_vocabulary(300, 300, 299)
    with pytest.raises(B.VocabularyMismatch):
        B.check_vocabulary(300, 321, 10)
    with pytest.raises(B.VocabularyMismatch):
        B.check_vocabulary(300, 300, 300)


def test_byte_ids_of_a_long_run_are_linear(spark):
    import time

    from textkiln.functions.bytelevel import BYTE_ID, utf8_byte_ids

    df = spark.createDataFrame([("a" * 1_000_000,), ("é\x00ß",), ("",)], "w string")
    began = time.time()
    rows = df.select("w", utf8_byte_ids(F.col("w")).alias("ids")).collect()
    assert time.time() - began < 30
    assert all(list(r["ids"]) == [BYTE_ID[b] for b in r["w"].encode()] for r in rows)


def test_bytelevel_roundtrip():
    from textkiln.functions.bytelevel import from_bytelevel

    s = "Grüße 😀 \x00\x7f\xad"
    assert from_bytelevel(to_bytelevel(s)) == s.encode("utf-8")
    assert all(c.isprintable() for c in to_bytelevel(s))


def test_registered_vocabulary_of_8000_matches_library(spark):
    """The registered queries train 8000 entries: merges, ids and figures as the library's."""
    rows = load(spark, SF001, "documents", "doc_id", "text").collect()
    Q.clear_caches()
    tk, lib = lib_train([r["text"] for r in sorted(rows)], 8000)
    merges = QUERIES["bpe_train"](spark, SF001).orderBy("rank").collect()
    text = {i: t for t, i in tk.get_vocab().items()}
    assert [f"{text[m.left_id]} {text[m.right_id]}" for m in merges] == lib and len(lib) == 8000 - 257
    assert [m.token for m in merges] == [text[m.new_id] for m in merges]
    want = {r["doc_id"]: tk.encode(r["text"] + "\n\n").ids for r in rows}
    assert {r.doc_id: list(r.ids) for r in QUERIES["encode_documents"](spark, SF001).collect()} == want
    n = sum(map(len, want.values()))
    meta = QUERIES["corpus_meta"](spark, SF001).first()
    assert (meta.vocab_size, meta.n_merges, meta.n_tokens, meta.n_train) == (8000, 8000 - 257, n, 9 * n // 10)
    assert {r.doc_id: r.text for r in QUERIES["decode_roundtrip"](spark, SF001).collect()} == {r["doc_id"]: r["text"] + "\n\n" for r in rows}
    Q.clear_caches()


@pytest.mark.parametrize("limits", [dict(head_rows=3), dict(head_rows=64, max_symbols=200), dict(max_symbols=1)])
def test_short_heads_and_few_segments_change_nothing(spark, limits):
    texts = ["the then there aaa aaaa aaaaa baab abab ababab the other thing\n über überall"] * 3 + ["ab xy", "xy ab aab xxy"]
    _, lib = lib_train(texts, 275)
    assert B.train_bpe(docs_of(spark, texts), 275, **limits).merges_txt().splitlines()[1:] == lib


# Not generate_batch, whose 200 steps take minutes.
@pytest.mark.parametrize("name", ["bpe_train", "encode_documents", "corpus_meta", "vocab_check", "bpe_chars_per_token"])
def test_small_vocabulary_matches_sql(spark, monkeypatch, name):
    import duckdb

    monkeypatch.setattr(Q, "TRAIN_VOCAB", Q.BPE_VOCAB)
    Q.clear_caches()
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    found = QUERIES[name](spark, SF001)
    want = con.execute(SMALL_ORACLES[name])
    assert found.columns == [c[0] for c in want.description]
    plain = lambda rows: sorted((tuple(list(v) if isinstance(v, (list, tuple)) else v for v in r) for r in rows), key=repr)
    assert plain(found.collect()) == plain(want.fetchall())
    Q.clear_caches()


def test_line_pattern_equals_reading_by_lines(spark):
    import random

    from textkiln.operators import pretokens as P

    rnd = random.Random(2)
    texts = ["", "\n", " \n x  \n\n  y", "it's 12  a\t\n", *("".join(rnd.choices("ab1.' \t\n\x0b\x85\xa0é", k=rnd.randint(0, 40))) for _ in range(400))]
    df = docs_of(spark, texts)
    lines = F.transform(F.slice(F.split(F.concat("text", F.lit("\n\n")), "\n", -1), 1, F.size(F.split(F.concat("text", F.lit("\n\n")), "\n", -1)) - 1), lambda s: F.concat(s, F.lit("\n")))
    want = df.select(F.explode(F.flatten(F.transform(lines, P.pretokenize))).alias("token"))
    got = P.line_pretokens(df)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_long_words_merge_like_the_library(spark):
    """One unbroken run of a million letters: encoded in seconds, the same ids."""
    import random
    import time

    rnd = random.Random(3)
    texts = ["".join(rnd.choices(["abra", "cad", "ab", "xyz", "aaa"], k=30)) for _ in range(60)]
    m = ours(spark, texts, 330)
    tk, lib = lib_train(texts, 330)
    assert m.merges_txt().splitlines()[1:] == lib
    ranks = {(l, r): (k, n) for k, (l, r, n) in enumerate(m.merges)}
    for size in (1, 47, 49, 200, 3000):
        word = "".join(rnd.choices("abcxyzrd", k=size))
        syms = [BYTE_ID[b] for b in word.encode()]
        assert B._queued(syms, ranks) == tk.encode(word).ids == B._lowest_first(syms, ranks)
    long = "".join(rnd.choices(["abra", "cad", "ab", "xyz", "aaa"], k=330_000))
    began = time.time()
    row = B.encode_texts(m, spark.createDataFrame([(0, long)], "k long, t string"), "k", F.col("t"), frame=False).first()
    assert time.time() - began < 60
    assert list(row["ids"]) == tk.encode(long).ids


def test_large_batches_are_encoded_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(B, "PART_WORDS", 4)
    docs = [[["ab", "c"]], None, [["ab"], ["c", "ab"]], [[]], [["c"] * 9], [["ab", "ab", "ab"]], [["c", "c"]]]
    batch = pa.record_batch({"k": pa.array(range(7)), "segs": pa.array(docs, pa.list_(pa.list_(pa.string())))}).slice(1)
    assert B._n_words(batch.column(1)).tolist() == [0, 3, 0, 9, 3, 2]

    class Ranks:
        value = {}

    whole = B._encode_batch(batch, B._encoder({})).to_pylist()
    cut = list(B._encode_batches_fn(Ranks)([batch]))
    assert [len(b) for b in cut] == [3, 1, 1, 1]
    assert pa.Table.from_batches(cut).to_pylist() == whole


def test_decode_is_one_pass_over_bytes(spark, monkeypatch):
    """Null rows, empty rows, broken UTF-8, every byte, unknown ids, several parts; no per-token JVM lambda."""
    import pyarrow as pa

    m = B.BpeModel([(BYTE_ID[195], BYTE_ID[164], 257)])
    rows = [(0, None), (1, []), (2, [257, BYTE_ID[98]]), (3, [BYTE_ID[195]]), (4, [0, 9999, BYTE_ID[0]]), (5, [BYTE_ID[b] for b in range(256)]),
            (6, [BYTE_ID[237], BYTE_ID[160], BYTE_ID[128]])]
    df = spark.createDataFrame(rows, "k long, ids array<int>")
    out = df.select("k", B.decode_ids(m, F.col("ids")).alias("t"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan
    got = {r["k"]: r["t"] for r in out.collect()}
    assert got[0] is None and got[1] == "" and got[2] == "äb" and got[3] == "�" and got[4] == "<|endoftext|>\x00"
    assert got[5] == bytes(range(256)).decode("utf-8", "replace")
    tokens = pa.array(B._token_bytes(m), pa.large_binary())
    ids = pa.array([r[1] for r in rows], pa.list_(pa.int32()))
    assert B._joined(ids.slice(1, 4), tokens).to_pylist() == B._joined(ids, tokens).to_pylist()[1:5]
