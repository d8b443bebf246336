import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textkiln.operators import next_token as N
from textkiln.operators import pretokens as P
from textkiln.operators import token_stream as S
from textkiln.sources.tables import load


@pytest.fixture(scope="module")
def stream(spark):
    s, vocab = S.pretoken_stream(load(spark, SF001, "documents", "doc_id", "text"))
    return s


def test_positions_are_dense_and_split_is_contiguous(spark, stream):
    toks = stream.tokens()
    agg = toks.agg(F.count(F.lit(1)), F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert agg[0] == stream.n_total == agg[3] and agg[1] == 0 and agg[2] == stream.n_total - 1
    summary = {r["split"]: r for r in stream.split_summary().collect()}
    assert summary["train"]["n_tokens"] + summary["val"]["n_tokens"] == stream.n_total
    assert summary["train"]["last_pos"] + 1 == summary["val"]["first_pos"] == stream.split_at == (9 * stream.n_total) // 10


def test_pairs_follow_stream(spark, stream):
    toks = {r["pos"]: r["token_id"] for r in stream.tokens().collect()}
    pairs = stream.pairs().collect()
    assert len(pairs) == stream.n_total - 2
    for r in pairs:
        assert toks[r["pos"]] == r["x"] and toks[r["pos"] + 1] == r["y"]


def test_windows_shift_by_one(spark, stream):
    toks = [r["token_id"] for r in stream.tokens().orderBy("pos").collect()]
    w = stream.windows(steps=3, batch=4, block=16, seed=7).collect()
    assert len(w) == 2 * 12
    small = stream.windows(steps=3, batch=4, block=16, seed=7, chunk_size=5)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, w))
    for r in w:
        base = 0 if r["split"] == "train" else stream.split_at
        n = stream.split_at if r["split"] == "train" else stream.n_total - stream.split_at
        assert 0 <= r["start"] < n - 16
        g = base + r["start"]
        assert list(r["x"]) == toks[g:g + 16] and list(r["y"]) == toks[g + 1:g + 17]


def test_chunks_are_the_stream_and_few_are_read(spark, stream):
    toks = [r["token_id"] for r in stream.tokens().orderBy("pos").collect()]
    store = {r["chunk"]: list(r["ids"]) for r in stream.chunks(100).collect()}
    assert store == {c: toks[100 * c : 100 * c + 100] for c in range(-(-len(toks) // 100))}
    plan = stream.windows(steps=1, batch=1, block=16)._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^\n]*In\(chunk, \[", plan)


@pytest.mark.parametrize("chunk_size", [2, 7, 256])
def test_sampled_loss_against_every_window(spark, stream, chunk_size):
    pairs = {r["pos"]: (r["split"], r["x"], r["y"]) for r in stream.pairs().collect()}
    c, cx = Counter(), Counter()
    for split, x, y in pairs.values():
        if split == "train":
            c[x, y] += 1
            cx[x] += 1
    loss = {p: -math.log((c[x, y] + 1) / (cx[x] + stream.vocab_size)) for p, (_, x, y) in pairs.items()}
    sums = defaultdict(list)
    for r in stream.window_starts(6, 4, 16, 5).collect():
        sums[r["split"], r["step"] // 3 * 250].append(sum(loss[p] for p in range(r["g0"], r["g0"] + 16)) / 16)
    got = N.sampled_loss(stream, 2, iters=3, batch=4, block=16, seed=5, chunk_size=chunk_size).collect()
    assert {(r["split"], r["step"]) for r in got} == set(sums) and len(got) == 4
    for r in got:
        want = sums[r["split"], r["step"]]
        assert r["n_windows"] == len(want) == 12 and abs(r["loss"] - sum(want) / len(want)) < 2e-6


def test_sampled_loss_needs_a_long_split(spark, stream):
    with pytest.raises(S.BlockTooLongError):
        N.sampled_loss(stream, 1, block=stream.n_total)


def test_block_too_long(spark, stream):
    with pytest.raises(S.BlockTooLongError):
        stream.windows(steps=1, batch=1, block=stream.n_total, seed=0)


def test_top_k_keeps_ties(spark):
    counts = spark.createDataFrame([(1, 10, 3), (1, 11, 2), (1, 12, 2), (1, 13, 1)], "x int, y int, c long")
    kept = sorted(r["y"] for r in N.top_k(counts, 2).collect())
    assert kept == [10, 11, 12]
    probs = {r["y"]: r["p"] for r in N.probabilities(N.top_k(counts, 2), 1.0).collect()}
    assert abs(sum(probs.values()) - 1) < 1e-12 and abs(probs[10] - 3 / 7) < 1e-12


def test_sampling_is_seeded_and_valid(spark):
    counts = spark.createDataFrame([(x, y, (x * y) % 5 + 1) for x in range(20) for y in range(6)], "x int, y int, c long")
    cum = N.cumulative(N.probabilities(N.top_k(counts, 4), 0.8))
    a = sorted(tuple(r) for r in N.sample(cum, 3).collect())
    b = sorted(tuple(r) for r in N.sample(cum, 3).collect())
    assert a == b and len(a) == 20
    kept = {(r["x"], r["y"]) for r in N.top_k(counts, 4).collect()}
    assert all(p in kept for p in a)


def test_generate_appends_sampled_tokens(spark):
    counts = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (3, 1, 5)], "x int, y int, c long")
    cum = N.cumulative(N.probabilities(N.top_k(counts, 40), 0.8))
    prompts = spark.createDataFrame([(7, [1]), (8, [2, 3]), (9, [4])], "pid long, ids array<int>")
    for most in (N.MAX_BROADCAST, 0):
        found = N.generate(prompts, cum, 5, seed=1, checkpoint_every=2, max_broadcast=most)
        out = {r["pid"]: list(r["new_ids"]) for r in found.collect()}
        assert out[7] == [2, 3, 1, 2, 3] and out[8] == [1, 2, 3, 1, 2] and out[9] == []


def _plain_walk(pid, ids, bounds, steps, seed):
    """The draw by its definition: the row whose bounds hold the target."""
    new, ctx = [], ids[-1] if ids else None
    for step in range(steps):
        if ctx not in bounds:
            break
        h = seed * 40503 + 12345
        for k in (pid, step, ctx):
            h = (h * 31 + k) % N.U_MOD
        u = ((h * N.U_MULT) % N.U_MOD) / N.U_MOD
        ctx = next(y for lo, hi, tot, y in bounds[ctx] if lo <= u * tot < hi)
        new.append(ctx)
    return new


def test_generate_like_a_plain_walk(spark):
    rows = [(x, y, (x * 7 + y * y) % 6) for x in range(30) for y in range(40)]
    counts = spark.createDataFrame([r for r in rows if r[2] and r[0] != 17], "x int, y int, c long")
    cum = N.cumulative(N.probabilities(N.top_k(counts, 9), 0.8))
    bounds = {}
    for r in cum.collect():
        bounds.setdefault(r.x, []).append((r.lo, r.hi, r.tot, r.y))
    prompts = [(i, [(i * 3) % 30] * (i % 4)) for i in range(200)] + [(900, None)]
    df = spark.createDataFrame(prompts, "pid long, ids array<int>")
    want = {p: _plain_walk(p, ids, bounds, 12, 3) for p, ids in prompts}
    for most in (N.MAX_BROADCAST, 0):
        assert {r.pid: list(r.new_ids) for r in N.generate(df, cum, 12, 3, 4, most).collect()} == want
    assert {len(w) for w in want.values()} >= {0, 12}


def test_registered_generation_like_a_plain_walk(spark):
    """generate_batch with its 8,000 entries and 200 steps on sf0.001."""
    from textkiln.plans import token_queries as Q
    from textkiln.plans.catalog import QUERIES

    Q.clear_caches()
    found = {r.pid: (r.n_prompt, r.new_ids) for r in QUERIES["generate_batch"](spark, SF001).collect()}
    model = Q._reloaded(spark, SF001)[1]
    pairs = Q._bpe_stream(spark, SF001).pairs()
    counts, bounds = {}, {}
    for r in pairs.where("split = 'train'").collect():
        own = counts.setdefault(r.x, {})
        own[r.y] = own.get(r.y, 0) + 1
    for x, own in counts.items():
        limit = sorted(own.values(), reverse=True)[: N.TOP_K][-1]
        top = max(own.values())
        weight = {y: (c / top) ** (1 / N.TEMPERATURE) for y, c in own.items() if c >= limit}
        total, at, bounds[x] = sum(weight.values()), 0.0, []
        for y in sorted(weight, key=lambda y: (-own[y], y)):
            bounds[x].append((at, at + weight[y] / total, y))
            at += weight[y] / total
    conv = load(spark, SF001, "conversations", "conv_id", "turn", "text").select((F.col("conv_id") * 1000 + F.col("turn")).alias("pid"), "text")
    prompts = {r.pid: list(r.ids) for r in Q.B.encode_texts(model, conv, "pid", F.col("text"), frame=False).collect()}
    assert set(prompts) == set(found)
    steps = 0
    for pid, ids in prompts.items():
        new = [int(t) for t in found[pid][1].split()]
        assert found[pid][0] == len(ids)
        ctx = ids[-1] if ids else None
        for step, token in enumerate(new):
            h = Q.SEED * 40503 + 12345
            for k in (pid, step, ctx):
                h = (h * 31 + k) % N.U_MOD
            u = ((h * N.U_MULT) % N.U_MOD) / N.U_MOD
            lo, hi = next((lo, hi) for lo, hi, y in bounds[ctx] if y == token)
            assert lo - 1e-9 <= u < hi + 1e-9
            ctx, steps = token, steps + 1
        assert len(new) == N.MAX_NEW_TOKENS or ctx not in bounds
    assert steps > 1000
    Q.clear_caches()


def test_loss_is_positive_and_val_higher(spark, stream):
    rows = {r["split"]: r for r in N.split_loss(stream.pairs(), stream.vocab_size).collect()}
    assert 0 < rows["train"]["loss"] < rows["val"]["loss"]


def test_documents_without_text_keep_their_row(spark):
    docs = spark.createDataFrame([(1, "one two one"), (2, None), (3, "")], "doc_id long, text string")
    vocab = S.pretoken_vocab(docs)
    ids = {r["doc_id"]: list(r["ids"]) for r in S.pretoken_ids(docs, vocab).collect()}
    assert set(ids) == {1, 2, 3} and ids[2] == [] and len(ids[1]) == 4 and len(ids[3]) == 1


def test_rare_words_join_back_to_their_rows(spark, monkeypatch):
    """A head of three short words: the rest goes through the join; null and empty texts, equal ids and split lists."""
    from textkiln.operators import token_stream as S

    monkeypatch.setattr(S, "HEAD_WORDS", 3)
    monkeypatch.setattr(S, "HEAD_BYTES", 4)
    monkeypatch.setattr(S, "PART_WORDS", 5)
    texts = ["a b a longest b", None, "", "rare a rarer a rarest", "a a a", "longest b rare"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stream, vocab = S.pretoken_stream(docs)
    assert stream.rare is not None
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    words = {r["doc_id"]: r["w"] for r in docs.where("text is not null").select("doc_id", P.pretokenize(F.concat("text", F.lit("\n\n"))).alias("w")).collect()}
    flat, want, ends = [], {}, []
    for i in range(len(texts)):
        row = [ids[w] for w in words.get(i, [])]
        want[i] = (len(row), len(flat), row)
        flat += row
    assert {r["doc_id"]: (r["n"], r["doc_start"], list(r["ids"])) for r in stream.docs.collect()} == want
    assert {r["doc_id"]: (r["first_id"], r["last_id"]) for r in stream.offsets.collect()} == {
        i: (row[0] if row else None, row[-1] if row else None) for i, (_, _, row) in want.items()}
    assert stream.n_total == len(flat)
    at = stream.split_at
    assert sorted((r["pos"], r["x"], r["y"]) for r in stream.pairs().collect()) == [
        (p, flat[p], flat[p + 1]) for p in range(len(flat) - 1) if p + 1 != at]


def test_no_join_of_occurrences_and_no_lambda_for_pairs(spark):
    from textkiln.operators import token_stream as S

    docs = load(spark, SF001, "documents")
    stream, _ = S.pretoken_stream(docs)
    assert stream.rare is None  # the head holds every word of a small corpus
    plan = stream.pairs()._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and "arrays_zip" in plan


def test_sampled_loss_lists_no_losses(spark, stream):
    """Losses are summed as they meet the window ends; none are gathered in lists."""
    plan = N.sampled_loss(stream, 2, iters=2, batch=4, block=16, seed=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
