"""Count-based next-token model.

The reference scores the next token with a neural network; here the scores
are bigram counts of the train split, so the same table operators apply:
temperature, top-k that keeps ties, softmax, seeded sampling and repeated
generation with the context cropped to the model's window (one token for a
bigram model).  It does not claim the network's quality.

Loss (A10): ``p(y|x) = (c(x,y) + 1) / (c(x) + V)`` from train counts; the
mean of ``-ln p`` over every consecutive pair of a split (``split_loss``) or
over sampled windows at each evaluation step (``sampled_loss``).

Only observed successors are candidates for generation, so no operator emits
all ``V x V`` pairs.  Every aggregation is a partial + final hash aggregate;
Top-k ranks a context's distinct counts, and what follows works on classes of
equal counts, of which a context keeps at most k.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.operators.positions import group_offsets
from textkiln.operators.token_stream import BATCH_SIZE, BLOCK_SIZE, unpacked_array
from textkiln.session import cut_lineage, materialised

# Reference generation defaults.
TEMPERATURE = 0.8
TOP_K = 40
MAX_NEW_TOKENS = 200
# Successors of all contexts that generation sends to the tasks (12 bytes each).
MAX_BROADCAST = 4_000_000
# Integer hash for seeded uniforms in [0, 1), repeatable in any SQL engine.
U_MOD = 1000003
U_MULT = 2654435761
# Batches of an evaluation and steps between two of them.
EVAL_ITERS = 50
EVAL_INTERVAL = 250
# Losses are summed in whole units of this part of a nat.
LOSS_UNIT = 1_000_000
# Positions whose pairs are counted at once (each takes some 100 bytes meanwhile).
PART_POSITIONS = 250_000
# Keys and their counts that a task sums before it sends them.
HELD_KEYS = 4_000_000
# Size of the filter of the windows' pairs (16 MB), and Knuth's multiplier for 64 bits.
FILTER_BITS, FILTER_MULT = 27, 0x9E3779B97F4A7C15


def seeded_uniform(*keys: Column, seed: int = 0) -> Column:
    """Deterministic value in ``[0, 1)`` from integer keys."""
    h = F.lit(seed).cast("long") * 40503 + 12345
    for k in keys:
        h = (h * 31 + k.cast("long")) % U_MOD
    return ((h * U_MULT) % U_MOD).cast("double") / U_MOD


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """``(x, y, c)`` over the train split."""
    return pairs.where(F.col("split") == "train").groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))


def _context_counts(pairs: DataFrame) -> DataFrame:
    """``(x, cx)``: train pairs of every context of either split.  Counted from
    the pairs, whose partial sums by context are small, not from the counts of
    ``(x, y)``, which would be aggregated a second time."""
    return pairs.groupBy("x").agg(F.count_if(F.col("split") == "train").alias("cx"))


def split_loss(pairs: DataFrame, vocab_size: int) -> DataFrame:
    """A10: ``(split, n_pairs, loss)`` with add-one smoothing over ``V``.

    One aggregate per ``(x, y)`` counts both splits (``c`` train, ``m_val``
    val), so no self-join on ``(x, y)`` is needed; the per-context train total
    has one row per context and joins back as its size allows."""
    is_train = F.col("split") == "train"
    g = pairs.groupBy("x", "y").agg(
        F.count_if(is_train).alias("c"), F.count_if(~is_train).alias("m_val"),
    )
    scored = g.join(_context_counts(pairs), "x")
    nll = -F.log((F.col("c") + 1) / (F.col("cx") + F.lit(vocab_size)))
    t = scored.agg(
        F.sum("c").alias("n_train"), F.sum(nll * F.col("c")).alias("tot_train"),
        F.sum("m_val").alias("n_val"), F.sum(nll * F.col("m_val")).alias("tot_val"),
    )
    rows = t.select(F.explode(F.array(
        F.struct(F.lit("train").alias("split"), F.col("n_train").alias("n_pairs"), F.col("tot_train").alias("tot")),
        F.struct(F.lit("val").alias("split"), F.col("n_val").alias("n_pairs"), F.col("tot_val").alias("tot")),
    )).alias("r")).select("r.*")
    return rows.where(F.col("n_pairs") > 0).select(
        "split", "n_pairs", F.round(F.col("tot") / F.col("n_pairs"), 6).alias("loss")
    )


def _key(x, y):
    """A pair's key; ``-1 - x`` is its context's."""
    return x * 2**32 + y


def _bit(keys: np.ndarray) -> np.ndarray:
    """The bit of each key in a filter of ``2**FILTER_BITS`` bits."""
    return (keys.view(np.uint64) * np.uint64(FILTER_MULT)) >> np.uint64(64 - FILTER_BITS)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``(pos, packed)``: positions and sizes of the runs, and all their ids."""
    ids, sizes = unpacked_array(batch.column(1))
    return batch.column(0).to_numpy(), sizes, ids


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and how often each occurs, by sorting (faster here than a hash table)."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.append(np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]))
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _in_windows(starts, block: int, most: int):
    """``(pos, packed)`` -> ``(key, slot, m)``: how often the windows of a slot hold a pair,
    counted over ``most`` positions of windows at once (or one window's)."""

    def run(batches):
        g0, slots = starts.value
        for batch in batches:
            pos, sizes, ids = _flat(batch)
            last = pos + np.maximum(sizes - 1, 0)  # a run's pairs are at [pos, last)
            low, high = np.searchsorted(g0, pos - block, "right"), np.searchsorted(g0, last)
            met = np.maximum(high - low, 0)
            offsets, reach = np.cumsum(sizes) - sizes, np.minimum(sizes, block)
            for rows in _ranges(met * reach, most):
                # A run that alone meets more windows than that is taken some windows at a time.
                first, n = low[rows], met[rows]
                step = max(most // max(block, 1), 1) if rows.stop - rows.start == 1 else max(int(n.max(initial=0)), 1)
                for skip in range(0, int(n.max(initial=0)), step):
                    taken = np.clip(n - skip, 0, step)
                    run = np.repeat(np.arange(rows.start, rows.stop), taken)
                    window = _spread(first + skip, taken)
                    begin = np.maximum(g0[window], pos[run])
                    length = np.minimum(g0[window] + block, last[run]) - begin
                    at = _spread(offsets[run] + begin - pos[run], length)
                    x, y = ids[at].astype(np.int64), ids[at + 1].astype(np.int64)
                    found = pa.table({"key": _key(x, y), "slot": np.repeat(slots[window], length)}).group_by(["key", "slot"], use_threads=False).aggregate([([], "count_all")])
                    yield from found.rename_columns(["key", "slot", "m"]).to_batches()

    return run


def _ranges(sizes: np.ndarray, most: int):
    """Slices of rows whose ``sizes`` sum to ``most`` at most, or of one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield slice(start, stop)
        start = stop


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each, ``n`` values."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _train_counts(bits, split_at: int, most: int):
    """``(pos, packed)`` -> ``(key, n)``: pairs and contexts of the train split whose bits are
    set, counted over ``most`` positions at once."""

    def run(batches):
        table = np.frombuffer(bits.value, np.uint8)

        def wanted(keys):
            bit = _bit(keys).view(np.int64)
            return np.take(table, bit >> 3, mode="clip") >> (bit & 7).astype(np.uint8) & 1 != 0

        for batch in batches:
            pos, sizes, ids = _flat(batch)
            # The last train position starts no pair.
            inner = np.clip(split_at - 1 - pos, 0, np.maximum(sizes - 1, 0))
            pair = np.repeat(np.tile([True, False], len(sizes)), np.stack([inner, sizes - inner], 1).ravel())
            for start in range(0, len(ids), most):
                at = np.flatnonzero(pair[start:start + most]) + start
                x, y = ids[at].astype(np.int64), ids[at + 1].astype(np.int64)
                keys = _key(x, y)
                for keys, n in (_counted(keys[wanted(keys)]), _counted(-1 - x)):
                    kept = wanted(keys)
                    yield pa.table([pa.array(keys[kept]), pa.array(n[kept])], names=["key", "n"])

    return lambda batches: _summed(run(batches))


def _summed(tables):
    """Batches of ``(key, n)``, a key's rows of several tables summed to one."""
    held, size = [], 0
    for table in chain(tables, [None]):
        if table is not None:
            held.append(table)
            size += len(table)
        if held and (table is None or size > HELD_KEYS):
            whole = pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")])
            whole = whole.select(["key", "n_sum"]).rename_columns(["key", "n"])
            held, size = [whole], len(whole)
            if table is None or size > HELD_KEYS // 2:
                yield from whole.to_batches()
                held, size = [], 0


def _filter_bits(keys: DataFrame):
    """Broadcast of a filter with the bits of all ``keys`` set: one that is not
    among them passes only where it shares another's bit."""

    def hashed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bit(batch.column(0).to_numpy())).astype(np.int64))], names=["h"])

    words = keys.mapInArrow(hashed, "h long").groupBy(F.shiftright("h", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(h & 63 AS INT)))").alias("bits"))
    rows = words.toArrow()
    table = np.zeros(2**FILTER_BITS // 64, np.int64)
    table[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.astype("<i8").tobytes())


def window_losses(runs: DataFrame, starts: DataFrame, block: int, split_at: int, vocab_size: int, most: int) -> DataFrame:
    """``(slot, units)``: the losses of all pairs in the windows ``starts(slot, g0)``, each as often
    as windows hold it, under the train counts with add-one smoothing.  They are whole millionths
    of a nat, so that sums are exact whatever the order of adding.

    The windows' pairs, as many as the parameters ask for, are found first; of the train
    split's pairs, all of which are read, only those that may be among them are then counted."""
    spark = runs.sparkSession
    rows = starts.orderBy("g0").toArrow()
    windows = spark.sparkContext.broadcast((rows["g0"].to_numpy(), rows["slot"].to_numpy()))
    found = runs.mapInArrow(_in_windows(windows, block, most), "key long, slot int, m long")
    held = materialised(found.groupBy("key", "slot").agg(F.sum("m").alias("m")), "window-pairs")
    context = (-1 - F.shiftright("key", 32)).alias("context")
    bits = _filter_bits(held.select(F.explode(F.array("key", context)).alias("key")))
    counted = runs.where(F.col("pos") < split_at - 1).mapInArrow(_train_counts(bits, split_at, most), "key long, n long")
    counts = materialised(counted.groupBy("key").agg(F.sum("n").alias("n")), "window-counts")
    pairs = counts.where("key >= 0").select("key", F.col("n").alias("c"))
    contexts = counts.where("key < 0").select(F.col("key").alias("context"), F.col("n").alias("cx"))
    c, cx = (F.coalesce(name, F.lit(0)) for name in ("c", "cx"))
    nll = F.round(-F.log((c + 1) / (cx + F.lit(vocab_size))) * LOSS_UNIT).cast("long")
    scored = held.select("*", context).join(pairs, "key", "left").join(contexts, "context", "left")
    return scored.groupBy("slot").agg(F.sum(nll * F.col("m")).alias("units"))


def sampled_loss(stream, evals: int, iters: int = EVAL_ITERS, interval: int = EVAL_INTERVAL, batch: int = BATCH_SIZE,
                 block: int = BLOCK_SIZE, seed: int = 0, chunk_size: int = PART_POSITIONS) -> DataFrame:
    """A10: ``(split, step, n_windows, loss)``, the mean loss over ``iters`` batches
    of sampled windows per split at each of ``evals`` evaluation steps.

    A batch's windows may overlap; a pair counts once for each that holds it.  Tasks
    work on ``chunk_size`` positions at once."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    at = F.floor(F.col("step") / iters)
    slot = (at * 2 + F.when(F.col("split") == "val", 1).otherwise(0)).cast("int").alias("slot")
    starts = stream.window_starts(evals * iters, batch, block, seed).select("split", (at * interval).cast("long").alias("step"), slot, "g0")
    losses = window_losses(stream.runs(), starts.select("slot", "g0"), block, stream.split_at, stream.vocab_size, chunk_size)
    groups = starts.groupBy("split", "step", "slot").agg(F.count(F.lit(1)).alias("n_windows"))
    return groups.join(losses, "slot").select("split", "step", "n_windows", F.round(F.col("units") / (F.col("n_windows") * block * LOSS_UNIT), 6).alias("loss"))


def top_k(counts: DataFrame, k: int = TOP_K, vocab_size: int | None = None) -> DataFrame:
    """Per context keep successors whose score is within the top ``k``
    values, ties at the k-th value kept (``rank``, not ``row_number``)."""
    kk = min(k, vocab_size) if vocab_size else k
    # Ranked are a context's distinct counts, not its rows: however many
    # successors tie, a rank needs only how many rows lie above a count.
    w = Window.partitionBy("x").orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = counts.groupBy("x", "c").agg(F.count(F.lit(1)).alias("n"))
    kept = levels.withColumn("above", F.coalesce(F.sum("n").over(w), F.lit(0))).where(F.col("above") < kk)
    least = kept.groupBy("x").agg(F.min("c").alias("least"))
    return counts.join(least, "x").where(F.col("c") >= F.col("least")).select(*counts.columns)


def probabilities(kept: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """``p = softmax(logit / T)`` over the kept successors, with
    ``logit = ln(c / c(x))`` (shift by the context maximum for stability).

    Successors with equal counts share one probability, and top-k leaves at
    most ``k`` different counts per context, however many successors tie: the
    window holds at most ``k`` rows a context."""
    classes = kept.groupBy("x", "c").agg(F.count(F.lit(1)).alias("n"))
    # In order of count, so that every evaluation sums alike: ``p`` is a join key.
    w = Window.partitionBy("x").orderBy("c").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scaled = (F.log(F.col("c")) - F.log(F.max("c").over(w))) / F.lit(temperature)
    weighted = classes.withColumn("wt", F.exp(scaled))
    shares = weighted.select("x", "c", (F.col("wt") / F.sum(F.col("n") * F.col("wt")).over(w)).alias("p"))
    return kept.join(shares, ["x", "c"])


def cumulative(probs: DataFrame) -> DataFrame:
    """Adds ``lo``/``hi`` cumulative bounds in order ``(p desc, y)`` and the
    context total ``tot``; a draw ``u`` picks the row with ``lo <= u*tot < hi``.

    The window again runs over classes of equal ``p``; the rank of ``y`` inside
    its class comes from balanced range partitions, so a context whose many
    successors tie is not one task."""
    mass = F.col("n") * F.col("p")
    w = Window.partitionBy("x").orderBy(F.col("p").desc())
    classes = probs.groupBy("x", "p").agg(F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("below", F.coalesce(F.sum(mass).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    classes = classes.withColumn("tot", F.max(F.col("below") + mass).over(Window.partitionBy("x")))
    ranked = group_offsets(probs, ["x", "p"], ["y"], out="i").join(classes, ["x", "p"])
    return ranked.select(
        *probs.columns, "tot",
        (F.col("below") + F.col("i") * F.col("p")).alias("lo"),
        (F.col("below") + (F.col("i") + 1) * F.col("p")).alias("hi"),
    )


def sample(cum: DataFrame, seed: int = 0) -> DataFrame:
    """One draw per context: ``(x, y)``."""
    target = seeded_uniform(F.col("x"), seed=seed) * F.col("tot")
    return cum.where((F.col("lo") <= target) & (target < F.col("hi"))).select("x", "y")


def candidates(cum: DataFrame) -> DataFrame:
    """One row per context: ``(x, ys, his)``, its successors in draw order with
    their upper bounds.  A context has at most as many as the vocabulary."""
    drawn = F.sort_array(F.collect_list(F.struct("hi", "y")))
    return cum.groupBy("x").agg(drawn.alias("d")).select("x", F.col("d.y").alias("ys"), F.col("d.hi").alias("his"))


def _uniforms(seed: int, *keys: np.ndarray) -> np.ndarray:
    """``seeded_uniform`` over arrays."""
    h = np.int64(seed * 40503 + 12345)
    for k in keys:
        h = np.fmod(h * 31 + k.astype(np.int64), U_MOD)
    return np.fmod(h * U_MULT, U_MOD) / U_MOD


def _walk(model: tuple[np.ndarray, ...], pids: np.ndarray, ctx: np.ndarray, live: np.ndarray, steps: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens drawn after each context, and how many: all prompts of a batch
    take a step at once, each by binary search in its context's bounds."""
    xs, starts, ys, his = model
    out, count = np.zeros((len(pids), steps), np.int32), np.zeros(len(pids), np.int64)
    ctx, active = ctx.astype(np.int64), np.flatnonzero(live)
    for step in range(steps):
        at = np.minimum(np.searchsorted(xs, ctx[active]), max(len(xs) - 1, 0))
        known = xs[at] == ctx[active] if len(xs) else np.zeros(len(active), bool)
        active, at = active[known], at[known]
        if not len(active):
            break
        low, end = starts[at], starts[at + 1]
        target = _uniforms(seed, pids[active], np.int64(step), ctx[active]) * his[end - 1]
        high = end - 1  # the last bound is above every target
        while (low < high).any():
            mid = (low + high) // 2
            above = his[mid] > target
            low, high = np.where(above | (low >= high), low, mid + 1), np.where(above, mid, high)
        ctx[active] = out[active, step] = ys[low]
        count[active] += 1
    return out, count


def _walker(model, steps: int, seed: int):
    def run(batches):
        for whole in batches:
            for batch in (whole.slice(i, 4096) for i in range(0, len(whole), 4096)):
                held = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3)]
                out, count = _walk(model.value, held[0], held[1], held[2], steps, seed)
                flat = out[np.arange(steps) < count[:, None]]
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                new = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), new], names=["pid", "ids", "new_ids"])

    return run


def generate(
    prompts: DataFrame,
    cum: DataFrame,
    max_new_tokens: int = MAX_NEW_TOKENS,
    seed: int = 0,
    checkpoint_every: int = 10,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """W10 for all prompts at once: ``prompts(pid, ids array<int>)`` ->
    ``(pid, ids, new_ids)``; a context with no observed successor stops.

    The model is one row per context (``candidates``), written once.  With at most
    ``max_broadcast`` successors in all it is sent to the tasks, and a prompt takes all its
    steps in one pass.  A larger one stays a table: each step joins every prompt to its
    context's row, and lineage is cut every few steps with reliable checkpoints."""
    spark = prompts.sparkSession
    table = materialised(candidates(cum), "candidates")
    last = F.coalesce(F.try_element_at("ids", F.lit(-1)), F.lit(-1))
    state = prompts.select("pid", "ids", last.cast("long").alias("ctx"), F.coalesce(F.size("ids") > 0, F.lit(False)).alias("live"))
    size = table.agg(F.sum(F.size("ys"))).first()[0] or 0
    if size <= max_broadcast:
        rows = table.orderBy("x").toArrow().combine_chunks()
        ys, his = (rows[c].combine_chunks() for c in ("ys", "his"))
        starts = np.concatenate([[0], np.cumsum(ys.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        model = rows["x"].to_numpy().astype(np.int64), starts, ys.flatten().to_numpy(), his.flatten().to_numpy()
        schema = T.StructType([prompts.schema["pid"], prompts.schema["ids"], T.StructField("new_ids", T.ArrayType(T.IntegerType()))])
        return state.mapInArrow(_walker(spark.sparkContext.broadcast(model), max_new_tokens, seed), schema)
    state = state.withColumn("new_ids", F.array().cast("array<int>"))
    for step in range(max_new_tokens):
        target = seeded_uniform(F.col("pid"), F.lit(step), F.col("ctx"), seed=seed) * F.element_at("his", -1)
        drawn = F.element_at("ys", F.size(F.filter("his", lambda h: h <= target)) + 1).cast("int")
        joined = state.join(table, (state["ctx"] == table["x"]) & state["live"], "left").withColumn("_y", F.when(F.col("x").isNotNull(), drawn))
        state = joined.select(
            "pid", "ids", F.coalesce(F.col("_y").cast("long"), "ctx").alias("ctx"), (F.col("live") & F.col("_y").isNotNull()).alias("live"),
            F.when(F.col("_y").isNotNull(), F.array_append("new_ids", F.col("_y"))).otherwise(F.col("new_ids")).alias("new_ids"))
        if (step + 1) % checkpoint_every == 0:
            state = cut_lineage(state)
    return state.select("pid", "ids", "new_ids")
