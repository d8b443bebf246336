"""Mixing sources to target weights (operator 4), DataFrame functions only.

Every source gets a share of the mixture by weight, at most ``max_repeats``
times its own size; what the cap cuts off is reshared by weight.  A document's
copy number is then target / source size: its whole part is certain, and the
fractional parts are rounded by the pivotal method: two documents with
fractional probabilities meet, and a random one of the two possible transfers
of probability mass (weighted by size, so the words expected from the pair stay
exactly the same) makes one of them 0 or 1.  The transfers run as a reduction
tree: documents are dealt by hash into leaves of about ``leaf`` rows per
source, each leaf folds to one residual document, and the residuals form the
next level's leaves until one is left per source, which is rounded to the
nearer side.  A hot source is therefore many leaves, never one group.

Within a leaf larger documents meet first, so the residual that travels up
tends to be a small one and the source's total misses its target by little.
The coins are hashes of ``(seed, level, ids)``: reruns agree.

Edge cases: a null text or one without words has size 0 and takes 0; null is a
source of its own, the last one; rows alike in id, source and size (repeated or
null ids) are one class in the tree, whose copies are rounded as a whole and
then dealt to its rows as evenly as whole numbers allow; a source without
words has target 0; an empty table gives an empty result; only the named
columns are read.  The table of sources (a row each) is one window task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
LEAF = 32

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` of a table ``source, size``.

    Water filling in closed form: sorted by the level at which they are full,
    the first sources are capped and the others share the rest by weight."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    full = F.lit(float(cap)) * F.col("source_size")
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        per.withColumn("weight", weight.cast("double")).withColumn("full", full).withColumn("level", F.col("full") / F.col("weight"))
        .withColumn("spent", F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
    )
    # What this source and all after it would get by weight of what the earlier ones, full, leave.  It falls
    # once a source is counted as full that is not, so the largest that fits its own source is the level.
    ranked = ranked.withColumn("water", (F.col("total") - F.col("spent")) / F.col("open"))
    water = F.max(F.when(F.col("water") <= F.col("level"), F.col("water"))).over(everything)
    return ranked.withColumn("target", F.least("full", F.coalesce(water * F.col("weight"), F.col("full")))).select(
        "source", "source_size", "source_rows", "target")


def _uniform(*cols: Column) -> Column:
    """In [0, 1), from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _fold(seed: int, level: int) -> Column:
    """Pivotal rounding of the array ``leaf``: struct(done array, rest)."""

    def done(x, up):
        return F.struct(*[x[c].alias(c) for c in ("key", "doc_id", "size", "base", "same", "p")], up.alias("up"))

    def step(acc, x):
        r = acc["rest"]
        ratio = x["size"] / r["size"]
        rise = F.least(1 - r["p"], x["p"] * ratio)  # r up, x down
        fall = F.least(r["p"], (1 - x["p"]) * ratio)  # r down, x up
        up = _uniform(F.lit(seed), F.lit(level), r["key"], x["key"]) * (rise + fall) < fall
        p = F.when(up, r["p"] + rise).otherwise(r["p"] - fall)
        q = F.when(up, x["p"] - rise / ratio).otherwise(x["p"] + fall / ratio)
        # Which of the two is integral now: decided by the comparison, not by rounded sums.
        r_done = F.when(up, 1 - r["p"] <= x["p"] * ratio).otherwise(r["p"] <= (1 - x["p"]) * ratio)
        return F.struct(
            F.concat(acc["done"], F.array(F.when(r_done, done(r, up)).otherwise(done(x, ~up)))).alias("done"),
            F.when(r_done, x.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), q))))
            .otherwise(r.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))).alias("rest"),
        )

    first = F.element_at("leaf", 1)
    none = F.filter(F.array(done(first, F.lit(True))), lambda _: F.lit(False))
    return F.aggregate(F.slice("leaf", 2, F.greatest(F.size("leaf") - 1, F.lit(0))), F.struct(none.alias("done"), first.alias("rest")), step)


def _spread(classes: DataFrame, largest: int, piece: int = 4096) -> DataFrame:
    """A row for each of the ``same`` rows of a class, its ``copies`` dealt as
    evenly as whole numbers allow.  Large classes are dealt in pieces."""
    pieces = classes.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("same") - 1, F.lit(piece).cast("long"))))
    if largest > 256 * piece:
        pieces = pieces.repartition("doc_id", "source", "size", "_at")
    each = pieces.withColumn("_i", F.explode(F.sequence("_at", F.least(F.col("_at") + (piece - 1), F.col("same") - 1))))
    q = F.floor(F.col("copies") / F.col("same"))
    return each.withColumn("copies", q + (F.col("_i") < F.col("copies") - q * F.col("same")).cast("long")).drop("_at", "_i", "same")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
        leaf: int = LEAF, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    copies`` (0 to ``max_repeats``) and ``taken`` = copies * size."""
    narrow = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")), "mix-sizes")
    targets = source_targets(narrow, weights, share, max_repeats)
    copies = F.col("target") / F.col("source_size")
    # Rows alike in id, source and size (null ids, say) are one class, whose copies are rounded together.
    alike = narrow.groupBy("doc_id", "source", "size").agg(F.count("*").alias("same"))
    rows = alike.join(targets, alike["source"].eqNullSafe(targets["source"])).drop(targets["source"]).select(
        "doc_id", "source", "size", "source_size", "target", "source_rows", "same",
        F.when(F.col("source_size") > 0, copies * F.col("same")).otherwise(0.0).alias("c"))
    rows = rows.withColumn("base", F.floor("c")).withColumn("p", F.col("c") - F.floor("c"))
    rows = written(rows, "mix-rows")
    final = ["doc_id", "source", "size", "source_size", "target", "same"]
    certain = (F.col("size") == 0) | (F.col("p") <= 0)
    out = [rows.filter(certain).select(*final, F.col("base").alias("copies"))]
    most = rows.agg(F.max("source_rows")).first()[0] or 0
    level = 0
    todo = rows.filter(~certain).withColumn("key", F.xxhash64("doc_id", "size", F.lit(seed)))
    of_source = ["source", "source_size", "target"]
    while most > 0:
        leaves = max(1, math.ceil(most / leaf))
        # As many leaves for a source as its rows fill at this level.
        own = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / float(leaf ** (level + 1)))).cast("long")
        dealt = todo.groupBy(*of_source, "source_rows", F.pmod(F.xxhash64("key", F.lit(level)), own).alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("size", "key", "p", "doc_id", "base", "same")), asc=False).alias("leaf"))
        folded = written(dealt.select(*of_source, "source_rows", _fold(seed, level).alias("f")), f"mix-level-{level}")
        out.append(folded.select(*of_source, F.explode("f.done").alias("d")).select(
            "d.doc_id", "source", "d.size", "source_size", "target", "d.same", (F.col("d.base") + F.col("d.up").cast("long")).alias("copies")))
        todo = folded.select(*of_source, "source_rows", "f.rest.*")
        most, level = (leaves, level + 1) if leaves > 1 else (0, level)
    if level or len(out) > 1:
        out.append(todo.select(*final, (F.col("base") + (F.col("p") >= 0.5).cast("long")).alias("copies")))
    whole = _spread(reduce(DataFrame.unionByName, out), rows.agg(F.max("same")).first()[0] or 0)
    return whole.withColumn("copies", F.col("copies").cast("int")).withColumn("taken", F.col("copies").cast("long") * F.col("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it.

    Keyed by ``doc_id``; the texts are joined with the narrow copy numbers.
    Rows that repeat an id (or have none) get the largest number of them.  The
    column ``copy``, from 1, replaces one of that name."""
    key = options.get("doc_id", "doc_id")
    n = mix(docs, **options).select(F.col("doc_id").alias("_mix_id"), F.col("copies").alias("_mix_n")).filter("_mix_n > 0")
    n = n.groupBy("_mix_id").agg(F.max("_mix_n").alias("_mix_n"))
    return docs.join(n, docs[key].eqNullSafe(F.col("_mix_id"))).withColumn("copy", F.explode(F.sequence(F.lit(1), "_mix_n"))).drop("_mix_id", "_mix_n")
