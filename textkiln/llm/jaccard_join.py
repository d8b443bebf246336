"""N-gram Jaccard join with adaptive multi-match prefixes (operator 7).

A document is the set of its distinct word n-grams, as 64-bit hashes; documents
link when 100 * |intersection| >= 85 * |union|.  The result is each document's
connected component, exact up to hash collisions.

1. Documents of equal sets (a 128-bit digest) are one class; its smallest id
   goes on alone.  Copies never become pairs.
2. In any common order of n-grams, two linked sets share l n-grams among the
   first |x| - ceil(0.85 |x|) + l of each.  The order is frequent n-grams last
   (those in the leading zones of more than ``RARE`` documents), then by hash, so
   each document's prefix is lengthened past its frequent n-grams.  The number l
   is chosen for each document by its estimated candidate cost, the summed
   document frequencies in its prefix: costly documents have longer prefixes
   and ask for more shared n-grams before a pair is a candidate.
3. N-grams in the prefixes of up to ``RARE_BUCKET`` documents give candidate
   pairs, counted by pair.  The documents of larger buckets are compared with
   one leader for each bucket, the document with the fewest n-grams of its own;
   then only members in different components are compared, in blocks of bit
   sketches, and no pair becomes a row unless its sketches allow a link.
4. A candidate passes two exact filters, set sizes and the parity sketch (the
   differing bits are a lower bound of the sets' difference), and is then
   verified on the whole sets.
5. Components are smallest labels, spread along links with pointer jumps.

Each step is a written table; nothing is collected to the driver.

Edge cases: a null, empty or blank text has no n-grams, links with nothing and is
its own component; a text of fewer words than n is one n-gram, its whole
sequence; rows that repeat an id hold one text, and each gets the same result;
rows without an id link with nothing and have no component (null); an empty table
gives an empty result; only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import Tables, slices, utf8_parts

WORDS = 4
PERCENT = 85
RARE = 32  # documents whose leading zones may hold an n-gram that counts as rare
RARE_BUCKET = 64  # documents in a bucket that is paired directly
BLOCK = 256  # documents of a sketch block
SLICE = 1 << 20

_U = np.uint64
_BYTE = np.random.default_rng(4477).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and its inverse, kept as long as texts need."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, one after another, and their offsets."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    up, down = _Powers.of(len(data))
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    begin = np.flatnonzero(~space & before)
    end = np.flatnonzero(space & ~before)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up, dtype=np.uint64)])
    word = _mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    owner = np.searchsorted(starts, begin, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    odd = [_U(0xD6E8FEB86659FD93 + 0x1000002 * j) for j in range(words)]
    n = max(len(word) - words + 1, 0)
    h = np.zeros(n, np.uint64)
    for j in range(words):
        h = _mixed(h + word[j : j + n] * odd[j])
    whole = owner[:n] == owner[words - 1 : words - 1 + n]
    grams, of = [h[whole]], [owner[:n][whole]]
    for k in range(1, words):  # texts of fewer words are one n-gram of all of them
        short = np.flatnonzero(count == k)
        h = np.full(len(short), _U(k))
        for j in range(k):
            h = _mixed(h + word[first[short] + j] * odd[j])
        grams.append(h)
        of.append(short)
    h, of = np.concatenate(grams).view(np.int64), np.concatenate(of)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])


def base_prefix(n: int, percent: int = PERCENT) -> int:
    """n-grams of which a linked set must hold one."""
    return n - (-(-percent * n // 100)) + 1 if n else 0


def sketch(grams: np.ndarray) -> bytes:
    """A bit for each hash value, flipped by each n-gram that has it."""
    bits = 1 << min(13, max(8, int(len(grams) - 1).bit_length()))
    flipped = (np.bincount(grams & (bits - 1), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(flipped, bitorder="little").tobytes()


def _folded(s: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        s = (s >> bits) ^ (s & ((1 << bits) - 1))
    return s


def most_difference(a: int, b: int, percent: int = PERCENT) -> int:
    """Size of the symmetric difference up to which sets of these sizes link."""
    shared = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * shared


def may_link(a: bytes, b: bytes, n: int, m: int, percent: int = PERCENT) -> bool:
    """Whether the sketches allow a link; never false for linked sets."""
    bits = 8 * min(len(a), len(b))
    x = _folded(int.from_bytes(a, "little"), 8 * len(a), bits) ^ _folded(int.from_bytes(b, "little"), 8 * len(b), bits)
    return x.bit_count() <= most_difference(n, m, percent)


def _sets(words: int, percent: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                grams, offsets = shingle_sets(utf8_parts(batch.column(1)), words)
                n = np.diff(offsets)
                digests, sketches, zones, size = [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = grams[a:b]
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    sketches.append(sketch(own) if b > a else b"")
                    zone = min(b - a, 2 * base_prefix(b - a, percent) + 6)
                    zones.append(own[:zone])
                    size.append(zone)
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                zone = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *zones])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n), pa.array(both[:, 0]), pa.array(both[:, 1]), zone, pa.array(sketches, pa.binary())],
                    names=["doc_id", "n", "d1", "d2", "zone", "sketch"])

    return run


def matches_asked(cost: int) -> int:
    """Shared prefix n-grams that a document of this candidate cost asks for."""
    return 1 if cost <= 2 else min(8, 1 + int(math.log2(cost)))


def _prefixes(percent: int):
    """Per document ``doc_id, n, found`` (zone positions, n-grams and document
    frequencies, where two or more) to prefix rows ``t, doc_id, n, l, own``; a
    document whose zone is too short for its prefix gives one row with l = 0."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, n, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "found")), strict=True):
                found = sorted({(f["pos"], f["t"], f["df"]) for f in found})
                p = base_prefix(n, percent)
                zone = min(n, 2 * p + 6)
                own = zone - len(found)  # n-grams that only this document has
                frequent = [pos for pos, _, df in found if df > RARE]
                cost, at = 0, 0
                for pos, _, df in found:
                    if df <= RARE and pos - at < p:
                        cost += df - 1
                    at += df > RARE
                rare = zone - len(frequent)
                if rare >= p:
                    need = min(rare, p + matches_asked(cost) - 1)
                    skipped = 0
                    for pos, t, df in found:
                        if df > RARE:
                            skipped += 1
                        elif pos - skipped < need:
                            out.append((t, doc, n, need - p + 1, own))
                elif zone == n:
                    rest = sorted((df, t) for _, t, df in found if df > RARE)[: p - rare]
                    out += [(t, doc, n, 1, own) for t in [t for _, t, df in found if df <= RARE] + [t for _, t in rest]]
                else:
                    out.append((0, doc, n, 0, own))
            yield _table(out, ("t", "doc_id", "n", "l", "own"))

    return run


def _table(rows: list[tuple], names: tuple) -> pa.RecordBatch:
    x = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(len(names))], names=list(names))


def _all_grams(words: int):
    """(doc_id, text, n, own) to one row for each n-gram."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                grams, offsets = shingle_sets(utf8_parts(batch.column(1)), words)
                count = np.diff(offsets)
                rest = [pa.array(np.repeat(batch.column(c).to_numpy(), count)) for c in ("doc_id", "n", "own")]
                yield pa.RecordBatch.from_arrays([pa.array(grams), *rest], names=["t", "doc_id", "n", "own"])

    return run


def _long_prefixes(percent: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, n, own, grams in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "own", "grams")), strict=True):
                order = sorted({(g["df"], g["t"]) for g in grams})[: base_prefix(n, percent)]
                out += [(t, doc, n, 1, own) for _, t in order]
            yield _table(out, ("t", "doc_id", "n", "l", "own"))

    return run


def _sketched(percent: int):
    """Pairs with both sketches to the pairs that may link."""

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("sx", "sy", "nx", "ny")]
            keep = [may_link(a, b, n, m, percent) for a, b, n, m in zip(*cols, strict=True)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(percent: int):
    """Pairs with both whole sets to the linked pairs."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("gx"), batch.column("gy"), strict=True):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _blocks_compared(percent: int):
    """A row holds the members of two sketch blocks (structs); pairs of
    different components that may link come out."""

    def run(batches):
        for batch in batches:
            out = []
            for same, left, right in zip(*(batch.column(c).to_pylist() for c in ("same", "left", "right")), strict=True):
                left.sort(key=lambda m: m["doc_id"])
                right.sort(key=lambda m: m["doc_id"])
                # One matrix of bits: all sketches folded to the shortest one.
                bits = 8 * min(len(m["sketch"]) for m in left + right)
                a, b = (np.array([np.frombuffer(_folded(int.from_bytes(m["sketch"], "little"), 8 * len(m["sketch"]), bits).to_bytes(bits // 8, "little"), np.uint64) for m in ms]) for ms in (left, right))
                na, nb = (np.array([m["n"] for m in ms]) for ms in (left, right))
                ca, cb = (np.array([m["c"] for m in ms]) for ms in (left, right))
                ia, ib = (np.array([m["doc_id"] for m in ms]) for ms in (left, right))
                for i in range(len(left)):
                    total = na[i] + nb
                    most = total - 2 * (-(-percent * total // (100 + percent)))
                    near = np.bitwise_count(a[i] ^ b).sum(1) <= most
                    near &= (cb != ca[i]) & (100 * np.minimum(na[i], nb) >= percent * np.maximum(na[i], nb))
                    near &= (ib > ia[i]) if same else (ib != ia[i])
                    out += [(min(ia[i], y), max(ia[i], y)) for y in ib[near].tolist()]
            yield _table(out, ("x", "y"))

    return run


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def components(tables: Tables, links: DataFrame, name: str) -> DataFrame:
    """``node, label`` of every node of ``links`` (x, y): the smallest node it
    reaches.  Smallest labels of neighbours, then the label's own label, until
    nothing changes; a node of many links is partial aggregates and a join."""
    edges = links.select("x", "y").union(links.select(F.col("y"), F.col("x"))).distinct()
    edges = tables.write(f"{name}-edges", edges.toDF("a", "b"))
    labels = tables.write(f"{name}-0", edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    step = 0
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        via = labels.select(F.col("node").alias("label"), F.col("label").alias("via"))
        lower = lower.join(via, "label").select("node", "old", F.least("label", "via").alias("label"))
        new = tables.write(f"{name}-{step + 1}", lower)
        tables.drop(f"{name}-{step}")
        step += 1
        if new.filter("label < old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _close(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    tables = Tables(docs.sparkSession, "jaccard")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    fields = T.StructType([*_longs("doc_id", "n", "d1", "d2").fields, T.StructField("zone", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])
    sets = tables.write("sets", narrow.mapInArrow(_sets(words, percent), fields))
    named = sets.filter("doc_id IS NOT NULL AND n > 0")
    classes = tables.write("classes", named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")))
    reps = tables.write("reps", named.join(classes, ["d1", "d2"]).filter("doc_id = rep").select("doc_id", "n", "zone", "sketch"))
    sets = tables.write("digests", sets.select("doc_id", "n", "d1", "d2"))
    tables.drop("sets")

    # Document frequencies in the zones, and each document's prefix.
    zones = reps.select("doc_id", "n", F.posexplode("zone").alias("pos", "t"))
    df = tables.write("frequencies", zones.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1"))
    found = zones.join(df, "t").groupBy("doc_id", "n").agg(F.collect_list(F.struct("pos", "t", "df")).alias("found"))
    rows = _longs("t", "doc_id", "n", "l", "own")
    prefixes = tables.write("prefixes", found.mapInArrow(_prefixes(percent), rows))
    long = prefixes.filter("l = 0").select("doc_id", "n", "own").distinct()
    grams = narrow.join(long, "doc_id").select("doc_id", "text", "n", "own").mapInArrow(_all_grams(words), _longs("t", "doc_id", "n", "own"))
    frequent = tables.write("frequent", df.filter(F.col("df") > RARE))
    ordered = grams.join(frequent, "t", "left").groupBy("doc_id", "n", "own").agg(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t")).alias("grams"))
    long_rows = tables.write("long", ordered.mapInArrow(_long_prefixes(percent), rows))
    reps = tables.write("sketches", reps.select("doc_id", "n", "sketch"))
    tables.drop("frequencies", "frequent", "reps")
    every = prefixes.filter("l > 0").unionByName(long_rows)

    # Buckets: a row for each document and prefix n-gram, with the bucket's size.
    sizes = tables.write("sizes", every.groupBy("t").agg(F.count("*").alias("size"), F.min(F.struct("own", "doc_id"))["doc_id"].alias("leader")).filter("size > 1"))
    held = tables.write("held", every.join(sizes, "t"))
    tables.drop("prefixes", "long", "sizes")
    large = held.filter(F.col("size") > RARE_BUCKET)
    small = held.filter(F.col("size") <= RARE_BUCKET)
    # A document that also stands in large buckets asks for one match, as those are not counted here.
    in_large = tables.write("in-large", large.select("doc_id").distinct().withColumn("large", F.lit(True)))
    small = small.join(in_large, "doc_id", "left").withColumn("l", F.when(F.col("large"), F.lit(1)).otherwise(F.col("l")))
    small = tables.write("small", small.select("t", "doc_id", "n", "l"))
    x, y = (small.select("t", *[F.col(c).alias(c2) for c, c2 in zip(("doc_id", "n", "l"), names, strict=True)]) for names in (("x", "nx", "lx"), ("y", "ny", "ly")))
    pairs = x.join(y, "t").filter((F.col("x") < F.col("y")) & _close(F.col("nx"), F.col("ny"), percent))
    pairs = pairs.groupBy("x", "y").agg(F.count("*").alias("shared"), F.first("lx").alias("lx"), F.first("ly").alias("ly"))
    pairs = tables.write("pairs", pairs.filter(F.col("shared") >= F.least("lx", "ly")).select("x", "y"))
    leaders = large.filter("doc_id <> leader").select(F.least("doc_id", "leader").alias("x"), F.greatest("doc_id", "leader").alias("y"))
    candidates = tables.write("candidates", pairs.union(leaders).distinct())
    members = large.select("leader", "doc_id", "n").distinct()
    members = tables.write("members", members.unionByName(members.select("leader", F.col("leader").alias("doc_id")).distinct().join(reps.select("doc_id", "n"), "doc_id")).distinct())
    tables.drop("held", "small", "in-large", "pairs")

    def linked(candidates: DataFrame, name: str) -> DataFrame:
        bits = reps.select("doc_id", "n", "sketch")
        both = candidates.join(bits.toDF("x", "nx", "sx"), "x").join(bits.toDF("y", "ny", "sy"), "y").filter(_close(F.col("nx"), F.col("ny"), percent))
        left = tables.write(f"{name}-left", both.mapInArrow(_sketched(percent), _longs("x", "y")).distinct())
        ids = left.select(F.col("x").alias("doc_id")).union(left.select("y")).distinct()
        whole = T.StructType([*_longs("doc_id").fields, T.StructField("g", T.ArrayType(T.LongType()))])

        def run(batches):
            for batch_ in batches:
                for batch in slices(batch_, 1, SLICE):
                    grams, offsets = shingle_sets(utf8_parts(batch.column(1)), words)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(grams))], names=["doc_id", "g"])

        sets_ = tables.write(f"{name}-sets", narrow.join(ids, "doc_id").select("doc_id", "text").mapInArrow(run, whole))
        both = left.join(sets_.toDF("x", "gx"), "x").join(sets_.toDF("y", "gy"), "y")
        out = tables.write(f"{name}-links", both.mapInArrow(_verified(percent), _longs("x", "y")).distinct())
        tables.drop(f"{name}-left", f"{name}-sets")
        return out

    links = linked(candidates, "first")
    label = components(tables, links, "one")
    # Members of a large bucket's family that no link joins so far: sketch blocks against sketch blocks.
    of = members.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("label", "doc_id"))
    open_ = of.groupBy("leader").agg(F.min("c").alias("a"), F.max("c").alias("b"), F.count("*").alias("size")).filter("a < b").select("leader", "size")
    open_ = tables.write("open", open_)
    ratio = math.log(100 / percent)
    of = of.join(open_, "leader").withColumn("bin", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio)).cast("long"))
    of = tables.write("open-members", of.select("leader", "doc_id", "n", "c", "bin"))
    bins = of.groupBy("leader", "bin").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("long").alias("parts"))
    bins = tables.write("bins", bins)
    of = of.join(bins, ["leader", "bin"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    # Sizes within 85 % are in one bin or in neighbouring ones.
    twin = bins.select("leader", F.explode(F.sequence(F.col("bin") - 1, F.col("bin") + 1)).alias("bin"), F.col("bin").alias("other"), F.col("parts").alias("other_parts"))
    meets = of.join(tables.write("twins", twin), ["leader", "bin"]).withColumn("other_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_parts") - 1)))
    own, other = F.struct("bin", "part"), F.struct(F.col("other").alias("bin"), F.col("other_part").alias("part"))
    meets = meets.select("leader", F.least(own, other).alias("p"), F.greatest(own, other).alias("q"), (own <= other).alias("is_left"), (own >= other).alias("is_right"), "doc_id", "n", "c")
    meets = meets.join(reps.select("doc_id", "sketch"), "doc_id")
    member = F.struct("doc_id", "n", "c", "sketch")
    meets = meets.groupBy("leader", "p", "q").agg(
        F.collect_list(F.when(F.col("is_left"), member)).alias("left"), F.collect_list(F.when(F.col("is_right"), member)).alias("right"),
        (F.min("c") < F.max("c")).alias("mixed"))
    meets = meets.filter(F.col("mixed") & (F.size("left") > 0) & (F.size("right") > 0)).select((F.col("p") == F.col("q")).alias("same"), "left", "right")
    more = tables.write("more", meets.mapInArrow(_blocks_compared(percent), _longs("x", "y")).distinct())
    if not more.isEmpty():
        label = components(tables, links.union(linked(more, "second")), "two")
    of_class = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", F.coalesce("label", "rep").alias("component_id"))
    of_class = tables.write("components", of_class)
    result = sets.select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    own_label = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own_label).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns; of each component the document with the
    smallest id stays (rows that repeat that id stay as they are, and so do
    rows without an id)."""
    found = join(docs, words, percent, doc_id, text)
    gone = found.filter("doc_id IS NOT NULL AND doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id].cast("long") == F.col("_gone"), "left_anti")
