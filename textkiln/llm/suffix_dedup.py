"""Exact substring deduplication by suffix groups (operator 2).

Every byte that a ``DEPTH``-byte string covers which also starts earlier (in a
document of a smaller id, or earlier in the same one) is removed.  Ordering all
suffixes through 100 bytes would ship every byte of the corpus a hundred times,
so suffixes are sorted most significant digit first, where a digit is a
stretch of the suffix's first 100 bytes, passes go from short digits to the
whole depth, and only members of a group of two or more go on to the next:

1. *Gram, 32 bytes.*  The digit of a suffix is the 32-byte gram of the smallest
   hash that lies in its first 100 bytes.  Equal suffixes have equal digits at
   the same offset, and neighbouring suffixes share theirs, so one row (a gram,
   at one place) stands for a run of about 31 suffixes.  Grams of one document
   only leave.
2. *The whole stretch of a row*, all its suffixes through full depth.  Rows with
   equal stretches are equal groups at once: all but the smallest id are
   repeated, and that one goes on alone, for all.
3. *Blocks of 16 suffixes, 85 bytes.*  Where stretches of one gram differ, blocks
   of 16 suffixes are grouped by the 85 bytes all of them hold; single blocks
   leave, and equal whole blocks are again decided by one of them.
4. *Single suffixes, 100 bytes.*  Equal groups are exactly the repeated windows.

Groups only ever become counts and smallest ids (partial aggregates), and rows
meet them by a join of two written tables, which adaptive execution may split;
no group is collected.  Repeats inside one document are found when the text is
cut, on the document alone.

Digits are compared as 64-bit hashes next to the gram's own 64-bit hash.

Edge cases: null counts as the empty text; texts shorter than ``DEPTH`` are left
whole; rows without an id take no part and are left whole; an id is a
document's identity: rows that repeat one hold one text, and each gets the same
result; an empty table gives an empty result; only id and text are read, so
further columns never clash.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import Tables, slices, utf8_parts

DEPTH = 100
GRAM = 32
BLOCK = 16
SPAN = DEPTH - GRAM + 1  # grams in a suffix' first DEPTH bytes
CORE = DEPTH - BLOCK + 1
SLICE = 1 << 20  # bytes handled at once; a longer text is one slice

_BYTE = np.random.default_rng(7100).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_STEP, n, 1 << 64))


def _rolling(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Polynomial hash of every run of each size, put together from runs of powers of two."""
    base, width = {1: _BYTE[data]}, 1
    while 2 * width <= max(sizes):
        h = base[width]
        base[2 * width] = h[: len(h) - width] * _power(width) + h[width:]
        width *= 2
    out = []
    for size in sizes:
        n, done, h = max(len(data) - size + 1, 0), 0, None
        for w in sorted(base, reverse=True):
            if size & w:
                part = base[w][done : done + n]
                h = part if h is None else h * _power(w) + part
                done += w
        out.append(h[:n] if h is not None else np.zeros(0, np.uint64))
    return out


def anchors(texts: list[bytes]):
    """Rows of pass 1, as arrays: text's number, gram's position, its hash, and
    the first and last suffix (positions) whose smallest gram it is."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < DEPTH:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none, none
    (h,) = _rolling(data, GRAM)
    # Half a hash to order by, then the position: ties go to the left.
    low, width = (h & np.uint64(_ALL - 0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * width <= SPAN:
        low, width = np.minimum(low[:-width], low[width:]), width * 2
    low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.ones(len(at), bool)
    change[1:] = at[1:] != at[:-1]
    change[starts[starts < len(at)]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(at)) - 1
    owner = np.searchsorted(starts, first, side="right") - 1
    last = np.minimum(last, starts[owner] + sizes[owner] - DEPTH)  # suffixes that leave their text are none
    ok = first <= last
    first, last, owner = first[ok], last[ok], owner[ok]
    at, start = at[first], starts[owner]
    return owner, at - start, h[at], first - start, last - start


def _pack(first, at, last):
    """Where a row's suffixes are, in one long."""
    return (first << 16) | ((at - first + SPAN) << 8) | (last - first + 1)


def _unpack(p: np.ndarray):
    first = p >> 16
    return first, first + ((p >> 8) & 255) - SPAN, first + (p & 255) - 1


def _rows(whole: bool):
    """(h, doc_id) or (h, stretch, doc_id, place): of equal ones in a document the first."""

    def run(batches):
        for batch_ in batches:
            for batch in slices(batch_, 1, SLICE):
                texts, ids = utf8_parts(batch.column(1)), batch.column(0).to_numpy()
                owner, at, h, first, last = anchors(texts)
                if whole:
                    digest = xxhash.xxh3_64_intdigest
                    stretch = np.array([digest(texts[o][a : b + DEPTH]) for o, a, b in zip(owner.tolist(), first.tolist(), last.tolist(), strict=True)], np.uint64)
                    keep = _first_of(owner, h, stretch)
                    columns = [h[keep].view(np.int64), stretch[keep].view(np.int64), ids[owner[keep]], _pack(first, at, last)[keep]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "stretch", "doc_id", "place"])
                else:
                    keep = _first_of(owner, h)
                    yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(ids[owner[keep]])], names=["h", "doc_id"])

    return run


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where each combination of values stands first, in order."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort((*keys[::-1],))
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return np.sort(order[new])  # lexsort is stable: the first of each run of equals is the earliest


def _blocks(batches):
    """Pass 3's rows of the documents' stretches (column ``rows``: structs of h
    and place): blocks of suffixes by offset from the gram, clipped to the row."""
    digest = xxhash.xxh3_64_intdigest
    for batch_ in batches:
        for batch in slices(batch_, 1, SLICE):
            texts = utf8_parts(batch.column(1))
            counts = pc.list_value_length(batch.column(2)).to_numpy()
            flat = batch.column(2).flatten()
            h, place = (pc.struct_field(flat, f).to_numpy() for f in ("h", "place"))
            owner = np.repeat(np.arange(len(texts)), counts)
            first, at, last = _unpack(place)
            data = np.frombuffer(b"".join(texts), np.uint8)
            base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
            window, core = _rolling(data, DEPTH, CORE)
            # Offsets a - s of a row's suffixes run from near to far; far // BLOCK - near // BLOCK + 1 blocks.
            near, far = at - last, at - first
            lo = near // BLOCK
            n = far // BLOCK - lo + 1
            row = np.repeat(np.arange(len(h)), n)
            ob = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            o_near, o_far = np.maximum(ob * BLOCK, near[row]), np.minimum(ob * BLOCK + BLOCK - 1, far[row])
            s0, s1 = at[row] - o_far, at[row] - o_near  # suffixes of the block, positions in the text
            start = base[owner[row]]
            core_at = start + at[row] - ob * BLOCK  # inside every suffix of the whole block
            whole = [digest(texts[o][a : b + DEPTH]) for o, a, b in zip(owner[row].tolist(), s0.tolist(), s1.tolist(), strict=True)]
            size = s1 - s0 + 1
            each = np.repeat(start + s0, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays([
                pa.array(h[row]), pa.array(ob * 4096 + (o_near % BLOCK) * 64 + size), pa.array(core[core_at].view(np.int64)),
                pa.array(np.array(whole, np.uint64).view(np.int64)), pa.array(batch.column(0).to_numpy()[owner[row]]), pa.array(s0),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(window[each].view(np.int64))),
            ], names=["h", "block", "core", "whole", "doc_id", "at", "windows"])


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _groups(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, at, size``: bytes that are covered by windows which a document
    of a smaller id holds too."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).dropna()
    tables = Tables(docs.sparkSession, "suffix")
    spans = []

    def found(rows: DataFrame) -> None:
        spans.append(tables.write(f"spans-{len(spans)}", rows))

    # Pass 1: grams of two documents or more.
    grams = _groups(narrow.mapInArrow(_rows(False), T.StructType(_longs("h", "doc_id"))), "h")
    grams = tables.write("grams", grams.filter("first < last").select("h"))
    rows = narrow.mapInArrow(_rows(True), T.StructType(_longs("h", "stretch", "doc_id", "place")))
    rows = tables.write("rows", rows.join(grams, "h"))
    # Pass 2: equal stretches.
    stretches = tables.write("stretches", rows.groupBy("h", "stretch").agg(F.min("doc_id").alias("first")))
    known = rows.join(stretches, ["h", "stretch"])
    size = F.col("place").bitwiseAND(255) + (DEPTH - 1)
    found(known.filter("doc_id > first").select("doc_id", F.shiftright("place", 16).alias("at"), size.alias("size")))
    several = tables.write("several", stretches.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    one = tables.write("open", known.filter("doc_id = first").join(several, "h").select("doc_id", "h", "place"))
    tables.drop("grams", "rows", "stretches", "several")
    # Pass 3: blocks of the stretches that differ.
    by_doc = one.groupBy("doc_id").agg(F.collect_list(F.struct("h", "place")).alias("rows"))
    fields = T.StructType([*_longs("h", "block", "core", "whole", "doc_id", "at"), T.StructField("windows", T.ArrayType(T.LongType()))])
    blocks = tables.write("blocks", narrow.join(by_doc, "doc_id").select("doc_id", "text", "rows").mapInArrow(_blocks, fields))
    number = F.expr("block div 4096")
    cores = tables.write("cores", _groups(blocks.withColumn("ob", number), "h", "ob", "core").filter("first < last").select("h", "ob", "core"))
    alive = tables.write("alive", blocks.withColumn("ob", number).join(cores, ["h", "ob", "core"]).drop("ob", "core"))
    tables.drop("open", "blocks", "cores")
    wholes = tables.write("wholes", alive.groupBy("h", "block", "whole").agg(F.min("doc_id").alias("first")))
    known = alive.join(wholes, ["h", "block", "whole"])
    found(known.filter("doc_id > first").select("doc_id", "at", (F.size("windows") + (DEPTH - 1)).cast("long").alias("size")))
    # Pass 4: single suffixes.
    single = known.filter("doc_id = first").select("h", "doc_id", "at", F.posexplode("windows").alias("i", "w"))
    single = tables.write("single", single.select("h", "w", "doc_id", (F.col("at") + F.col("i")).alias("at")))
    tables.drop("alive", "wholes")
    windows = tables.write("windows", _groups(single, "h", "w").filter("first < last").select("h", "w", "first"))
    found(single.join(windows, ["h", "w"]).filter("doc_id > first").select("doc_id", "at", F.lit(DEPTH).cast("long").alias("size")))
    tables.drop("single", "windows")
    return reduce(DataFrame.unionByName, spans)


def _inside(texts: list[bytes]) -> dict[int, np.ndarray]:
    """Starts of windows that stand earlier in the same text, for the texts that have any."""
    owner, _, h, *_ = anchors(texts)
    order = np.lexsort((h, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (h[order][1:] == h[order][:-1])
    out = {}
    for d in np.unique(owner[order][1:][same]).tolist():
        (windows,) = _rolling(np.frombuffer(texts[d], np.uint8), DEPTH)
        repeated = np.ones(len(windows), bool)
        repeated[np.unique(windows, return_index=True)[1]] = False
        out[d] = np.flatnonzero(repeated)
    return out


def _covered(size: int, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Disjoint byte ranges (rows of begin and end) under all spans."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    inside = (np.cumsum(edge[:-1]) > 0).astype(np.int8)
    return np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]]))).reshape(-1, 2)


def _cutter(text_at: int, keep_text: bool):
    """Rows with a last column of (at, size) structs: null takes no part."""

    def run(batches):
        for batch_ in batches:
            for batch in slices(batch_, text_at, SLICE):
                texts = utf8_parts(batch.column(text_at))
                spans = batch.column(batch.num_columns - 1)
                active = spans.is_valid().to_pylist()
                counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
                flat = spans.flatten()
                at, size = (pc.struct_field(flat, f).to_numpy() for f in ("at", "size"))
                ends = np.cumsum(counts)
                inside = _inside(texts)
                cut, kept, digests = [], [], []
                for d, (text, end, n, use) in enumerate(zip(texts, ends.tolist(), counts.tolist(), active, strict=True)):
                    ranges = np.zeros((0, 2), np.int64)
                    if use and (n or d in inside):
                        own = inside.get(d, np.zeros(0, np.int64))
                        ranges = _covered(len(text), np.concatenate([at[end - n : end], own]), np.concatenate([size[end - n : end], np.full(len(own), DEPTH)]))
                    edges = [0, *ranges.ravel().tolist(), len(text)]
                    left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if len(ranges) else text
                    cut.append((len(text), len(text) - len(left), len(ranges)))
                    digests.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                if keep_text:
                    columns = list(batch.columns[:-1])
                    valid = batch.column(text_at).is_valid().to_pylist()
                    columns[text_at] = pa.array([k.decode("utf-8", "replace") if v else None for k, v in zip(kept, valid, strict=True)], pa.string())
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
                else:
                    n = np.array(cut, np.int64).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), *(pa.array(n[:, i]) for i in range(3)), pa.array(digests, pa.string())],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _with_spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    spans = repeated_spans(docs, doc_id, text).groupBy(F.col("doc_id").alias("_of")).agg(F.collect_list(F.struct("at", "size")).alias("_spans"))
    own = F.when(F.col(doc_id).isNotNull(), F.coalesce("_spans", F.array().cast("array<struct<at:bigint,size:bigint>>")))
    return docs.join(spans, docs[doc_id].cast("long") == spans["_of"], "left").select(*[docs[c] for c in docs.columns], own.alias("_spans"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, its texts without the repeated bytes;
    where a cut falls inside a character, U+FFFD stands for what is left of it."""
    return _with_spans(docs, doc_id, text).mapInArrow(_cutter(docs.columns.index(text), True), docs.schema)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([*_longs("doc_id", "n_bytes", "n_removed", "n_spans"), T.StructField("kept_sha256", T.StringType())])
    return _with_spans(narrow, "doc_id", "text").mapInArrow(_cutter(1, False), schema)
