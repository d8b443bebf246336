"""The token-id stream of a corpus.

Canonical form: one row per document ``(doc_id, n, doc_start, ids array<int>)``,
written with its ids packed as binary (four bytes each: copied whole, where an
array is written and read element by element),
where ``doc_start`` is the global position of the document's first token in
corpus order (``doc_id``).  Positions come from the two-level prefix sum in
``positions`` over the narrow ``(doc_id, n)`` table; the token arrays never go
through a global sort.  Everything downstream is narrow or joins against
tables whose size is bounded by parameters:

* split (W5): ``pos < (9 * n) div 10`` is train, a filter on position;
* next-token pairs (J6): pairs inside a document come from its array; the one
  pair crossing into the next document is a document-level equi-join on
  ``doc_start + n = doc_start``;
* training windows (W6/J7): the stream is stored once as blocks of
  ``CHUNK_SIZE`` tokens in order of position; a window is an equi-join on
  the few block numbers it touches, and its parts are sliced out of the blocks.

Two id sources: pretoken ids (vocabulary ranked by ``(count desc, token)``,
checkable in SQL) and BPE ids (``bpe.encode_documents``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.arrow_parts import parts
from textkiln.operators.positions import ordered_offsets, row_index
from textkiln.functions.text import frame_document
from textkiln.operators.pretokens import CACHED_BYTES, char_classes, cut_parts, cuttable, doc_pretoken_counts, doc_pretokens, pretoken_counts
from textkiln.session import materialised
from textkiln.sources.seeds import require_nonempty

# Reference sampling shape and split fraction (train = first 9/10).
BLOCK_SIZE = 128
BATCH_SIZE = 64
TRAIN_NUMERATOR, TRAIN_DENOMINATOR = 9, 10
# Tokens of a stored block, and chunk numbers that a filter may list.
CHUNK_SIZE = 256
MAX_LISTED = 10_000
# Knuth's multiplicative hash constant for deterministic window starts.
HASH_MULT = 2654435761


class BlockTooLongError(ValueError):
    """A split must hold more than ``block`` tokens."""


def pretoken_vocab(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(token, cnt, token_id)``; id = rank by ``(cnt desc, token)`` from 0."""
    counts = pretoken_counts(doc_pretokens(docs, key, text_col))
    return row_index(counts, [F.col("cnt").desc(), F.col("token").asc()], out="token_id")


@dataclass
class IdStream:
    rows: DataFrame  # (rid, doc_id, n, ids array<int> or packed[, first_id, last_id]), written, in any order
    starts: DataFrame  # (rid, doc_start), written and narrow
    n_total: int
    vocab_size: int
    rare: DataFrame | None = None  # (rid, rare array<long>): a row's rare words, each as its place among them and id
    _chunks: dict[int, DataFrame] = field(default_factory=dict)

    @cached_property
    def _table(self) -> DataFrame:
        """Packed ids, positions and ends of each document, written at first use."""
        extra = self.starts
        if self.rare is not None:
            extra = extra.join(self.rare, "rid", "left")
        joined = self.rows.select("rid", "doc_id", "n", "ids").join(extra, "rid").drop("rid")
        fields = [joined.schema[name] for name in ("doc_id", "n", "doc_start")]
        ends = [T.StructField(name, T.IntegerType()) for name in ("first_id", "last_id")]
        schema = T.StructType([*fields, T.StructField("packed", T.BinaryType()), *ends])
        columns = ["doc_id", "n", "doc_start", "ids", *(["rare"] if self.rare is not None else [])]
        return materialised(joined.select(*columns).mapInArrow(_whole, schema), "token-stream")

    @property
    def docs(self) -> DataFrame:
        """``(doc_id, n, doc_start, ids array<int>)``."""
        held = self._table.select("doc_id", "n", "doc_start", "packed")
        return held.mapInArrow(_unpacked, T.StructType([*held.schema.fields[:3], T.StructField("ids", T.ArrayType(T.IntegerType()))]))

    @property
    def offsets(self) -> DataFrame:
        """``(doc_id, n, doc_start, first_id, last_id)``, narrow columns of the same table,
        or of the rows themselves where these hold their ends."""
        if "first_id" in self.rows.columns:
            return self.rows.select("rid", "doc_id", "n", "first_id", "last_id").join(self.starts, "rid").select("doc_id", "n", "doc_start", "first_id", "last_id")
        return self._table.select("doc_id", "n", "doc_start", "first_id", "last_id")

    @property
    def split_at(self) -> int:
        return (TRAIN_NUMERATOR * self.n_total) // TRAIN_DENOMINATOR

    def split_of(self, pos):
        return F.when(pos < F.lit(self.split_at), F.lit("train")).otherwise(F.lit("val"))

    # ---------------------------------------------------------------- W4
    def tokens(self) -> DataFrame:
        """``(pos, doc_id, pos_in_doc, token_id, split)``: narrow explode."""
        t = self.docs.select("doc_id", "doc_start", F.posexplode("ids").alias("pos_in_doc", "token_id"))
        pos = F.col("doc_start") + F.col("pos_in_doc")
        return t.select(pos.alias("pos"), "doc_id", F.col("pos_in_doc").cast("long"), "token_id", self.split_of(pos).alias("split"))

    # ---------------------------------------------------------------- W5
    def split_summary(self) -> DataFrame:
        n = self.offsets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        at = F.lit(self.split_at).cast("long")
        parts = [(F.lit("train"), at, F.lit(0).cast("long")), (F.lit("val"), F.col("n") - at, at)]
        rows = F.array(*[F.struct(name.alias("split"), size.alias("n_tokens"), first.alias("first_pos"), (first + size - 1).alias("last_pos")) for name, size, first in parts])
        return n.select(F.explode(rows).alias("r")).select("r.*").where("n_tokens > 0")

    # ---------------------------------------------------------------- J6
    def _crossings(self) -> DataFrame:
        """``(pos, x, y)``: the pair from each document's last token to the next one's first."""
        held = self.offsets.where(F.col("n") >= 1)
        ends = held.select((F.col("doc_start") + F.col("n")).alias("next_start"), (F.col("doc_start") + F.col("n") - 1).alias("pos"), F.col("last_id").alias("x"))
        starts = held.select(F.col("doc_start").alias("next_start"), F.col("first_id").alias("y"))
        return ends.join(starts, "next_start").select("pos", "x", "y")

    def pairs(self) -> DataFrame:
        """``(split, pos, x, y)``: consecutive tokens that lie in the same split."""
        before_last = F.col("n").cast("int") - 1
        shifted = F.arrays_zip(F.slice("ids", F.lit(1), before_last).alias("x"), F.slice("ids", F.lit(2), before_last).alias("y"))
        inner = self.docs.where(F.col("n") >= 2).select("doc_start", F.posexplode(shifted).alias("i", "p")).select(
            (F.col("doc_start") + F.col("i")).alias("pos"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
        both = inner.unionByName(self._crossings())
        same_split = (F.col("pos") + 1 < self.split_at) | (F.col("pos") >= self.split_at)
        return both.where(same_split).select(self.split_of(F.col("pos")).alias("split"), "pos", "x", "y")

    def runs(self) -> DataFrame:
        """``(pos, packed)``: the same consecutive tokens (and the pair over the split's
        border) as runs from ``pos`` on: a document, or a pair between two documents."""
        inner = self._table.where(F.col("n") >= 2).select(F.col("doc_start").alias("pos"), "packed")
        return inner.unionByName(self._crossings().mapInArrow(_pair_runs, "pos long, packed binary"))

    # ---------------------------------------------------------------- W6 / J7
    def chunks(self, size: int = CHUNK_SIZE) -> DataFrame:
        """The stream as ``(chunk, ids)``, blocks of ``size`` tokens by
        position, written once in order of their numbers so that readers of a few blocks skip row groups."""
        if size not in self._chunks:
            first, last = F.floor(F.col("doc_start") / size).cast("long"), F.floor((F.col("doc_start") + F.col("n") - 1) / size).cast("long")

            def part(c):
                lo = F.greatest(c * size, F.col("doc_start")) - F.col("doc_start")
                hi = F.least((c + 1) * size, F.col("doc_start") + F.col("n")) - F.col("doc_start")
                return F.struct(c.alias("chunk"), F.col("doc_start"), F.slice("ids", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("part"))

            parts = self.docs.where(F.col("n") >= 1).select(F.explode(F.transform(F.sequence(first, last), part)).alias("p")).select("p.*")
            # A chunk has at most ``size`` parts and tokens.
            whole = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("doc_start", "part"))), lambda s: s["part"]))
            blocks = parts.groupBy("chunk").agg(whole.alias("ids"))
            self._chunks[size] = materialised(blocks.repartitionByRange("chunk").sortWithinPartitions("chunk"), "token-chunks")
        return self._chunks[size]

    def window_starts(self, steps: int, batch: int = BATCH_SIZE, block: int = BLOCK_SIZE, seed: int = 0) -> DataFrame:
        """``(split, step, b, start, g0)``: ``batch`` windows a step and split, at
        ``start`` inside the split and ``g0`` in the stream; ``start`` is uniform-like
        in ``[0, n_split - block)`` from an integer hash of ``(step, b, seed)``."""
        spark = self.docs.sparkSession
        sizes = {"train": (0, self.split_at), "val": (self.split_at, self.n_total - self.split_at)}
        for name, (_, n) in sizes.items():
            if n <= block:
                raise BlockTooLongError(f"{name} split has {n} tokens, needs more than block={block}")
        rows = [F.struct(F.lit(name).alias("split"), F.lit(base).cast("long").alias("base"), F.lit(n).cast("long").alias("n")) for name, (base, n) in sizes.items()]
        specs = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        idx = F.explode(F.sequence(F.lit(0), F.lit(steps * batch - 1))).alias("k")
        start = (F.col("k") * F.lit(HASH_MULT) + F.lit(seed)) % (F.col("n") - F.lit(block))
        return specs.select("split", "base", "n", idx).select(
            "split",
            (F.col("k") / batch).cast("long").alias("step"),
            (F.col("k") % batch).cast("long").alias("b"),
            start.alias("start"),
            (F.col("base") + start).alias("g0"),
        )

    def windows(self, steps: int, batch: int = BATCH_SIZE, block: int = BLOCK_SIZE, seed: int = 0, chunk_size: int = CHUNK_SIZE) -> DataFrame:
        """``(split, step, b, start, x, y)`` with ``x = tokens[start, start+block)``
        and ``y`` shifted by one, per split, at ``window_starts``."""
        starts = self.window_starts(steps, batch, block, seed)
        # A window covers global positions [g0, g0 + block], which lie in a few chunks.
        k = F.lit(chunk_size)
        chunk_of = lambda pos: F.floor(pos / k).cast("long")
        need = starts.select("split", "step", "b", "start", "g0", F.explode(F.sequence(chunk_of(F.col("g0")), chunk_of(F.col("g0") + block))).alias("chunk"))
        store = self.chunks(chunk_size)
        if 2 * steps * batch * (2 + block // chunk_size) <= MAX_LISTED:
            # Few enough to name: the files' statistics leave out what no window needs.
            store = store.where(F.col("chunk").isin([r["chunk"] for r in need.select("chunk").distinct().collect()]))
        lo = F.greatest(F.col("g0") - F.col("chunk") * k, F.lit(0))
        hi = F.least(F.col("g0") + block - F.col("chunk") * k, k - 1)
        piece = need.join(store, "chunk").select("split", "step", "b", "start", "chunk", F.slice("ids", (lo + 1).cast("int"), (hi - lo + 1).cast("int")).alias("part"))
        # A window spans block+1 tokens, so each group is bounded by the block size.
        grouped = piece.groupBy("split", "step", "b", "start").agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "part"))), lambda s: s["part"])).alias("seq")
        )
        return grouped.select(
            "split", "step", "b", "start",
            F.slice("seq", 1, block).alias("x"),
            F.slice("seq", 2, block).alias("y"),
        )


def packed_array(flat: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Rows of ids as binary values, four bytes an id: row ``i`` ends before ``ends[i + 1]``."""
    data = pa.py_buffer(np.ascontiguousarray(flat, "<i4"))
    out = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64) * 4), data])
    return (out if missing is None else pc.if_else(pa.array(missing), None, out)).cast(pa.binary())


def unpacked_array(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of ``packed_array``'s rows and how many each has."""
    sizes = pc.fill_null(pc.binary_length(packed), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    _, offsets, data = packed.buffers()
    first = int(np.frombuffer(offsets, np.int32)[packed.offset]) if len(packed) else 0
    total = int(sizes.sum())
    return (np.frombuffer(data, "<i4", total, first) if total else np.zeros(0, np.int32)), sizes


def _unpacked(batches):
    """``packed`` (last column) as ``ids``."""
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column(whole.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        for batch in parts(whole, sizes, PART_PACKED):
            packed = batch.column(batch.num_columns - 1)
            flat, sizes = unpacked_array(packed)
            ids = pa.ListArray.from_arrays(pa.array(_bounds(sizes), pa.int32()), pa.array(flat), mask=pc.is_null(packed) if packed.null_count else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], "ids"])


def _pair_runs(batches):
    for batch in batches:
        pairs = np.stack([batch.column(i).to_numpy() for i in (1, 2)], 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), packed_array(pairs.ravel(), np.arange(len(batch) + 1) * 2)], names=["pos", "packed"])


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _ends(ids: Column) -> tuple[Column, Column]:
    return F.try_element_at(ids, F.lit(1)).alias("first_id"), F.try_element_at(ids, F.lit(-1)).alias("last_id")


def _assemble(rows: DataFrame, vocab_size: int, rare: DataFrame | None = None) -> IdStream:
    """The stream over written ``rows(rid, doc_id, n, ids)``: positions from the
    prefix sum over their narrow columns, the arrays themselves stay where they are."""
    starts = ordered_offsets(rows.select("rid", "doc_id", "n"), ["doc_id", "rid"], "n", out="doc_start").select("rid", "doc_start", "n")
    starts = materialised(starts, "token-starts")
    n_total = starts.agg(F.sum("n")).first()[0] or 0
    return IdStream(rows, starts.select("rid", "doc_start"), int(n_total), vocab_size, rare)


# The most frequent words, whose ids are sent to the tasks, and the longest of them in bytes.
HEAD_WORDS, HEAD_BYTES = 200_000, 64
# Words that are looked up at once (for each time, the head is hashed anew), and bytes
# of packed ids that are unpacked at once.
PART_WORDS, PART_PACKED = 3_000_000, 4_000_000
# Stands for the id of a rare word until it is looked up.
RARE = -1


def _is_head() -> Column:
    return (F.col("token_id") < HEAD_WORDS) & (F.octet_length("token") <= HEAD_BYTES)


def _worded(batches, classes: np.ndarray):
    """Each batch's texts (last column) as lists of words."""
    for batch in batches:
        for part, words in cut_parts(batch, classes, False, CACHED_BYTES):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], words], names=[*part.schema.names[:-1], "words"])


def _lookup(bc, table):
    """``(rid, doc_id, text)`` -> ``(rid, doc_id, n, ids, rare)``: head words by
    their ids, packed; the others marked there and listed in ``rare`` in order."""

    def run(batches):
        held, size = [], 0
        for part in _worded(batches, np.frombuffer(table.value, np.uint8)):
            held.append((part, pc.dictionary_encode(part.column(2).flatten())))
            size += len(held[-1][1])
            if size >= PART_WORDS:
                yield from _found(held, *bc.value)
                held, size = [], 0
        yield from _found(held, *bc.value)

    return run


def _found(held: list, words: pa.Array, ids: pa.Array):
    """The rows of ``_lookup`` of each part, whose different words are looked up together."""
    if not held:
        return
    by_word = ids.take(pc.index_in(pa.concat_arrays([flat.dictionary for _, flat in held]), value_set=words))
    start = 0
    for part, flat in held:
        found = by_word.slice(start, len(flat.dictionary)).take(flat.indices)
        start += len(flat.dictionary)
        unknown = found.is_null()
        missed = flat.filter(unknown).dictionary_decode().cast(pa.string())
        counts = pc.fill_null(pc.list_value_length(part.column(2)), 0).to_numpy(zero_copy_only=False)
        ends = _bounds(counts)
        lost = _bounds(unknown.to_numpy(zero_copy_only=False))[ends]
        yield pa.RecordBatch.from_arrays([
            part.column(0), part.column(1), pa.array(counts, pa.int64()),
            packed_array(found.fill_null(RARE).to_numpy(), ends),
            pa.ListArray.from_arrays(pa.array(lost, pa.int32()), missed),
        ], names=["rid", "doc_id", "n", "ids", "rare"])


def _whole(batches):
    """``(doc_id, n, doc_start, ids[, rare])`` -> the written columns of a stream: ids
    packed, their marks replaced, in order, by the row's ``rare`` ids, and the ends."""
    for batch in batches:
        ids = batch.column(3)
        if pa.types.is_list(ids.type):
            flat, sizes = ids.flatten().to_numpy(), pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        else:
            flat, sizes = unpacked_array(ids)
        if batch.num_columns == 5:
            flat = flat.copy()
            flat[flat == RARE] = batch.column(4).flatten().to_numpy() & 0x7FFFFFFF
        ends = _bounds(sizes)
        held = sizes > 0
        first, last = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32)
        first[held], last[held] = flat[ends[:-1][held]], flat[ends[1:][held] - 1]
        packed = packed_array(flat, ends, pc.is_null(ids).to_numpy(zero_copy_only=False) if ids.null_count else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], packed, pa.array(first, mask=~held), pa.array(last, mask=~held)],
            names=["doc_id", "n", "doc_start", "packed", "first_id", "last_id"])


def _lists(batches):
    """``(rid, place)`` in order -> ``(rid, rare)``, a row for each ``rid``."""
    open_rid, open_places = None, []  # the last rid may go on in the next batch

    def rows(rids, counts, places):
        return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.ListArray.from_arrays(pa.array(_bounds(counts), pa.int32()), pa.array(places, pa.int64()))], names=["rid", "rare"])

    for batch in batches:
        if not len(batch):
            continue
        rid, places = (batch.column(i).to_numpy() for i in (0, 1))
        starts = np.flatnonzero(np.append(True, rid[1:] != rid[:-1]))
        if open_rid is not None and open_rid != rid[0]:
            whole = np.concatenate(open_places)
            yield rows([open_rid], [len(whole)], whole)
            open_places = []
        if len(starts) > 1:
            counts = np.diff(starts)
            counts[0] += sum(map(len, open_places))
            yield rows(rid[starts[:-1]], counts, np.concatenate([*open_places, places[: starts[-1]]]))
            open_places = []
        open_rid = rid[-1]
        open_places.append(places[starts[-1] :].copy())
    if open_rid is not None:
        whole = np.concatenate(open_places)
        yield rows([open_rid], [len(whole)], whole)


def _looked_up(docs: DataFrame, vocab: DataFrame, key: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Written ``rows(rid, doc_id, n, ids, rare)`` of the documents' words, and
    ``(rid, rare ids)``, or None where the head holds every word.  A document
    without text has no words.

    Occurrences of head words are replaced where they lie.  Only those of rare
    words go through a join, which no word makes hot, and back to their rows."""
    spark = docs.sparkSession
    head = vocab.where(_is_head()).select("token", F.col("token_id").cast("int").alias("id")).toArrow().combine_chunks()
    table = [pa.concat_arrays(head[c].chunks) if head.num_rows else pa.array([], t) for c, t in (("token", pa.string()), ("id", pa.int32()))]
    bc = spark.sparkContext.broadcast((table[0].cast(pa.string()), table[1]))
    schema = T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("doc_id", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("rare", T.ArrayType(T.StringType())),
    ])
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("doc_id"), cuttable(frame_document(text_col)).alias("text"))
    rows = materialised(texts.mapInArrow(_lookup(bc, char_classes(spark)), schema), "token-ids")
    tail = vocab.where(~_is_head()).select("token", F.col("token_id").cast("int").alias("token_id"))
    if tail.isEmpty():
        return rows, None
    occ = rows.where(F.size("rare") > 0).select("rid", F.posexplode("rare").alias("i", "token"))
    place = F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(F.col("token_id").cast("long"))
    # In lists by an Arrow pass over sorted rows: an aggregate that collects makes an object for each.
    found = occ.join(tail, "token").select("rid", place.alias("place")).repartition("rid").sortWithinPartitions("rid", "place")
    return rows, found.mapInArrow(_lists, "rid long, rare array<long>")


def _stream(docs: DataFrame, vocab: DataFrame, vocab_size: int, key: str, text_col: str) -> IdStream:
    rows, rare = _looked_up(docs, vocab, key, text_col)
    return _assemble(rows, vocab_size, rare)


def pretoken_ids(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)``: pretokens replaced by vocabulary ids.  Every
    document stays: without text or pretokens its ids are empty."""
    return _stream(docs, vocab, 0, key, text_col).docs.select("doc_id", "ids")


def pretoken_stream(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> tuple[IdStream, DataFrame]:
    """J4 at pretoken level: every pretoken of ``text + "\\n\\n"`` replaced by its
    vocabulary id; returns the stream and the vocabulary.  Texts are cut twice, once to
    count and once to look up, which takes less than to write and read their words."""
    require_nonempty(docs, "corpus")  # S3
    counts = doc_pretoken_counts(docs, text_col)
    vocab = materialised(row_index(counts, [F.col("cnt").desc(), F.col("token").asc()], out="token_id"), "vocab")
    return _stream(docs, vocab, vocab.count(), key, text_col), vocab


def bpe_stream(model, docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> IdStream:
    from textkiln.operators.bpe import encode_documents

    require_nonempty(docs, "corpus")  # S3
    enc = encode_documents(model, docs, key, text_col).withColumnRenamed(key, "doc_id")
    rows = enc.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n"), "ids", *_ends(F.col("ids")))
    return _assemble(materialised(rows, "token-ids"), model.vocab_size)
