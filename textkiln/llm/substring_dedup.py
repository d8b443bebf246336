"""Substring deduplication by content-defined chunking (operator 1).

A gear rolling hash over the UTF-8 bytes cuts each text into variable chunks of
about ``MIN_CHUNK + 2 ** CUT_BITS`` bytes.  A cut depends on the last 32 bytes
alone, so an insertion shifts the cuts next to it only.  Chunks are
deduplicated by a 128-bit digest: a chunk that an earlier document holds (a
smaller id), or that the same document holds earlier, is repeated, and runs of
adjacent repeated chunks of ``min_run`` bytes or more are cut out, as is a text
of any length that is repeated as a whole.

1. Each document's distinct digests are counted over all documents (partial
   aggregates: a passage in a third of all documents is a row for each task).
   Those of two documents or more are written with their smallest id.
2. The chunks are joined with that table, both sides plain, so that adaptive
   execution may split a hot digest.  What remains is (document, position).
3. Documents are joined with their positions and cut; the chunker runs again,
   which is cheaper than to store all chunks.

Cuts never fall inside a character, so what is left is valid text.

Edge cases: null texts stay null (0 bytes), empty ones empty; a text shorter
than a chunk is one chunk; rows without an id take no part and come back
unchanged; ids are the documents' identity: rows that repeat an id hold one
text, and each of them comes back with the same result; further columns pass
through, also those of clashing names; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import slices, utf8_parts, written

MIN_CHUNK = 8
MAX_CHUNK = 256
CUT_BITS = 5  # one position in 2**5 may be a cut
MIN_RUN = 50  # bytes; a shorter phrase that texts share stays in them

_WINDOW = 32
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def _cut_candidates(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start of each text in a padded buffer, and every position (exclusive end
    of a chunk) where the gear hash allows a cut."""
    pad = bytes(_WINDOW)
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = _WINDOW + np.concatenate([[0], np.cumsum(sizes + _WINDOW)[:-1]])
    h = _GEAR[data]
    for s in (starts - _WINDOW).tolist():  # nothing from before a text is in its hash
        h[s : s + _WINDOW] = 0
    width = 1
    while width < _WINDOW:
        shifted = h.copy()
        shifted[width:] += h[:-width] << np.uint32(width)
        h, width = shifted, width * 2
    # Cuts are made between characters alone: a longer one allows more, so the rate by bytes is that of ASCII.
    at = np.arange(len(data))
    width = np.minimum(at - np.maximum.accumulate(np.where((data & 0xC0) != 0x80, at, 0)) + 1, 4).astype(np.uint32)
    allowed = h < width << np.uint32(32 - CUT_BITS)
    allowed[:-1] &= (data[1:] & 0xC0) != 0x80  # the next byte begins a character
    return starts, np.flatnonzero(allowed) + 1


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Exclusive ends of the chunks of each text."""
    if not texts:
        return []
    starts, candidates = _cut_candidates(texts)
    first = np.searchsorted(candidates, starts, side="right")
    last = np.searchsorted(candidates, starts + np.array([len(t) for t in texts]), side="left")
    out = []
    for text, start, a, b in zip(texts, starts.tolist(), first.tolist(), last.tolist(), strict=True):
        ends, at, size = [], 0, len(text)
        for c in [*(candidates[a:b] - start).tolist(), size]:
            while c - at > MAX_CHUNK:
                cut = at + MAX_CHUNK
                while text[cut] & 0xC0 == 0x80:
                    cut -= 1
                ends.append(cut)
                at = cut
            if c - at >= MIN_CHUNK or c == size and c > at:
                ends.append(c)
                at = c
        out.append(ends)
    return out


def _digests(text: bytes, ends: list[int]) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    return [digest(text[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def _chunks(positions: bool):
    """(digest as two longs, doc_id[, position]): a document's first chunk of each digest."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                texts = utf8_parts(batch.column(1))
                digests, at, count = [], [], []
                for text, ends in zip(texts, chunk_ends(texts), strict=True):
                    own = dict(zip(reversed(_digests(text, ends)), reversed([0, *ends[:-1]]), strict=True)) if ends else {}
                    digests += own.keys()
                    at += own.values()
                    count.append(len(own))
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                ids = np.repeat(batch.column(0).to_numpy(), count)
                columns = [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids)]
                names = ["h1", "h2", "doc_id"]
                if positions:
                    columns, names = [*columns, pa.array(np.array(at, np.int64))], [*names, "at"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, at``: where a document's chunk begins whose digest a document
    of a smaller id holds too (of equal chunks in one document the first)."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).dropna()
    key = [T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("doc_id", T.LongType())]
    held = narrow.mapInArrow(_chunks(False), T.StructType(key)).groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    held = written(held.filter("first < last").select("h1", "h2", "first"), "repeated-digests")
    found = narrow.mapInArrow(_chunks(True), T.StructType([*key, T.StructField("at", T.LongType())]))
    return found.join(held, ["h1", "h2"]).filter("doc_id > first").select("doc_id", "at")


def _runs(text: bytes, ends: list[int], known: set[int], min_run: int) -> list[tuple[int, int]]:
    """Byte ranges to cut: adjacent repeated chunks of ``min_run`` bytes in sum, or the whole text."""
    seen: set[bytes] = set()
    runs: list[tuple[int, int]] = []
    begin, at = None, 0
    for end, digest in zip(ends, _digests(text, ends), strict=True):
        if at in known or digest in seen:
            begin = at if begin is None else begin
        elif begin is not None:
            runs.append((begin, at))
            begin = None
        seen.add(digest)
        at = end
    if begin is not None:
        runs.append((begin, at))
    return [r for r in runs if r[1] - r[0] >= min_run or r == (0, len(text))]


def _cutter(text_at: int, min_run: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_at):
                raws = batch.column(text_at).cast(pa.binary()).to_pylist()
                known = batch.column(batch.num_columns - 1).to_pylist()
                texts = [r or b"" for r in raws]
                kept, spans = [], []
                for raw, text, ends, at in zip(raws, texts, chunk_ends(texts), known, strict=True):
                    # Null marks a row that takes no part.
                    own = [] if at is None else _runs(text, ends, set(at), min_run)
                    spans.append([{"b": b, "e": e} for b, e in own])
                    if own:
                        edges = [0, *(x for r in own for x in r), len(text)]
                        raw = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    kept.append(raw)
                columns = list(batch.columns)
                columns[text_at] = pa.array(kept, pa.binary()).cast(pa.string())
                columns[-1] = pa.array(spans, pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())])))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "spans"])

    return run


def spans_column(docs: DataFrame) -> str:
    """A name that ``docs`` does not have."""
    name = "_spans"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def cut_repeats(docs: DataFrame, min_run: int = MIN_RUN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, its texts without repeated chunks, and
    as last column (``spans_column``) the byte ranges that were cut."""
    known = repeated_chunks(docs, doc_id, text).groupBy("doc_id").agg(F.collect_list("at").alias("at"))
    # The rows' columns go by place, so none can clash with those of the join.
    own = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own)
    own_id = F.col(own[docs.columns.index(doc_id)])
    at = F.when(own_id.isNotNull(), F.coalesce("at", F.array().cast("array<bigint>")))
    joined = rows.join(known, own_id.cast("long") == F.col("doc_id"), "left").select(*own, at.alias("at"))
    spans = T.StructField("spans", T.ArrayType(T.StructType([T.StructField("b", T.LongType()), T.StructField("e", T.LongType())])))
    cut = joined.mapInArrow(_cutter(docs.columns.index(text), min_run), T.StructType([*rows.schema.fields, spans]))
    return cut.toDF(*docs.columns, spans_column(docs))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns and the repeated chunks cut out."""
    return cut_repeats(docs, **options).drop(spans_column(docs))


def report(docs: DataFrame, min_run: int = MIN_RUN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans`` and the ``text`` left."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["e"] - s["b"])
    left = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut_repeats(narrow, min_run).select(
        "doc_id", (left + cut).alias("n_bytes"), cut.alias("n_removed"), F.size("_spans").cast("long").alias("n_spans"), "text")
