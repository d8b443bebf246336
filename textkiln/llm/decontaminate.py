"""Benchmark decontamination (operator 3).

A hash set of the benchmark's normalised word n-grams is broadcast, documents
are scanned once in Arrow batches, every set hit is verified word by word, and
hit spans or whole documents are removed.

The broadcast is bounded: the benchmark is dealt by a hash of ``item_id`` into
blocks of about ``block_words`` words; a normal benchmark is one block and one
scan.  With more, the rows are written after each block, so the driver and a
task hold one block at a time.

Words: maximal runs of bytes outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F`` of
the text with A-Z lower-cased, so letters and digits of any script.

Edge cases: a null or empty text, or one without words, has ``n_words`` 0 and
no hit; null ids are kept as they are; an item without words, id or text has no
window; item ids may be of any type and are listed as strings; repeated items and rows count once each as themselves; an empty
benchmark leaves all documents clean; only the named columns are read, so
further columns never clash.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import slices, utf8_parts, written

NGRAM = 10
BLOCK_WORDS = 1_000_000  # words of benchmark text in one broadcast, about 50 MB as Python objects

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)

_SPANS = T.ArrayType(T.StructType([T.StructField("b", T.LongType()), T.StructField("e", T.LongType())]))
_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", _SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class _Block:
    """Hash set of one block's windows, by window length."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple, list[str]]] = {}
        for item, text in items:
            ws = words(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                held = self.windows.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), [])
                if item not in held:
                    held.append(item)
        self.hashes = {size: np.unique(self.hash(np.array(list(ws), np.int64).reshape(-1), size)[::size]) for size, ws in self.windows.items()}

    @staticmethod
    def hash(ids: np.ndarray, size: int) -> np.ndarray:
        """Rolling polynomial hash of each run of ``size`` ids."""
        h = np.zeros(max(len(ids) - size + 1, 0), np.uint64)
        x = (ids + 2).astype(np.uint64)
        for j in range(size):
            h = h * _MULT + x[j : j + len(h)]
            h ^= h >> np.uint64(29)
        return h

    def hits(self, ids: np.ndarray):
        """(start, size, items) of every verified window; ``ids`` < 0 are words no item has."""
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for size, known in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            h = self.hash(ids, size)[at]
            found = np.searchsorted(known, h)
            found[found == len(known)] = 0
            for i in at[known[found] == h].tolist():
                if items := self.windows[size].get(tuple(ids[i : i + size].tolist())):
                    yield i, size, items


_SPAN_TYPE = pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())]))


def _united(spans) -> list[dict]:
    """Disjoint ranges, in order; ranges that touch become one."""
    out: list[dict] = []
    for b, e in sorted(spans):
        if out and b <= out[-1]["e"]:
            out[-1]["e"] = max(out[-1]["e"], e)
        else:
            out.append({"b": b, "e": e})
    return out


def _scan(block: _Block, first: bool, last: bool):
    """One block's pass: input and output are (doc_id, text, n_words, spans,
    items), without text in the last one's output."""
    get = block.vocabulary.get

    def scan(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                ids, starts = [], []
                for text in utf8_parts(batch.column(1)):
                    starts.append(len(ids))
                    ids.extend(map(get, words(text), repeat(-1)))
                    ids.append(-1)  # no window crosses documents
                starts.append(len(ids))
                bounds = np.array(starts)
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                if not first:
                    for d, (own, found) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                        if found:
                            spans[d], items[d] = [(x["b"], x["e"]) for x in own], set(found)
                for i, size, found in block.hits(np.array(ids, np.int64)):
                    d = int(np.searchsorted(bounds, i, side="right")) - 1
                    spans.setdefault(d, []).append((i - starts[d], i - starts[d] + size))
                    items.setdefault(d, set()).update(found)
                n = range(len(batch))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), *([] if last else [batch.column(1)]),
                    pa.array((np.diff(bounds) - 1).astype(np.int64)),
                    pa.array([_united(spans.get(d, ())) for d in n], _SPAN_TYPE),
                    pa.array([sorted(items.get(d, ())) for d in n], pa.list_(pa.string())),
                ], names=["doc_id", *([] if last else ["text"]), "n_words", "spans", "items"])

    return scan


def _blocks(benchmark: DataFrame, n: int, item_id: str, item_text: str, block_words: int):
    """The benchmark's hash sets, each of a bounded size, one after another."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).dropna()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * block_words)))
    for b in range(blocks):
        held = items.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).collect()
        yield _Block(sorted((r["i"], r["t"].encode()) for r in held), n), b == 0, b == blocks - 1


def hit_spans(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id, n_words, spans`` (word ranges covered by
    benchmark windows, disjoint, in order) and ``items`` (distinct ids as strings)."""
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    for block, first, last in _blocks(benchmark, n, item_id, item_text, block_words):
        out = out.mapInArrow(_scan(block, first, last), T.StructType([f for f in _SCHEMA if not (last and f.name == "text")]))
        if not last:  # one block at a time in the driver and in a task
            out = written(out, "benchmark-block")
    return out


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: word count, hit words, items and the verdict."""
    hit = hit_spans(docs, benchmark, **options)
    ids = F.array_sort("items")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["e"] - s["b"])
    return hit.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        "spans",
    )


def _cleaner(block: _Block, action: str, text_at: int):
    get = block.vocabulary.get

    def clean(batches):
        for whole in batches:
            for batch in slices(whole, text_at):
                keep, texts = [], []
                for raw in batch.column(text_at).cast(pa.binary()).to_pylist():
                    found = list(_WORD.finditer((raw or b"").lower()))
                    ids = np.fromiter((get(m[0], -1) for m in found), np.int64, len(found))
                    mask = np.zeros(len(found), bool)
                    for i, size, _ in block.hits(ids):
                        mask[i : i + size] = True
                    keep.append(not mask.any())
                    if action == "spans" and mask.any():
                        out, at = [], 0
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                        for b, e in edges.reshape(-1, 2).tolist():
                            out.append(raw[at : found[b].start()])
                            at = found[e - 1].end()
                        raw = b"".join([*out, raw[at:]])
                    texts.append(raw)
                if action == "spans":
                    yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, pa.binary()).cast(batch.schema.field(text_at).type))
                else:
                    yield batch.filter(pa.array(keep))

    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", n: int = NGRAM, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a
    benchmark window (``action='documents'``) or with the hit word ranges cut
    out of their texts (``'spans'``).  Blocks are applied one after another, each
    in a pass of its own with its rows written; with ``'spans'`` a later block sees the text
    that earlier blocks left."""
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action {action!r}")
    at = docs.columns.index(text)
    for block, _, last in _blocks(benchmark, n, item_id, item_text, block_words):
        docs = docs.mapInArrow(_cleaner(block, action, at), docs.schema)
        if not last:
            docs = written(docs, "benchmark-block")
    return docs
