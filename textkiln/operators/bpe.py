"""Byte-level BPE as Spark jobs.

Training (``train_bpe``)
    Corpus lines -> pretokens -> ``groupBy`` counts -> the word table
    ``(syms, freq)``, symbols packed as 32-bit integers, and the pair table ``(pair, cnt)``, both kept as written
    tables across rounds.  Each round brings the ordered head of the pair table
    to the driver.
    Words are split wherever a pair is not in the head; equal segments are
    summed by Spark, and the driver learns merges one at a time from the
    segments, whose size is bounded (``MAX_SYMBOLS``; a shorter head gives
    less).  An Arrow pass then applies the merges to the words that hold a
    learned pair, passes all others on as they are, and emits the touched words' old
    pairs with a negative and their new ones with a positive sign; the pair
    table is summed with these deltas and never counted again.
    Words reduced to one symbol leave the working set, and so do pairs rarer than the minimum:
    only pairs with a new symbol can gain.

    This equals one-merge-at-a-time training: pairs are ordered by count
    descending, then by smallest ``(left, right)``.  A pair behind the head
    cannot gain occurrences, and a pair that a merge creates across it has no
    larger count and a larger key, so it ranks behind the head's last pair,
    too.  A round ends when the best pair ranks behind that pair.  Merges
    inside a span that no merge crosses depend on its bytes alone, so no text
    is learned twice and every merge has a new id.

Encoding (``encode_documents``)
    Per document, never per line: an Arrow pass cuts ``text + "\\n\\n"`` into words over
    the bytes themselves and merges each part's distinct words by rank, all unknown
    ones at once, with a per-task word cache.  No shuffle and no join, so a hot
    word costs a cache hit.  The merge table is broadcast; its size is bounded
    by the vocabulary size.

Decoding (``decode_ids``)
    An Arrow pass takes the tokens' bytes by id (a table bounded by the
    vocabulary size) and joins them per row; Spark makes them UTF-8 with
    invalid sequences replaced.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.arrow_parts import parts
from textkiln.functions.bytelevel import (
    BYTE_CHAR,
    BYTE_ID,
    CHAR_BYTE,
    FIRST_MERGE_ID,
    ID_BYTE,
    SPECIAL_ID,
    SPECIAL_TOKEN,
)
from textkiln.operators.pretokens import (
    MIN_FREQUENCY,
    PAIR_SHIFT,
    char_classes,
    cut_parts,
    cuttable,
    line_pretoken_counts,
    multi_symbol_words,
)
from textkiln.functions.text import frame_document
from textkiln.session import materialised
from textkiln.sources.seeds import require_nonempty

# Reference training parameters.
VOCAB_SIZE = 8000

MERGES_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("left_id", T.IntegerType()),
    T.StructField("right_id", T.IntegerType()),
    T.StructField("new_id", T.IntegerType()),
    T.StructField("token", T.StringType()),
])
VOCAB_SCHEMA = T.StructType([
    T.StructField("token_id", T.IntegerType()),
    T.StructField("token", T.StringType()),
])


class VocabularyMismatch(ValueError):
    """T5: encoded data and tokenizer disagree."""


@dataclass
class BpeModel:
    merges: list[tuple[int, int, int]]  # (left_id, right_id, new_id) in rank order
    rounds: int = 0

    @property
    def vocab_size(self) -> int:
        return FIRST_MERGE_ID + len(self.merges)

    def tokens(self) -> dict[int, str]:
        tok = {SPECIAL_ID: SPECIAL_TOKEN}
        for b, i in BYTE_ID.items():
            tok[i] = BYTE_CHAR[b]
        for l, r, n in self.merges:
            tok[n] = tok[l] + tok[r]
        return tok

    def merges_df(self, spark: SparkSession) -> DataFrame:
        tok = self.tokens()
        rows = [(k, l, r, n, tok[n]) for k, (l, r, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.tokens().items()), VOCAB_SCHEMA)

    # File forms of the two artefacts.
    def vocab_json(self) -> str:
        return json.dumps({t: i for i, t in sorted(self.tokens().items())}, ensure_ascii=False)

    def merges_txt(self) -> str:
        tok = self.tokens()
        return "#version: 0.2\n" + "".join(f"{tok[l]} {tok[r]}\n" for l, r, _ in self.merges)

    @classmethod
    def from_files(cls, vocab_json: str, merges_txt: str) -> "BpeModel":
        vocab = json.loads(vocab_json)
        merges = []
        for line in merges_txt.splitlines():
            if line.startswith("#version") or not line.strip():
                continue
            a, b = line.split(" ")
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        return cls(merges)


# ----------------------------------------------------------------- training
# Symbols of the distinct segments that the driver learns from in a round.
MAX_SYMBOLS = 1_000_000
HEAD_ROWS = 16384
FIRST_ROWS = 64  # of the first round, where nearly all words hold every pair of the head


def _flat(syms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a list column, each row's start, and for each symbol whether
    the next one belongs to the same row."""
    flat = syms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = syms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    inner = np.ones(len(flat), bool)
    inner[ends[sizes > 0] - 1] = False
    return flat, ends - sizes, inner


def _packed(syms: pa.ListArray) -> pa.BinaryArray:
    """Each row's symbols as the bytes of 32-bit integers, which Spark moves and writes as they are."""
    flat = syms.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    sizes = syms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
    return pa.Array.from_buffers(pa.binary(), len(syms), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])


def _unpacked(rows: pa.BinaryArray) -> pa.ListArray:
    rows = rows.cast(pa.binary())
    _, offsets, data = rows.buffers()
    ends = np.frombuffer(offsets, np.int32)[rows.offset : rows.offset + len(rows) + 1] if len(rows) else np.zeros(1, np.int32)
    flat = np.frombuffer(data, np.int32, (ends[-1] - ends[0]) // 4, ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array((ends - ends[0]) // 4), pa.array(flat))


def _packed_words(batches):
    """``(token, freq)`` -> ``(syms, freq)``."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([_packed(_byte_syms(batch.column(0).cast(pa.string()))), batch.column(1)], names=["syms", "freq"])


def _summed(pairs: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, which, freqs)
    return found[sums != 0], sums[sums != 0]


def _pairs(batches):
    """``(syms, freq)`` -> ``(pair, cnt)``, summed for each batch."""
    for batch in batches:
        found = _summed(*_pair_sums(_unpacked(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False), 1))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["pair", "cnt"])


def _segments(head: np.ndarray):
    """Segments of two or more symbols whose adjacent pairs are all in the head."""

    def run(batches):
        for batch in batches:
            flat, starts, inner = _flat(_unpacked(batch.column(0)))
            if not len(flat):
                continue
            keys = flat[:-1] * PAIR_SHIFT + flat[1:]
            at = np.minimum(np.searchsorted(head, keys), len(head) - 1)
            joined = inner[:-1] & (head[at] == keys)
            begins = np.flatnonzero(np.concatenate([[True], ~joined]))
            ends = np.append(begins[1:], len(flat))
            rows = np.searchsorted(starts, begins, side="right") - 1
            long = ends - begins >= 2
            begins, ends, rows = begins[long], ends[long], rows[long]
            sizes = ends - begins
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            values = flat[np.arange(offsets[-1]) + np.repeat(begins - offsets[:-1], sizes)]
            segs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([_packed(segs), batch.column(1).take(pa.array(rows))], names=["syms", "freq"])

    return run


def _merged(syms: list[int], left: int, right: int, new: int) -> list[int]:
    out, i, n = [], 0, len(syms)
    while i < n:
        if syms[i] == left and i + 1 < n and syms[i + 1] == right:
            out.append(new)
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


def learn_merges(segments, last: tuple[int, int], budget: int, first_id: int) -> list[tuple[int, int, int]]:
    """At most ``budget`` merges in sequential order, while the best pair does
    not rank behind ``last`` (``(-count, pair)``)."""
    words, freqs = segments
    counts: dict[int, int] = defaultdict(int)
    where: dict[int, set[int]] = defaultdict(set)
    for w, (syms, freq) in enumerate(zip(words, freqs, strict=True)):
        for l, r in zip(syms, syms[1:], strict=False):
            counts[l * PAIR_SHIFT + r] += freq
            where[l * PAIR_SHIFT + r].add(w)
    heap = [(-c, p) for p, c in counts.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int, int]] = []
    while heap and len(merges) < budget:
        best = heapq.heappop(heap)
        count, pair = -best[0], best[1]
        now = counts.get(pair, 0)
        if now != count:
            if now > 0:
                heapq.heappush(heap, (-now, pair))
            continue
        if best > last:
            break
        left, right = pair // PAIR_SHIFT, pair % PAIR_SHIFT
        new = first_id + len(merges)
        merges.append((left, right, new))
        gained = set()
        for w in where.pop(pair):
            old, freq = words[w], freqs[w]
            now_syms = _merged(old, left, right, new)
            if len(now_syms) == len(old):
                continue
            words[w] = now_syms
            for l, r in zip(old, old[1:], strict=False):
                counts[l * PAIR_SHIFT + r] -= freq
            for l, r in zip(now_syms, now_syms[1:], strict=False):
                key = l * PAIR_SHIFT + r
                counts[key] += freq
                if l == new or r == new:
                    where[key].add(w)
                    gained.add(key)
        counts.pop(pair, None)
        for key in gained:
            heapq.heappush(heap, (-counts[key], key))
    return merges


WORD, DELTA = 0, 1
_APPLIED = T.StructType([
    T.StructField("kind", T.IntegerType()),
    T.StructField("syms", T.BinaryType()),
    T.StructField("pair", T.LongType()),
    T.StructField("freq", T.LongType()),
])


def _pair_sums(syms: pa.ListArray, freqs: np.ndarray, sign: int) -> tuple[np.ndarray, np.ndarray]:
    """Adjacent pairs of the words and their signed frequencies, one entry for each place."""
    flat, starts, inner = _flat(syms)
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(inner[:-1])
    rows = np.searchsorted(starts, at, side="right") - 1
    return flat[at] * PAIR_SHIFT + flat[at + 1], sign * freqs[rows]


def _rows(kind: int, syms: pa.Array | None, pairs: np.ndarray | None, freqs) -> pa.RecordBatch:
    n = len(freqs)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int32)),
        pa.nulls(n, pa.binary()) if syms is None else syms,
        pa.nulls(n, pa.int64()) if pairs is None else pa.array(pairs),
        pa.array(freqs, pa.int64()),
    ], names=_APPLIED.names)


def _apply(merges: list[tuple[int, int, int]]):
    """The word table after the merges and the changes of pair counts.  Each
    merge makes a new symbol, so taking the lowest rank first is the
    sequential order.  Words that hold no learned pair pass as they are."""
    table = _Merges({(l, r): (k, n) for k, (l, r, n) in enumerate(merges)})
    keys = np.sort(np.array([l * PAIR_SHIFT + r for l, r, _ in merges], np.int64))

    def run(batches):
        for batch in batches:
            syms = _unpacked(batch.column(0))
            flat, starts, inner = _flat(syms)
            if not len(flat):
                continue
            pairs = flat[:-1] * PAIR_SHIFT + flat[1:]
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            hits = np.flatnonzero(inner[:-1] & (keys[at] == pairs))
            held = np.zeros(len(batch), bool)
            held[np.searchsorted(starts, hits, side="right") - 1] = True
            same = batch.filter(pa.array(~held))
            if len(same):
                yield _rows(WORD, same.column(0), None, same.column(1))
            if not held.any():
                continue
            touched, weights = syms.filter(pa.array(held)), batch.column(1).filter(pa.array(held))
            freqs = weights.to_numpy(zero_copy_only=False)
            merged = table.apply(touched)
            changed = [_pair_sums(touched, freqs, -1), _pair_sums(merged, freqs, 1)]
            yield _rows(DELTA, None, *_summed(*(np.concatenate(c) for c in zip(*changed, strict=True))))
            long = pa.array(merged.value_lengths().to_numpy(zero_copy_only=False) >= 2)
            yield _rows(WORD, _packed(merged.filter(long)), None, weights.filter(long))

    return run


def training_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Word table of the training corpus (lines mode), words of two or more
    bytes only (a single byte never takes part in a pair)."""
    return multi_symbol_words(line_pretoken_counts(docs, text_col))


def train_bpe(
    docs: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    head_rows: int = HEAD_ROWS,
    max_symbols: int = MAX_SYMBOLS,
    text_col: str = "text",
) -> BpeModel:
    """Learn merges until ``vocab_size`` entries or the best pair is rarer
    than ``min_frequency``."""
    require_nonempty(docs, "training corpus")  # S3
    model = BpeModel([])
    tokens = line_pretoken_counts(docs, text_col).where(F.octet_length("token") >= 2)
    words = materialised(tokens.mapInArrow(_packed_words, "syms binary, freq long"), "bpe-words")
    pairs = words.mapInArrow(_pairs, "pair long, cnt long").groupBy("pair").agg(F.sum("cnt").alias("cnt"))
    counts = materialised(pairs.where(F.col("cnt") >= min_frequency), "bpe-pairs")
    size = min(head_rows, FIRST_ROWS)
    while model.vocab_size < vocab_size:
        head = counts.orderBy(F.col("cnt").desc(), F.col("pair").asc()).limit(size).collect()
        if not head:
            break
        while True:
            taken = head[:size]
            known = np.sort(np.array([r["pair"] for r in taken], np.int64))
            found = words.mapInArrow(_segments(known), words.schema).groupBy("syms").agg(F.sum("freq").alias("freq")).persist()
            symbols = found.agg(F.sum(F.octet_length("syms"))).first()[0] // 4
            if symbols <= max_symbols or len(taken) == 1:
                break
            found.unpersist()
            size = max(1, len(taken) // 4)
        table = found.toArrow()
        found.unpersist()
        last = (-int(taken[-1]["cnt"]), int(taken[-1]["pair"]))
        learned = learn_merges(([row for c in table["syms"].chunks for row in _unpacked(c).to_pylist()], table["freq"].to_pylist()), last, vocab_size - model.vocab_size, model.vocab_size)
        model.merges += learned
        model.rounds += 1
        # A longer head where there is room: fewer rounds, each a pass over the words.
        if symbols * 16 < max_symbols:
            size = min(head_rows, size * 8)
        elif symbols * 4 < max_symbols:
            size = min(head_rows, size * 2)
        if model.vocab_size < vocab_size:
            applied = materialised(words.mapInArrow(_apply(learned), _APPLIED), "bpe-applied")
            words = applied.where(F.col("kind") == WORD).select("syms", "freq")
            deltas = applied.where(F.col("kind") == DELTA).select("pair", F.col("freq").alias("cnt"))
            counts = materialised(counts.unionByName(deltas).groupBy("pair").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= min_frequency), "bpe-pairs")
    return model


# ----------------------------------------------------------------- merging words
# Longer words are merged with a queue, one by one; all others at once, a merge of each in a step.
SHORT_WORD = 48
# Words that are merged at once.
PART_ROWS = 16_384
NO_RANK = np.iinfo(np.int32).max


class _Merges:
    """Merges by rank as sorted arrays, for many words at once."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        rows = sorted((l * PAIR_SHIFT + r, k, n) for (l, r), (k, n) in ranks.items())
        table = np.array(rows, np.int64).reshape(-1, 3)
        # A key that no pair has, so that a search always ends inside.
        self.keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.ranks = np.append(table[:, 1], NO_RANK).astype(np.int32)
        self.by_rank = np.zeros(int(table[:, 1].max(initial=-1)) + 1, np.int64)
        self.by_rank[table[:, 1]] = table[:, 2]
        self.plain = ranks

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left * PAIR_SHIFT + right
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)

    def apply(self, syms: pa.ListArray) -> pa.ListArray:
        """``_lowest_first`` of every row."""
        return pa.concat_arrays([self._part(syms.slice(i, PART_ROWS)) for i in range(0, max(1, len(syms)), PART_ROWS)])

    def _part(self, syms: pa.ListArray) -> pa.ListArray:
        sizes = syms.value_lengths().to_numpy(zero_copy_only=False)
        long = sizes > SHORT_WORD
        if long.any():
            short = self._part(syms.filter(pa.array(~long)))
            rest = pa.array([_queued(row, self.plain) for row in syms.filter(pa.array(long)).to_pylist()], pa.list_(pa.int32()))
            order = np.empty(len(syms), np.int64)
            order[np.concatenate([np.flatnonzero(~long), np.flatnonzero(long)])] = np.arange(len(syms))
            return pa.concat_arrays([short, rest]).take(pa.array(order))
        flat, _, inner = _flat(syms)
        flat = flat.copy()
        rows, sizes = np.flatnonzero(sizes > 0), sizes[sizes > 0].astype(np.int64)
        # The rank of each symbol's pair with the next one.
        rank = np.full(len(flat), NO_RANK, np.int32)
        at = np.flatnonzero(inner[:-1])
        rank[at] = self._ranks(flat[at], flat[at + 1])
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(rows):
            ends = np.cumsum(sizes)
            best = np.minimum.reduceat(rank, ends - sizes)
            done = best == NO_RANK
            if 4 * done.sum() >= len(rows):
                of_done = np.repeat(done, sizes)
                kept.append((rows[done], sizes[done], flat[of_done]))
                flat, rank = flat[~of_done], rank[~of_done]
                rows, sizes, best, done = rows[~done], sizes[~done], best[~done], done[~done]
                ends = np.cumsum(sizes)
            best[done] = -1
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            if not len(hits):
                continue
            # Of equal symbols in a row, every second pair from the left.
            fresh = np.append(True, np.diff(hits) != 1)
            place = np.arange(len(hits))
            hits = hits[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            flat[hits] = self.by_rank[rank[hits]]
            keep = np.ones(len(flat), bool)
            keep[hits + 1] = False
            flat, rank = flat[keep], rank[keep]
            sizes = sizes - np.bincount(np.searchsorted(ends, hits, side="right"), minlength=len(rows))
            merged = hits - np.arange(len(hits))  # their places once the others are gone
            changed = np.concatenate([merged, np.maximum(merged - 1, 0)])
            rank[changed] = self._ranks(flat[changed], flat[np.minimum(changed + 1, len(flat) - 1)])
            rank[np.cumsum(sizes) - 1] = NO_RANK
        rows, sizes, flat = (np.concatenate(c) for c in zip(*kept, strict=True))
        lengths = np.zeros(len(syms), np.int64)
        lengths[rows] = sizes
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(len(flat), np.int32)
        out[np.arange(len(flat)) + np.repeat(offsets[rows] - (np.cumsum(sizes) - sizes), sizes)] = flat
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))


def _lowest_first(syms: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the merge of the lowest rank everywhere until none is left."""
    if len(syms) > SHORT_WORD:
        return _queued(syms, ranks)
    while len(syms) > 1:
        best = None
        for i in range(len(syms) - 1):
            r = ranks.get((syms[i], syms[i + 1]))
            if r is not None and (best is None or r[0] < best[0]):
                best = (r[0], r[1], syms[i], syms[i + 1])
        if best is None:
            break
        syms = _merged(syms, best[2], best[3], best[1])
    return syms


def _queued(syms: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same over a linked list of symbols and a queue of (rank, place).  A
    new symbol's pairs rank behind the merge that made it, so the queue yields
    the places of one rank from left to right."""
    syms = list(syms)
    n = len(syms)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(r[0], i) for i, pair in enumerate(zip(syms, syms[1:], strict=False)) if (r := ranks.get(pair)) is not None]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        if syms[i] < 0 or j >= n:
            continue
        found = ranks.get((syms[i], syms[j]))
        if found is None or found[0] != rank:
            continue
        syms[i], syms[j] = found[1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((syms[i], syms[k]))) is not None:
                heapq.heappush(queue, (r[0], i))
        h = before[i]
        if h >= 0 and (r := ranks.get((syms[h], syms[i]))) is not None:
            heapq.heappush(queue, (r[0], h))
    return [s for s in syms if s >= 0]


_ID_OF_BYTE = np.array([BYTE_ID[b] for b in range(256)], np.int32)


def _byte_syms(words: pa.StringArray) -> pa.ListArray:
    """Each word's UTF-8 bytes as ids."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(_ID_OF_BYTE[held]))


class _encoder:
    """Ids of words, with a cache for the task: its words and their ids as arrays."""

    MOST = 200_000

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        self.merges = _Merges(ranks)
        self.words = pa.array([], pa.string())
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __call__(self, word: str) -> list[int]:
        starts, sizes, ids = self.many(pa.array([word]), np.ones(1, np.int64))
        return ids[starts[0] : starts[0] + sizes[0]].tolist()

    def many(self, words: pa.StringArray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and number of each word's ids, and the ids they lie in.  Words
        that occur again (``counts``) are kept, most others never come back."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        missed = at < 0
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[~missed], sizes[~missed] = self.starts[at[~missed]], self.sizes[at[~missed]]
        if not missed.any():
            return starts, sizes, self.ids
        new = words.filter(pa.array(missed))
        found, begins, _ = _flat(self.merges.apply(_byte_syms(new)))
        lengths = np.diff(np.append(begins, len(found)))
        ids = np.concatenate([self.ids, found.astype(np.int32)])
        starts[missed], sizes[missed] = begins + len(self.ids), lengths
        keep = np.flatnonzero(counts[missed] >= 2)[: max(0, self.MOST - len(self.words))]
        if len(keep):
            held = lengths[keep]
            ends = np.cumsum(held)
            self.words = pa.concat_arrays([self.words, new.take(pa.array(keep))])
            self.starts = np.concatenate([self.starts, ends - held + len(self.ids)])
            self.sizes = np.concatenate([self.sizes, held])
            self.ids = np.concatenate([self.ids, found[np.arange(held.sum()) + np.repeat(begins[keep] - (ends - held), held)].astype(np.int32)])
        return starts, sizes, ids


def _encode_batch(batch, encode_word):
    """One Arrow batch ``(key, segs list<list<string>>)`` -> ``(key, ids)``.

    Distinct words of the batch are encoded together (cached across
    batches); occurrences are gathered with numpy.  Documents that contain the
    special token (more than one segment) take the plain loop."""
    keys, segs = batch.column(0), batch.column(1)
    seg_counts = pc.fill_null(pc.list_value_length(segs), 0).to_numpy(zero_copy_only=False)
    if len(seg_counts) and seg_counts.max() > 1:
        out = []
        for doc in segs.to_pylist():
            ids: list[int] = []
            for j, seg in enumerate(doc or []):
                if j:
                    ids.append(SPECIAL_ID)
                for w in seg:
                    ids.extend(encode_word(w))
            out.append(ids)
        return pa.RecordBatch.from_arrays([keys, pa.array(out, pa.list_(pa.int32()))], names=[batch.schema.names[0], "ids"])
    inner = segs.flatten()
    word_counts = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = inner.flatten()
    if len(words):
        d = pc.dictionary_encode(words)
        idx = d.indices.to_numpy(zero_copy_only=False)
        ustart, ulen, uflat = encode_word.many(d.dictionary, np.bincount(idx, minlength=len(d.dictionary)))
        occ_len = ulen[idx]
        occ_start = ustart[idx]
        out_start = np.cumsum(occ_len) - occ_len
        flat = uflat[np.arange(int(occ_len.sum())) - np.repeat(out_start - occ_start, occ_len)]
    else:
        occ_len = np.zeros(0, dtype=np.int64)
        flat = np.zeros(0, dtype=np.int32)
    cum = np.concatenate([[0], np.cumsum(occ_len)])
    seg_end = np.cumsum(word_counts)
    seg_tok = cum[seg_end] - cum[seg_end - word_counts]
    doc_tok = np.zeros(len(seg_counts), dtype=np.int64)
    doc_tok[seg_counts == 1] = seg_tok
    offsets = np.concatenate([[0], np.cumsum(doc_tok)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
    return pa.RecordBatch.from_arrays([keys, ids], names=[batch.schema.names[0], "ids"])


# Words whose ids are gathered at once (each takes some 100 bytes meanwhile).
PART_WORDS = 500_000


def _n_words(segs: pa.ListArray) -> np.ndarray:
    """Words of each row, over all its segments."""
    words = pc.fill_null(pc.list_value_length(segs.flatten()), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(segs), 0).to_numpy(zero_copy_only=False))
    upto = np.concatenate([[0], np.cumsum(words)])[np.concatenate([[0], ends])]
    return np.diff(upto)


def _encode_batches_fn(bc_ranks):
    def run(batches):
        encode_word = _encoder(bc_ranks.value)
        for batch in batches:
            for part in parts(batch, _n_words(batch.column(1)), PART_WORDS):
                yield _encode_batch(part, encode_word)

    return run


def _segmented(batches, classes: np.ndarray):
    """``(key, text)`` -> ``(key, segs list<list<string>>)``, one segment a text: a tokenizer
    loaded from its two files registers no special token, which is ordinary text."""
    for batch in batches:
        for part, words in cut_parts(batch, classes, lines=False):
            segs = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32)), words)
            yield pa.RecordBatch.from_arrays([part.column(0), segs], names=[part.schema.names[0], "segs"])


def encode_texts(model: BpeModel, df: DataFrame, key: str, text: Column, frame: bool = True) -> DataFrame:
    """``(key, ids array<int>)`` for every row; ``frame`` appends the
    document separator ``"\\n\\n"`` before encoding (corpus form)."""
    spark = df.sparkSession
    ranks = {(l, r): (k, n) for k, (l, r, n) in enumerate(model.merges)}
    bc = spark.sparkContext.broadcast(ranks)
    table = char_classes(spark)
    encode = _encode_batches_fn(bc)

    def run(batches):
        return encode(_segmented(batches, np.frombuffer(table.value, np.uint8)))

    body = frame_document(text) if frame else text
    staged = df.select(F.col(key), cuttable(body).alias("text"))
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return staged.mapInArrow(run, schema)


def encode_documents(model: BpeModel, docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    return encode_texts(model, docs, key, F.col(text_col), frame=True)


# ----------------------------------------------------------------- decoding
# Ids whose bytes are gathered at once.
PART_IDS = 1_000_000


def _token_bytes(model: BpeModel) -> list[bytes]:
    """The bytes of each token by id (ids are dense from 0)."""
    tok = model.tokens()
    tok[SPECIAL_ID] = SPECIAL_TOKEN
    return [bytes(CHAR_BYTE[c] for c in tok[i]) for i in range(model.vocab_size)]


def _joined(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """Each row's tokens joined: taken in order, their bytes lie one after the
    other, so only the rows' offsets are new.  Null and unknown ids are empty."""
    flat = ids.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
    taken = tokens.take(pc.if_else(known, flat, None))
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    _, offsets, data = taken.buffers()
    starts = np.frombuffer(offsets, np.int64, len(taken) + 1 + taken.offset)[taken.offset:] if len(taken) else np.zeros(1, np.int64)
    out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(starts[ends]), data if data is not None else pa.py_buffer(b"")])
    return pc.if_else(ids.is_valid(), out, None)


def decode_ids(model: BpeModel, ids: Column) -> Column:
    """Ids -> text; id 0 is the text of the special token."""
    table = _token_bytes(model)

    @F.arrow_udf("binary")
    def joined(column: pa.Array) -> pa.Array:
        tokens = pa.array(table, pa.large_binary())
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        batch = pa.record_batch([column], names=["ids"])
        done = [_joined(p.column(0), tokens) for p in parts(batch, sizes, PART_IDS)]
        return pa.concat_arrays(done).cast(pa.binary()) if done else pa.array([], pa.binary())

    return F.make_valid_utf8(joined(ids).cast("string"))


def check_vocabulary(model_vocab_size: int, data_vocab_size: int, max_id: int | None) -> None:
    """T5: the encoded data must fit the tokenizer it will be used with."""
    if model_vocab_size != data_vocab_size:
        raise VocabularyMismatch(f"model expects {model_vocab_size} tokens, data was encoded with {data_vocab_size}")
    if max_id is not None and max_id >= model_vocab_size:
        raise VocabularyMismatch(f"token id {max_id} outside a vocabulary of {model_vocab_size}")
