"""Fill-in-middle transformation over a learned rank index (operator 11).

A text is a row of units: a maximal run of the letters A-Z and a-z, or any other
single character.  Two ranks drawn from a hash of the document's id cut it into
prefix, middle and suffix, which are written back in another order.

To cut at a rank is to find the offset where that unit begins.  The
offsets of all boundaries grow almost evenly, so a ``RankIndex`` keeps lines
instead of them: a shrinking cone of slopes is carried along the boundaries as
long as one line stays within ``ERROR`` bytes of each, and a new line begins
where the cone closes.  A rank is looked up by predicting its offset on its line
and adding the residual stored for it (one signed byte), which is exact.

Texts are handled one at a time inside an Arrow pass over the documents: no
shuffle, and memory of a small multiple of the longest text.

Edge cases: null counts as the empty text, which is plain; a row without an id
draws from the empty id; rows that repeat an id and text come out alike; a text
that holds one of the marks stays plain, so every output can be undone; only
the named columns are read, so further ones cannot clash; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import slices, utf8_parts

ERROR = 96  # bytes a line may be off; with rounding a residual fits a signed byte
_STRETCH = 512  # boundaries looked at in one step of the cone

# The marks before the three parts, and the shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = 1

SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("n_lines", T.IntegerType()),
    T.StructField("output", T.StringType()),
])


def boundaries(text: bytes) -> np.ndarray:
    """Byte offset where each unit of a UTF-8 text begins, and the text's end."""
    data = np.frombuffer(text, np.uint8)
    letter = ((data | 32) - np.uint8(97)) < 26
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.append(np.flatnonzero(begins), len(data))


@dataclass
class RankIndex:
    """Lines through the offsets of the ranks 0, 1, 2, ...; line ``k`` holds the
    ranks from ``first[k]`` on, begins at ``base[k]`` and rises by ``slope[k]``."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> "RankIndex":
        first, slope = [], []
        at, n = 0, len(offsets)
        while at < n:
            low, high = -np.inf, np.inf
            begin, end = at + 1, 0
            while begin < n and not end:
                ranks = np.arange(begin, min(n, begin + _STRETCH))
                steps = ranks - at
                rise = offsets[ranks] - offsets[at]
                highs = np.minimum.accumulate(np.minimum((rise + error) / steps, high))
                lows = np.maximum.accumulate(np.maximum((rise - error) / steps, low))
                closed = np.flatnonzero(lows > highs)
                used = int(closed[0]) if len(closed) else len(ranks)
                if used:
                    low, high = float(lows[used - 1]), float(highs[used - 1])
                if len(closed):
                    end = int(ranks[used])
                begin += len(ranks)
            first.append(at)
            slope.append((low + high) / 2 if np.isfinite(high) else 0.0)
            at = end or n
        first, slope = np.array(first, np.int64), np.array(slope)
        index = cls(first, offsets[first], slope, np.zeros(0, np.int8))
        residual = offsets - index._predicted(np.arange(n))
        assert n == 0 or np.abs(residual).max() <= 127
        index.residual = residual.astype(np.int8)
        return index

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[line] + np.rint(self.slope[line] * (ranks - self.first[line])).astype(np.int64)

    def offset(self, rank: int) -> int:
        """The exact offset at a rank."""
        return int(self._predicted(np.array([rank]))[0]) + int(self.residual[rank])


def _draws(seed: int, doc_id: str | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def _chars(part: bytes) -> int:
    return len(part.decode("utf-8"))


def _rearranged(doc_id: str | None, text: bytes, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, n_lines, output) of one text."""
    offsets = boundaries(text)
    n = len(offsets) - 1
    a, b, fim, spm = _draws(seed, doc_id)
    if not text or fim % 100 >= fim_percent or any(m in text for m in _MARKS):
        return n, "plain", None, None, 0, text
    index = RankIndex.fit(offsets)
    one, two = (index.offset(rank) for rank in sorted((a % (n + 1), b % (n + 1))))
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    p, s, m = _MARKS
    form = "spm" if spm % 100 < spm_percent else "psm"
    out = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    return n, form, _chars(prefix), _chars(middle), len(index.first), out


def _transformer(seed: int, fim_percent: int, spm_percent: int):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                ids = batch.column(0).to_pylist()
                rows = [_rearranged(i, t, seed, fim_percent, spm_percent) for i, t in zip(ids, utf8_parts(batch.column(1)), strict=True)]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=SCHEMA.names)

    return run


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per row ``doc_id, n`` (units), ``form`` (plain, psm or spm), the lengths
    of prefix and middle in characters, ``n_lines`` of the index and ``output``."""
    narrow = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    out = narrow.mapInArrow(_transformer(seed, fim_percent, spm_percent), SCHEMA)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output was made of.  None of the three parts holds a
    mark, and a mark cannot arise where two of them meet."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """Lengths of the parts, and digests of the output and of the text restored from it."""
    found = transform(docs, **options)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"), "n_lines")
