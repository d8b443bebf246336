"""Token ids as ORC tables (operator 12).

Texts are encoded with a tokenizer of the ``tokenizers`` library, an end id is
appended to each, and the rows go to ORC files in ascending id order:

    doc_id, shard int, local_start bigint, n_tokens int, ids array<int>

* ORC stores the integer columns in run-length encoding and zstd blocks, in stripes of
  ``STRIPE_BYTES``, which Spark hands to different tasks.
* Each stripe carries a row index (minimum and maximum of each column for every
  ``INDEX_ROWS`` rows) and a Bloom filter on ``doc_id`` for the same groups; a lookup by
  id (``documents``) is pushed to the reader, which skips what cannot match.
* ``shard`` numbers the range partitions in id order and ``local_start`` counts
  the ids before a row in its shard.  The start of a row in the whole output is its shard's start plus
  ``local_start``; the shards' starts are one row for each file.

The documents are dealt by ranges of (id, hash of the text, row), so the texts of one
id may spread over shards; they are encoded after that one shuffle, once.

Edge cases: null and empty texts are the end id alone; rows without an id
come first; rows that repeat an id follow each other in the order of their texts'
hashes, equal rows in any; texts of any length are encoded word by word, so
that memory follows their bytes; only the named columns are read, so
further ones cannot clash; an empty table gives an empty output.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.bytelevel import to_bytelevel
from textkiln.llm.common import slices

END_ID = 1
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
BLOOM_FPP = 0.01
CACHE_WORDS = 300_000  # words whose ids a Python worker keeps, of CACHE_CHARS characters at most
CACHE_CHARS = 40


def schema_of(doc_id: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", doc_id),
        T.StructField("shard", T.IntegerType()),
        T.StructField("local_start", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])


# The parts of a tokenizer that ``WordEncoder`` takes apart, and its
# word pattern written for lower-case characters below U+0180.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_L, _N = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾"
_PARTS = f"('s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_L}{_N}]+)"
_PLAIN = "^[!-~¡-įı-ſ]+$"  # without U+0130, whose lower case is two characters
_RAW = "\0"  # before a word that is encoded whole


class WordEncoder:
    """Ids of the words of texts (what stands between white space), each
    distinct part of a word encoded once.

    Words of characters below U+0180 without a special token are lower-cased
    and split by the tokenizer's own pattern here, and its model gives the ids
    of each part; normalization changes nothing else in them.  All other words
    go through the whole tokenizer."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        self.model = self.whole.model
        self.known: dict[str, list[int]] = {}
        spec = json.loads(self.whole.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        #: White space separates tokens and is dropped.
        self.by_words = spec["normalizer"] == _NORMALIZER and [p["type"] for p in parts] == ["Split", "ByteLevel"] and (
            parts[0]["pattern"] == {"Regex": _SPLIT} and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
            and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"] and not any(c.isspace() for t in self.special for c in t))

    def ids_of(self, part: str) -> list[int]:
        ids = self.known.get(part)
        if ids is None:
            if part.startswith(_RAW):
                ids = self.whole.encode(part[1:], add_special_tokens=False).ids
            else:
                ids = [t.id for t in self.model.tokenize(part if part.isascii() else to_bytelevel(part))]
            if len(part) <= CACHE_CHARS:
                if len(self.known) >= CACHE_WORDS:
                    self.known.clear()
                self.known[part] = ids
        return ids

    def parts(self, words: pa.Array) -> pa.ListArray:
        """Each word as the parts that ``ids_of`` takes."""
        plain = pc.match_substring_regex(words, _PLAIN)
        for special in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, special))
        apart = pc.replace_substring_regex(pc.utf8_lower(words), _PARTS, r"\1 ")
        return pc.ascii_split_whitespace(pc.if_else(plain, apart, pc.binary_join_element_wise(_RAW, words, "")))


def _ragged(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists (``flat`` values of ``sizes``) put one after another in ``order``: values and sizes."""
    begin = np.cumsum(sizes) - sizes
    lengths = sizes[order]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(begin[order] - ends + lengths, lengths)], lengths


def _indices(encoded: pa.DictionaryArray) -> np.ndarray:
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


@functools.lru_cache(maxsize=2)
def _encoder_of(tokenizer: str) -> WordEncoder:
    """One for all tasks that a Python worker runs after each other."""
    return WordEncoder(tokenizer)


def encode_batch(encoder: WordEncoder, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts with the end id after each, number of ids of each).

    Where tokens span no white space and normalization does not look across
    it, a text's ids are those of its words; else texts are encoded whole."""
    texts = pc.fill_null(texts, "")
    if not encoder.by_words:
        found = [[*(encoder.whole.encode(t, add_special_tokens=False).ids if t else ()), end_id] for t in texts.to_pylist()]
        sizes = np.array([len(f) for f in found], np.int64)
        return np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes.sum())), sizes
    split = pc.ascii_split_whitespace(texts)
    words = pc.dictionary_encode(split.flatten())
    in_word = encoder.parts(words.dictionary)
    parts = pc.dictionary_encode(in_word.flatten())
    held = list(map(encoder.ids_of, parts.dictionary.to_pylist()))
    size = np.fromiter(map(len, held), np.int64, len(held))
    flat = np.fromiter(itertools.chain.from_iterable(held), np.int32, int(size.sum()))
    of_parts, n = _ragged(flat, size, _indices(parts))
    last = np.cumsum(_lengths(in_word))
    total = np.concatenate([[0], np.cumsum(n)])
    # The end id is one more word after each text's own.
    of_words = np.append(of_parts, np.int32(end_id))
    word_size = np.append(total[last] - total[last - _lengths(in_word)], 1)
    n_words = _lengths(split)
    order = np.insert(_indices(words), np.cumsum(n_words), len(word_size) - 1)
    ids, n = _ragged(of_words, word_size, order)
    ends = np.cumsum(n)[np.cumsum(n_words + 1) - 1] if len(n_words) else np.zeros(0, np.int64)
    return ids, np.diff(ends, prepend=0)


def _encoder(tokenizer: str, end_id: int):
    def run(batches):
        # A task is one of several on its machine; threads of its own would compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder_of(tokenizer)
        shard, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, 1):
                values, sizes = encode_batch(encoder, batch.column(1), end_id)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int32()))
                columns = [batch.column(0), pa.array([shard] * len(batch), pa.int32()), pa.array(before + starts[:-1], pa.int64()), pa.array(sizes, pa.int32()), ids]
                before += int(starts[-1])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "local_start", "n_tokens", "ids"])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
          stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Encode ``docs`` into ORC files under ``path``; ``tokenizer`` is the file
    of a tokenizer that every executor can open."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_h"), F.monotonically_increasing_id().alias("_row"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(shards, "doc_id", "_h", "_row").sortWithinPartitions("doc_id", "_h", "_row").select("doc_id", "text")
    encoded = dealt.mapInArrow(_encoder(tokenizer, end_id), schema_of(docs.schema[doc_id].dataType))
    (
        encoded.write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP).orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, in no order."""
    return spark.read.orc(path)


def shards(tokens: DataFrame) -> DataFrame:
    """``shard, start, n_rows, n_ids, first_id, last_id``: one row for each file, from the narrow columns alone."""
    own = tokens.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_ids"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return own.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"), "n_rows", "n_ids", "first_id", "last_id")


def located(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``start``, the ids of all rows before each."""
    starts = shards(tokens).select(F.col("shard").alias("_shard"), F.col("start").alias("_base"))
    # One row for each file.
    placed = tokens.join(F.broadcast(starts), F.col("shard") == F.col("_shard"))
    return placed.withColumn("start", F.col("_base") + F.col("local_start")).drop("_shard", "_base")


def documents(tokens: DataFrame, ids: list) -> DataFrame:
    """The rows of a few ids: the filter reaches the files' statistics, row
    indexes and Bloom filters, so most stripes are not read."""
    return tokens.filter(F.col("doc_id").isin(ids))


def _checksums(batches):
    for batch in batches:
        ids = batch.column(1)
        offsets = ids.offsets.to_numpy()
        raw = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pc.cast(c, pa.int64()) if pa.types.is_int32(c.type) else c for c in (batch.column(0), batch.column(2), batch.column(3))] + [pa.array(crcs, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def report(tokens: DataFrame) -> DataFrame:
    """Per row ``doc_id, start, n_tokens, ids_crc32``, from the files."""
    kind = tokens.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    placed = located(tokens).select("doc_id", "ids", "start", F.col("n_tokens").cast("long").alias("n_tokens"))
    return placed.mapInArrow(_checksums, schema)
