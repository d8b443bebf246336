"""Pre-tokenisation and the counting phase of BPE training.

Two modes (they differ on whitespace runs):

* **lines** (training): the corpus file is read line by line, line end kept,
  so no pretoken spans a line break;
* **documents** (encoding): each framed document ``text + "\\n\\n"`` is one
  sequence.

Both are ``regexp_extract_all`` with the byte-level pattern, JVM-side.  Training,
BPE encoding and the token stream take the same tokens from one Arrow pass over
whole texts (``functions.pretoken_cuts``), which makes no row or string for an occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions.arrow_parts import parts
from textkiln.functions.bytelevel import utf8_byte_ids
from textkiln.functions.pretoken_cuts import BLANK, LETTER, NUMBER, OTHER, cut_texts
from textkiln.functions.text import frame_document

# Fixed value: the byte-level pre-tokenizer pattern (Java regex, Unicode classes).
PRETOKEN_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for a text read line by line: a run of blanks ends with its line, as
# the line's end ends the sequence there.
LINE_PATTERN = PRETOKEN_PATTERN.removesuffix(r"\s+(?!\S)|\s+") + r"[^\S\n]*+\n|[^\S\n]+(?!\S)|[^\S\n]+"

# Fixed value: a pair seen fewer times is never merged.
MIN_FREQUENCY = 2

# Packing of an id pair into one bigint key; ids stay below 2**31.
PAIR_SHIFT = 2**32


def pretokenize(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def line_pretokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token)`` rows for training: pretokens of every corpus line, found in
    one pass over the framed document."""
    return docs.select(F.explode(F.regexp_extract_all(frame_document(text_col), F.lit(LINE_PATTERN), F.lit(0))).alias("token"))


# Bytes of text that are cut at once (each takes some 10 bytes meanwhile); where tokens
# are only counted or looked up, so few that all stays in a processor's cache; and bytes
# of distinct tokens and counts that are summed at once.
PART_BYTES = 4_000_000
CACHED_BYTES = 1_000_000
HELD_BYTES = 64_000_000


@cache
def _char_classes() -> bytes:
    """The pattern's class of every code point, as the JVM's patterns see it."""
    spark = SparkSession.getActiveSession()
    points = spark.range(0x110000).where(~F.col("id").between(0xD800, 0xDFFF))
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    kind = F.lit(OTHER)
    for name, pattern in ((BLANK, r"(?U)\s"), (NUMBER, r"(?U)\p{N}"), (LETTER, r"(?U)\p{L}")):
        kind = F.when(char.rlike(pattern), name).otherwise(kind)
    rows = points.select("id", kind.alias("kind")).toArrow()
    classes = np.zeros(0x110000, np.uint8)
    classes[rows["id"].to_numpy()] = rows["kind"].to_numpy()
    return classes.tobytes()


def char_classes(spark: SparkSession):
    """Broadcast of the code points' classes, a byte for each."""
    return spark.sparkContext.broadcast(_char_classes())


def cuttable(text: Column) -> Column:
    """``text`` as ``regexp_extract_all`` reads it: broken UTF-8 is replaced."""
    read = F.array_join(F.regexp_extract_all(text, F.lit("(?s).+"), F.lit(0)), "")
    return F.when(F.is_valid_utf8(text), text).otherwise(read)


def cut_parts(batch: pa.RecordBatch, classes: np.ndarray, lines: bool, most: int | None = None) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """Parts of ``batch``, of ``most`` bytes, and the tokens of the texts in its last column."""
    at = batch.num_columns - 1
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    for part in parts(batch, sizes, most or PART_BYTES):
        yield part, cut_texts(part.column(at), classes, lines)


def _cut_counts(docs: DataFrame, text_col: str, lines: bool) -> DataFrame:
    """``(token, cnt)``: tokens are counted where they lie, and the distinct
    ones of several parts go to the aggregate together."""
    table = char_classes(docs.sparkSession)

    def summed(held):
        whole = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")])
        return whole.select(["token", "n_sum"]).rename_columns(["token", "n"])

    def count(batches):
        classes = np.frombuffer(table.value, np.uint8)
        held, size = [], 0
        for batch in batches:
            for _, tokens in cut_parts(batch, classes, lines, CACHED_BYTES):
                found = pc.value_counts(tokens.flatten())
                held.append(pa.table([found.field(0), found.field(1)], names=["token", "n"]))
                size += found.nbytes
                if size > HELD_BYTES:
                    yield from summed(held).to_batches()
                    held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    found = docs.select(cuttable(frame_document(text_col)).alias("text")).mapInArrow(count, "token string, n long")
    return found.groupBy("token").agg(F.sum("n").alias("cnt"))


def line_pretoken_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, cnt)`` of ``line_pretokens``."""
    return _cut_counts(docs, text_col, lines=True)


def doc_pretoken_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, cnt)`` of ``doc_pretokens``."""
    return _cut_counts(docs, text_col, lines=False)


def doc_pretokens(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, pos_in_doc, token)`` for encoding: pretokens of ``text + "\\n\\n"``."""
    return docs.select(key, F.posexplode(pretokenize(frame_document(text_col))).alias("pos_in_doc", "token"))


def pretoken_counts(tokens: DataFrame) -> DataFrame:
    """``(token, cnt)``; partial + final hash aggregate, so a very frequent
    pretoken is combined map-side and never piles up in one task."""
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def word_table(counts: DataFrame) -> DataFrame:
    """``(word, freq, syms array<int>)``: each distinct pretoken as byte ids."""
    return counts.select(F.col("token").alias("word"), F.col("cnt").alias("freq"), utf8_byte_ids(F.col("token")).alias("syms"))


def pair_keys(syms: Column) -> Column:
    """Adjacent pairs of a symbol array packed as ``left * 2^32 + right``
    (overlapping occurrences each count)."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(syms) - 1, F.lit(1))),
        lambda i: F.element_at(syms, i).cast("long") * PAIR_SHIFT + F.element_at(syms, i + 1).cast("long"),
    )


def multi_symbol_words(counts: DataFrame) -> DataFrame:
    """Word table of the pretokens that can hold a pair (two or more bytes).

    The filter is on ``octet_length`` of the grouping key on purpose: Catalyst
    pushes it below the aggregate, and a filter on ``size(syms)`` would be
    pushed too, computing byte ids for every occurrence instead of every
    distinct word."""
    return word_table(counts.where(F.octet_length("token") >= 2))


def pair_counts(words: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """A7 + F6: ``(pair, cnt)`` weighted by word frequency, ``cnt >= min_frequency``.
    ``words`` must hold only words of two or more symbols."""
    multi = words
    pairs = multi.select("freq", F.explode(pair_keys(F.col("syms"))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("freq").alias("cnt"))
    return counts.where(F.col("cnt") >= min_frequency)


def split_pair(df: DataFrame) -> DataFrame:
    return df.withColumn("left_id", F.shiftright("pair", 32).cast("int")).withColumn(
        "right_id", (F.col("pair") % PAIR_SHIFT).cast("int")
    )
