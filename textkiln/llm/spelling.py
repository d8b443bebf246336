"""Spelling variant grouping over a variable-length gram index (operator 13).

Two words are near if they differ by exactly one inserted, deleted or replaced
character.  Near words are found through grams of ``MIN_GRAM`` to ``MAX_GRAM`` characters:

1. Dictionary.  Words are padded by ``MAX_GRAM - 1`` marks at either end.  A
   gram is *frequent* if more than ``bound`` places in words hold it; the
   dictionary keeps the frequent grams, all others are pruned.  ``bound`` is
   the least with at most ``MAX_DICTIONARY`` frequent grams, which are broadcast.
2. Decomposition.  At each place of a word the gram is extended while it is
   frequent and shorter than ``MAX_GRAM``.
3. Affected grams.  A gram depends on its own characters alone.  So an edit at
   some place affects those grams that begin on or before it and reach it; the
   grams that end before it and those that begin behind it stand in the near
   word, too.  This gives the bounds of the affected grams for every place of a word.
4. List merging.  The list of a gram holds the words that have it at that end.  A
   near word that differs at some place is in the lists of all grams that an edit there does
   not affect; so for each place these lists are intersected, among words of
   the same length, and of one character more, where the grams behind the
   place keep their distance from the word's end.  The join's key is a
   digest of the grams before and of those behind.
5. Every candidate is verified in the same stage: what stands before and behind
   the place must be equal.  A replaced character has one place, and an
   inserted one counts at the first character of a run of equal ones, so each
   pair is found once and needs no further shuffle.

Only words that occur ``min_count`` times take part, so everything after
the count works on the vocabulary, not on the texts.

Edge cases: null and empty texts hold no words; a row without an id counts with
the empty id; rows that repeat an id are counted each; words of any length are
compared whole; ties of forms go to the smaller word in code-point order; only
the named columns are read, so further ones cannot clash; an empty table has
no words.
"""

from __future__ import annotations

from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import Tables

MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5  # a form occurs this many times as often as its variant

MIN_GRAM, MAX_GRAM = 2, 5
LEAST_BOUND = 4
MAX_DICTIONARY = 250_000
_FIRST, _LAST = "\x02", "\x03"

# Words, and the thinning of letters that stands for misspelling.
LETTERS = "A-Za-zÀ-ÿ"
EVERY = 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``word``: each occurrence of a word of ``min_length`` characters or
    more, after the seeded loss of a letter."""
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return lowered.select(F.when(h % EVERY == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= min_length)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that occur ``min_count`` times."""
    counted = occurrences(docs, doc_id, text, min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


# --------------------------------------------------------------------- grams
def _padded(word: Column) -> Column:
    return F.concat(F.lit(_FIRST * (MAX_GRAM - 1)), word, F.lit(_LAST * (MAX_GRAM - 1)))


def gram_dictionary(words: DataFrame, tables: Tables) -> frozenset[str]:
    """The frequent grams of all words."""
    sizes = range(MIN_GRAM, MAX_GRAM + 1)
    padded = words.select(_padded(F.col("word")).alias("w"))
    at = [F.transform(F.sequence(F.lit(1), F.length("w") - k + 1), lambda p, k=k: F.substring("w", p, F.lit(k))) for k in sizes]
    counted = padded.select(F.explode(F.flatten(F.array(*at))).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    counted = tables.write("grams", counted.filter(F.col("n") > LEAST_BOUND))
    # Above ``safe`` there cannot be too many; up to it a count of counts, one row each.
    safe = (counted.agg(F.sum("n")).first()[0] or 0) // MAX_DICTIONARY + 1
    held, bound = 0, LEAST_BOUND
    for r in sorted(counted.groupBy(F.least("n", F.lit(safe + 1)).alias("n")).agg(F.count("*").alias("grams")).collect(), reverse=True):
        held += r["grams"]
        if held > MAX_DICTIONARY:
            bound = r["n"]
            break
    found = [r["g"] for r in counted.filter(F.col("n") > bound).select("g").collect()]
    tables.drop("grams")
    return frozenset(found)


def padded(word: str) -> str:
    return _FIRST * (MAX_GRAM - 1) + word + _LAST * (MAX_GRAM - 1)


def decompose(s: str, frequent: frozenset[str]) -> list[int]:
    """For each place of a padded word the exclusive end of its gram."""
    out = []
    for p in range(len(s) - MAX_GRAM + 1):
        e = p + MIN_GRAM
        while e - p < MAX_GRAM and s[p:e] in frequent:
            e += 1
        out.append(e)
    return out


_PROBES = T.StructType([T.StructField("key", T.LongType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
_INDEX = T.StructType([*_PROBES.fields, T.StructField("at", T.IntegerType())])


def _keys(word: str, frequent: frozenset[str], further: bool) -> list[int]:
    """A key for each character of a word, among the words of its length, and if
    ``further`` for each gap, among the words of one character more: the
    grams that an edit there does not affect, those before by their place and
    those behind by their distance from the word's end."""
    digest = xxhash.xxh3_64_intdigest
    s, n, first = padded(word), len(word), MAX_GRAM - 1
    ends = decompose(s, frequent)
    sorted_ends = sorted((e, p) for p, e in enumerate(ends))
    before = list(accumulate(sorted_ends, lambda h, ep: digest(f"{h}:{ep[1]}:{s[ep[1] : ep[0]]}"), initial=0))
    behind = list(accumulate(reversed(range(len(ends))), lambda h, p: digest(f"{h}:{n - p}:{s[p : ends[p]]}"), initial=0))
    out = []
    for more in range(1 + further):
        lo = 0
        for i in range(first, first + n + more):
            while lo < len(ends) and sorted_ends[lo][0] <= i:
                lo += 1
            out.append(digest(f"{n + more}:{i}:{before[lo]}:{behind[max(0, len(ends) - i - 1 + more)]}") - (1 << 63))
    return out


def _keyed(dictionary, index: bool):
    """Rows of the index, with the place of each key, or of the words that look for partners."""

    def run(batches):
        grams = dictionary.value
        for whole in batches:
            for batch in (whole.slice(i, 2048) for i in range(0, len(whole), 2048)):
                keys = [_keys(w, grams, not index) for w in batch.column(0).to_pylist()]
                counts = np.array([len(k) for k in keys], np.int64)
                rows = np.repeat(np.arange(len(keys)), counts)
                flat = pa.array(np.fromiter(chain.from_iterable(keys), np.int64, len(rows)))
                columns = [flat, batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]
                if index:
                    columns.append(pa.array((np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n", "at"][: len(columns)])

    return run


def near_pairs(words: DataFrame, tables: Tables) -> DataFrame:
    """``a, an, b, bn``: every unordered pair of near words once, with their counts."""
    grams = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, tables))
    narrow = words.select("word", "n")
    index = tables.write("index", narrow.mapInArrow(_keyed(grams, index=True), _INDEX))
    probes = tables.write("probes", narrow.mapInArrow(_keyed(grams, index=False), _PROBES))
    met = probes.select("key", F.col("word").alias("a"), F.col("n").alias("an")).join(index.select("key", F.col("word").alias("b"), F.col("n").alias("bn"), "at"), "key")
    at = F.col("at")
    long, short = F.length("b"), F.length("a")
    before = F.substring("a", F.lit(1), at) == F.substring("b", F.lit(1), at)
    # A pair of equal lengths is met from either side; the smaller word's is enough.
    replaced = (short == long) & (F.col("a") < F.col("b")) & (F.substring("a", at + 2, short) == F.substring("b", at + 2, long))
    one = lambda p: F.substring("b", p, F.lit(1))
    inserted = (short + 1 == long) & ((at == 0) | (one(at) != one(at + 1))) & (F.substring("a", at + 1, short) == F.substring("b", at + 2, long))
    pairs = tables.write("pairs", met.filter((replaced | inserted) & before).select("a", "an", "b", "bn"))
    tables.drop("index", "probes")
    return pairs


def roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """``word, root``: where the forms lead, by pointer doubling.  A form is
    ``TIMES`` times as frequent, so a path has at most 27 steps: five rounds."""
    at = tables.write("root-0", forms.select("word", F.col("form").alias("root")))
    for i in range(1, 6):
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = at.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        step = tables.write(f"root-{i}", longer)
        tables.drop(f"root-{i - 1}")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return at


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             times: int = TIMES) -> DataFrame:
    """Per word ``word, form, root, n, n_near, form_n``."""
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    tables = Tables(docs.sparkSession, "spelling")
    words = tables.write("words", vocabulary(docs, doc_id, text, min_length, min_count))
    pairs = near_pairs(words, tables)
    both = pairs.select("a", "b", "bn").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("an").alias("bn")))
    best = F.min(F.struct((-F.col("bn")).alias("less"), F.col("b").alias("b")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= times * F.col("n")
    judged = tables.write("judged", joined.select(
        "word", F.when(is_form, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.less")).alias("form_n")))
    ends = roots(judged.filter("form IS NOT NULL"), tables)
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
