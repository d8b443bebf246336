"""Toxicity score from a weighted lexicon (operator 5).

Texts are folded (case, accents, homoglyphs of other scripts, digits and signs
that stand for letters), an Aho-Corasick automaton finds every lexicon entry at
a word's start in one pass, exception phrases cover the entries inside them,
and the summed weights, also per length, give a logistic score.

The lexicon is learned: on a bounded sample of labelled rows each folded word
and each word beginning of 4 to 8 letters gets its smoothed log odds of the
toxic class by document frequency (a Spark aggregate); entries that are frequent
and one-sided enough stay.  A beginning that explains a family of words
replaces them.  Exception phrases are word pairs around an entry that are found
almost only in clean documents.  All entries and phrases above these marks
stay; their number is bounded by the sample's rows.  All documents are scored,
whole.

Edge cases: null and empty texts and texts without an entry score as the model
scores zero evidence (low); rows without an id are scored, and are not held out;
no labels, or labels of one class only, give the prior as everybody's score;
repeated rows score alike; only the named columns are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import bounded_sample, doc_remainder, slices

MAX_TRAIN_ROWS = 20_000  # labelled rows used to learn lexicon and weights
MIN_DOCS = 8  # toxic documents that hold an entry
MIN_ODDS = 3.0  # log odds of an entry
STEM = range(4, 9)

# Letters of other scripts and signs that look like a Latin letter, and digits used in a letter's place.
HOMOGLYPHS = {
    "a": "аɑα@4", "b": "ЬβвВ8", "c": "сϲ¢", "d": "ԁ", "e": "еε3€", "g": "ɡ9", "h": "һнН", "i": "іɩιı1", "j": "јϳ",
    "k": "кκК", "l": "ӏⅼ", "m": "мМ", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ5$", "t": "тτТ7", "u": "υս",
    "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ʐ2",
}
# Punctuation that stands for a letter between letters or digits only; at a word's edge it ends the word.
INNER_SIGNS = str.maketrans("!|+", "iit")


def fold_table() -> dict[int, str | int | None]:
    """Code point to folded text, for ``str.translate``: one character each;
    combining and zero-width marks vanish."""
    table: dict[int, str | int | None] = {}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), *range(0x2460, 0x24EA), *range(0x1D400, 0x1D7CC)]:
        plain = unicodedata.normalize("NFKD", chr(c)).lower()
        plain = "".join(x for x in plain if not unicodedata.combining(x))
        if len(plain) == 1 and plain != chr(c):
            table[c] = plain
    table.update({ord("ß"): "s", ord("æ"): "a", ord("œ"): "o", ord("ø"): "o", ord("ł"): "l", ord("đ"): "d"})
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = chr(c + 32)
    for plain, like in HOMOGLYPHS.items():
        for x in like:
            for y in {x, x.lower()}:
                table[ord(y)] = plain
    for c in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]:
        table[c] = None
    return {c: table.get(ord(v), v) if isinstance(v, str) and ord(v) != c else v for c, v in table.items()}


_FOLD = fold_table()
_WORD = re.compile(r"[^\W_]+")
_INNER = re.compile(r"(?<=[^\W_])[!|+]+(?=[^\W_])")


def fold(text: str | None) -> str:
    return _INNER.sub(lambda m: m[0].translate(INNER_SIGNS), (text or "").translate(_FOLD))


@dataclass
class Lexicon:
    """Entries match at a word's start; those in ``whole`` only whole words."""

    weights: dict[str, float] = field(default_factory=dict)
    whole: frozenset[str] = frozenset()
    exceptions: frozenset[str] = frozenset()
    bias: float = 0.0
    slopes: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self):
        a = ahocorasick.Automaton()
        for e, w in self.weights.items():
            a.add_word(e, (len(e), w, e in self.whole))
        for e in self.exceptions:
            a.add_word(e, (len(e), None, True))
        if len(a):
            a.make_automaton()
        return a


def evidence(folded: str, automaton) -> tuple[float, int]:
    """Summed weight and number of the entries found, the longest at each word,
    outside exception phrases."""
    if not len(automaton):
        return 0.0, 0
    found: dict[int, tuple[int, float]] = {}
    covered: list[tuple[int, int]] = []
    for end, (n, weight, whole) in automaton.iter(folded):
        start = end - n + 1
        if start and folded[start - 1].isalnum() or whole and end + 1 < len(folded) and folded[end + 1].isalnum():
            continue
        if weight is None:
            covered.append((start, end))
        elif start not in found or found[start][0] < n:
            found[start] = (n, weight)
    if covered:
        for start in [s for s in found if any(b <= s <= e for b, e in covered)]:
            del found[start]
    return sum(w for _, w in found.values()), len(found)


def features(total: float, hits: int, length: int) -> tuple[float, float, float]:
    """Evidence as a sum, per length, and whether there is any."""
    return math.log1p(max(total, 0.0)), math.log1p(1000.0 * max(total, 0.0) / (length + 200.0)), float(hits > 0)


def _scorer(lexicon: Lexicon, at: int):
    def score(batches):
        automaton = lexicon.automaton()
        for whole in batches:
            for batch in slices(whole, at):
                values, hits = [], []
                for text in batch.column(at).to_pylist():
                    folded = fold(text)
                    total, n = evidence(folded, automaton)
                    z = lexicon.bias + sum(a * b for a, b in zip(lexicon.slopes, features(total, n, len(folded)), strict=True))
                    values.append(1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z)))))
                    hits.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(values, pa.float64()), pa.array(hits, pa.int64())], names=["doc_id", "score", "n_hits"])

    return score


def _terms(batches):
    """(doc, label) to distinct folded words and word beginnings."""
    for whole in batches:
        for batch in slices(whole, 1):
            terms, kinds, labels = [], [], []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = set(_WORD.findall(fold(text)))
                stems = {w[:n] for w in words for n in STEM if len(w) >= n}
                terms += [*words, *stems]
                kinds += [True] * len(words) + [False] * len(stems)
                labels += [label] * (len(words) + len(stems))
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(kinds), pa.array(labels, pa.int32())], names=["term", "whole", "label"])


def _pairs(entries: set[str], at: int):
    """Word pairs that hold an entry, with the label."""
    stems = sorted({len(e) for e in entries})

    def pairs(batches):
        for whole in batches:
            for batch in slices(whole, at):
                out, labels = [], []
                for text, label in zip(batch.column(at).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    folded = fold(text)
                    found = list(_WORD.finditer(folded))
                    own = set()
                    for i, m in enumerate(found):
                        if any(m[0][:n] in entries for n in stems):
                            for j in (i - 1, i):
                                if 0 <= j < len(found) - 1:
                                    own.add(folded[found[j].start() : found[j + 1].end()])
                    out += own
                    labels += [label] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(labels, pa.int32())], names=["term", "label"])

    return pairs


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3) -> np.ndarray:
    """Newton steps on the bounded sample's feature rows; the intercept is the last weight."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], l2 * len(x))
    reg[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(reg), x.T @ (p - y) + reg * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_TRAIN_ROWS) -> Lexicon:
    """Learn the lexicon and its weights from labelled rows (``labels``: id and
    0/1), at most about ``max_rows`` of them, chosen by a hash of the id."""
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")).dropna().groupBy("_id").agg(F.max("label").alias("label"))
    marked = bounded_sample(marked, "_id", max_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(marked, "_id").select("_id", "text", "label").persist()
    try:
        n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
        toxic, clean = n.get(1, 0), n.get(0, 0)
        if not toxic or not clean:
            prior = (toxic + 1) / (toxic + clean + 2) if toxic else 1e-3
            return Lexicon(bias=math.log(prior / (1 - prior)))
        schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("whole", T.BooleanType()), T.StructField("label", T.IntegerType())])
        in_toxic, in_clean = F.sum("label"), F.sum(1 - F.col("label"))
        odds = F.log((F.col("p") + 0.5) / (toxic + 1.0)) - F.log((F.col("n") + 0.5) / (clean + 1.0))
        entries = rows.mapInArrow(_terms, schema).groupBy("term", "whole").agg(in_toxic.alias("p"), in_clean.alias("n")).filter(
            F.col("p") >= MIN_DOCS).withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS).orderBy(F.desc("p"), F.desc("odds"), "term", "whole").collect()
        weights: dict[str, float] = {}
        whole: set[str] = set()
        stems = {r["term"]: r for r in entries if not r["whole"]}
        for r in sorted(entries, key=lambda r: (len(r["term"]), r["whole"])):
            t = r["term"]
            # A shorter beginning that is as one-sided explains this entry already.
            if any(t[:k] in weights and t[:k] not in whole and stems[t[:k]]["odds"] >= r["odds"] - 0.7 for k in range(STEM.start, len(t))):
                continue
            if r["whole"] and t not in weights or not r["whole"]:
                weights[t] = float(r["odds"])
                (whole.add if r["whole"] else whole.discard)(t)
        pair_schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("label", T.IntegerType())])
        exceptions = rows.mapInArrow(_pairs(set(weights), 1), pair_schema).groupBy("term").agg(in_toxic.alias("p"), in_clean.alias("n")).filter(
            (F.col("n") >= 3) & (F.col("p") * clean * 4 <= F.col("n") * toxic)).orderBy(F.desc("n"), "term").collect()
        lexicon = Lexicon(weights, frozenset(whole), frozenset(r["term"] for r in exceptions))
        automaton_of = lexicon
        schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])

        def measured(batches):
            automaton = automaton_of.automaton()
            for batch_ in batches:
                for batch in slices(batch_, 1):
                    x = []
                    for value in batch.column(1).to_pylist():
                        folded = fold(value)
                        x.append(list(features(*evidence(folded, automaton), len(folded))))
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(2)], names=["x", "label"])

        seen = rows.mapInArrow(measured, schema).collect()  # a few numbers for each row of the bounded sample
        w = _logistic(np.array([r["x"] for r in seen]), np.array([r["label"] for r in seen], float))
        lexicon.slopes, lexicon.bias = tuple(map(float, w[:-1])), float(w[-1])
        return lexicon
    finally:
        rows.unpersist()


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, n_hits`` of every row, over its whole text."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("n_hits", T.LongType())])
    return narrow.mapInArrow(_scorer(lexicon, 1), schema)


def judged(scores: DataFrame, modulus: int, held_out: int, threshold: float = 0.3) -> DataFrame:
    """The report's columns: the documented held-out rule and the threshold."""
    rest = F.coalesce(doc_remainder("doc_id", modulus) == held_out, F.lit(False))
    return scores.withColumn("held_out", rest).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
