"""Quality classifier: a sparse rule ensemble (operator 6).

Text statistics are Spark column expressions.  On a bounded sample of labelled
rows a random forest of shallow trees is grown, every path from a root to a
node becomes a conjunctive rule over statistics, a logistic model with an L1
penalty keeps few rules, and the kept rules compile back into one Spark column
expression, so scoring is a single pass inside the JVM without any join or
model object.  Training rows are dealt and ordered by id, so a repeated fit
finds the same model.

Edge cases: null counts as the empty text, whose statistics are zeros; texts of
any length are read whole; rows without an id are scored, and are not held out;
no labels, or of one class only, give everybody the prior; repeated rows score
alike; only the named columns are read, and statistics never appear in the
result, so they cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.common import bounded_sample

MAX_TRAIN_ROWS = 10_000  # labelled rows used to grow trees and fit weights
TREES = 12
DEPTH = 3
L1 = 0.002

_SIGNS = "#$%&*@^~=_<>{}[]\\/+"


def statistics(text: Column) -> dict[str, Column]:
    """Numbers of one text, each a column expression; zero for empty texts."""
    t = F.coalesce(text, F.lit(""))
    n_chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    n_words = F.size(words)
    per_word = F.greatest(n_words, F.lit(1)).cast("double")

    def share(removed: Column) -> Column:
        return (F.length(t) - F.length(removed)) / n_chars

    return {
        "n_words": n_words.cast("double"),
        "word_length": F.length(t) / per_word,
        "distinct_words": F.size(F.array_distinct(words)) / per_word,
        "signs": share(F.translate(t, _SIGNS, "")),
        "bars": share(F.translate(t, "|", "")),
        "shouts": share(F.translate(t, "!?", "")),
        "capitals": share(F.regexp_replace(t, r"\p{Lu}+", "")),
        "digits": share(F.translate(t, "0123456789", "")),
        "stops": share(F.translate(t, ".,;:", "")),
        "lines": share(F.translate(t, "\n", "")),
        "spaces": share(F.regexp_replace(t, r"\s+", "")),
        "repeats": share(F.regexp_replace(t, r"(?<!\S)(\S+)(?:\s+\1(?!\S))++", "$1")),
    }


@dataclass(frozen=True)
class Rule:
    """All of (statistic, above or not, threshold) hold."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, columns: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, above, x in self.parts:
            out = out & (columns[name] > x if above else columns[name] <= x)
        return out


@dataclass
class Model:
    rules: list[tuple[Rule, float]]
    bias: float

    def column(self, stats: dict[str, Column]) -> Column:
        """Probability of label 1 as one expression over statistic columns."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _rules(forest, names: list[str]) -> list[Rule]:
    """Every path from a root to a node below it; thresholds that a path
    repeats for one statistic and direction keep the tighter one."""
    found: dict[Rule, None] = {}

    def tidy(path):
        held: dict[tuple[str, bool], float] = {}
        for name, above, x in path:
            old = held.get((name, above))
            held[name, above] = x if old is None else (max if above else min)(old, x)
        return Rule(tuple((name, above, x) for (name, above), x in sorted(held.items())))

    def walk(node, path):
        if path:
            found.setdefault(tidy(path))
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, x = names[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), [*path, (name, False, x)])
        walk(node.rightChild(), [*path, (name, True, x)])

    for tree in forest._call_java("trees"):
        walk(tree.rootNode(), [])
    return list(found)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_TRAIN_ROWS, seed: int = 7) -> Model:
    """Rules and weights from labelled rows (``labels``: id and 0/1), at most
    about ``max_rows`` of them, chosen by a hash of the id."""
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("label")).dropna().groupBy("_id").agg(F.max("label").alias("label"))
    marked = bounded_sample(marked, "_id", max_rows)
    columns = statistics(F.col("text"))
    names = list(columns)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(marked, "_id").select("_id", "label", *[c.alias(k) for k, c in columns.items()])
    # Trees sample by partition and place, so both follow the ids alone.
    rows = rows.repartition(4, "_id").sortWithinPartitions("_id", *names).persist()
    try:
        n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
        good, bad = n.get(1.0, 0), n.get(0.0, 0)
        if not good or not bad:
            return Model([], 4.0 if good or not bad else -4.0)
        rows = rows.withColumn("weight", F.when(F.col("label") == 1, (good + bad) / (2.0 * good)).otherwise((good + bad) / (2.0 * bad)))
        vectors = VectorAssembler(inputCols=names, outputCol="x").transform(rows)
        forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird").fit(vectors)
        rules = _rules(forest, names)
        if not rules:
            return Model([], math.log(good / bad))
        held = F.array(*[r.column({k: F.col(k) for k in names}).cast("double") for r in rules])
        matrix = rows.select("label", array_to_vector(held).alias("x"))
        fitted = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=L1, maxIter=60, standardization=False).fit(matrix)
        weights = fitted.coefficients.toArray()
        return Model([(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6], float(fitted.intercept))
    finally:
        rows.unpersist()


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    used = {name for rule, _ in model.rules for name, _, _ in rule.parts}
    stats = {k: c for k, c in statistics(F.col("_text")).items() if k in used}
    measured = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).select("doc_id", *[c.alias(f"_{k}") for k, c in stats.items()])
    return measured.select("doc_id", model.column({k: F.col(f"_{k}") for k in stats}).alias("score"))


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows scored below ``threshold``."""
    used = {name for rule, _ in model.rules for name, _, _ in rule.parts}
    return docs.filter(model.column({k: c for k, c in statistics(F.col(text)).items() if k in used}) >= threshold)
