"""URL filter (operator 8), DataFrame functions and Spark ML only.

A url's verdict is that of the longest host/path rule that fits it, or else of
a logistic regression on hashed character n-grams of host and path.  The model
is trained from a small labelled url table (``url_labels``); n-grams, hashing,
training and scoring are JVM-side column work, without any shuffle of the urls.

Edge cases: a null url, or one without ``://``, has an empty host and path, no
rule, and the model's verdict on empty strings; a host keeps its port and user
part; very long urls are read whole; ties between rules of one length cannot
arise, as two rules that fit one url and are equally long are the same; repeated
rows are judged each; only id and url are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SIZES = (3, 4, 5)  # characters of an n-gram
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def ngrams(host: Column, path: Column) -> Column:
    """Distinct character n-grams; digit runs count as one digit, as page numbers say nothing."""

    def grams(kind: str, s: Column) -> Column:
        s = F.concat(F.lit("^"), F.regexp_replace(s, "[0-9]+", "0"), F.lit("$"))
        return F.concat(*[
            F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1))), lambda i, n=n: F.concat(F.lit(kind), F.substring(s, i, F.lit(n))))
            for n in SIZES])

    return F.array_distinct(F.concat(grams("h", host), grams("p", path)))


def _with_parts(urls: DataFrame, url: str) -> DataFrame:
    return urls.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))


def fit(labelled: DataFrame, url: str = "url", label: str = "blocked", regularisation: float = 1e-4) -> PipelineModel:
    """``labelled``: a small table of urls and 0/1 (1: block)."""
    rows = _with_parts(labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("label")).dropna(), "url")
    rows = rows.select("label", ngrams(F.col("host"), F.col("path")).alias("grams")).coalesce(1).persist()
    try:
        steps = [
            HashingTF(inputCol="grams", outputCol="counts", numFeatures=BUCKETS, binary=True),
            Normalizer(inputCol="counts", outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol="label", regParam=regularisation, maxIter=60, standardization=False),
        ]
        return Pipeline(stages=steps).fit(rows)
    finally:
        rows.unpersist()


def judge(pages: DataFrame, model: PipelineModel, rules=RULES, threshold: float = 0.5, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row; ``score`` is
    the model's probability of block, whether or not a rule decides."""
    parts = _with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url")), "_url")
    scored = model.transform(parts.select("page_id", "host", "path", ngrams(F.col("host"), F.col("path")).alias("grams")))
    p = F.element_at(vector_to_array("probability"), 2)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(p >= threshold, "block").otherwise("allow")).alias("verdict"), p.alias("score"))
