"""Landed API responses and their parsers.

No network: the collectors start from responses that were already landed as
rows.  The builders below derive such landed responses from the driver tables
(so their size grows with the tables); the parsers are what a user runs on real
landed JSON.

Category graph (members):  each region is a seed category holding its nations
as subcategories (ns 14) and the suppliers of those nations as articles (ns 0);
each nation is a category holding its customers as articles.  ``pos`` is the
arrival order inside a category: title descending, so articles come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.text import CATEGORY_PREFIX
from textkiln.operators.positions import group_offsets, row_index
from textkiln.session import materialised
from textkiln.sources.tables import load

# Fixed values (API contract): namespaces of articles and subcategories.
NS_ARTICLE = 0
NS_CATEGORY = 14
# Fixed value: members per response page.
PAGE_SIZE = 50

MEMBERS_RESPONSE_SCHEMA = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("categorymembers", T.ArrayType(T.StructType([
            T.StructField("ns", T.IntegerType()),
            T.StructField("title", T.StringType()),
        ]))),
    ])),
    T.StructField("continue", T.StructType([
        T.StructField("cmcontinue", T.StringType()),
    ])),
])

EXTRACTS_RESPONSE_SCHEMA = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.MapType(T.StringType(), T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("extract", T.StringType()),
        ]))),
    ])),
])


# --------------------------------------------------------------------------- seeds
def category_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seed_pos, cat)``: one seed category per region, in region-key order."""
    region = load(spark, sf_dir, "region", "r_regionkey", "r_name")
    return region.select(
        (F.col("r_regionkey").cast("long") + 1).alias("seed_pos"),
        F.concat(F.lit(CATEGORY_PREFIX), F.col("r_name")).alias("cat"),
    )


def category_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cat, ns, title, pos)`` edges of the category graph built from the tables."""
    region = load(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    supplier = load(spark, sf_dir, "supplier", "s_name", "s_nationkey")
    customer = load(spark, sf_dir, "customer", "c_name", "c_nationkey")
    pfx = F.lit(CATEGORY_PREFIX)
    # region and nation are dimension tables of at most a few dozen rows.
    subcats = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(pfx, "r_name").alias("cat"), F.lit(NS_CATEGORY).alias("ns"), F.concat(pfx, "n_name").alias("title")
    )
    region_articles = (
        supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.concat(pfx, "r_name").alias("cat"), F.lit(NS_ARTICLE).alias("ns"), F.col("s_name").alias("title"))
    )
    nation_articles = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(pfx, "n_name").alias("cat"), F.lit(NS_ARTICLE).alias("ns"), F.col("c_name").alias("title")
    )
    # Categories whose number grows with the customers, and file pages (namespace 6).
    customers = load(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    group = F.concat(pfx, "n_name", F.lit(" "), F.expr("c_custkey div 500").cast("string"))
    groups = customers.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(pfx, "r_name").alias("cat"), F.lit(NS_CATEGORY).alias("ns"), group.alias("title")
    ).distinct()
    group_articles = customers.select(group.alias("cat"), F.lit(NS_ARTICLE).alias("ns"), F.col("c_name").alias("title"))
    files = customers.where(F.col("c_custkey") % 7 == 0).select(
        F.concat(pfx, "n_name").alias("cat"), F.lit(6).alias("ns"), F.concat(F.lit("Datei:"), "c_name").alias("title")
    )
    edges = subcats.unionByName(region_articles).unionByName(nation_articles)
    edges = edges.unionByName(groups).unionByName(group_articles).unionByName(files)
    # Arrival order inside a category.  A nation category holds all customers
    # of that nation, so one category can hold a large share of the rows: the
    # rank is taken over balanced range partitions, not a per-category window.
    return group_offsets(edges.withColumn("_order", F.md5("title")), ["cat"], [F.col("_order")], out="pos").drop("_order")


def source_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seed_pos, cat)``: one seed category per source of ``documents``."""
    cats = load(spark, sf_dir, "documents", "source").select(F.concat(F.lit(CATEGORY_PREFIX), "source").alias("cat"))
    ranked = row_index(cats.where(F.col("cat").isNotNull()).distinct(), ["cat"], out="i")
    return ranked.select((F.col("i") + 1).alias("seed_pos"), "cat")


def source_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cat, ns, title, pos)``: a source holds the titles of its documents
    and one subcategory per language, which holds all titles of that language."""
    docs = load(spark, sf_dir, "documents", "doc_id", "source", "lang")
    cat = F.concat(F.lit(CATEGORY_PREFIX), "source")
    sub = F.concat(cat, F.lit(" "), F.col("lang"))
    article = extract_title(F.col("doc_id"))
    edges = docs.select(F.explode(F.array(
        F.struct(cat.alias("cat"), F.lit(NS_CATEGORY).alias("ns"), sub.alias("title")),
        F.struct(sub.alias("cat"), F.lit(NS_ARTICLE).alias("ns"), article.alias("title")),
        F.struct(cat.alias("cat"), F.lit(NS_ARTICLE).alias("ns"), article.alias("title")),
    )).alias("e")).select("e.*").where("cat IS NOT NULL AND title IS NOT NULL").distinct()
    return group_offsets(edges.withColumn("_order", F.md5("title")), ["cat"], [F.col("_order")], out="pos").drop("_order")


def member_responses(members: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``(cat, page_no, body)``: landed JSON pages of a category, with a
    ``continue.cmcontinue`` token on every page but the last."""
    paged = members.withColumn("page_no", F.floor(F.col("pos") / page_size).cast("int"))
    pages = paged.groupBy("cat", "page_no").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ns", "title"))).alias("m"),
    )
    last = pages.groupBy("cat").agg(F.max("page_no").alias("last_page"))
    pages = pages.join(last, "cat")
    body = F.to_json(F.struct(
        F.struct(F.transform("m", lambda x: F.struct(x["ns"].alias("ns"), x["title"].alias("title")))
                 .alias("categorymembers")).alias("query"),
        F.when(F.col("page_no") < F.col("last_page"),
               F.struct(F.format_string("page|%s|%d", F.col("cat"), F.col("page_no") + 1).alias("cmcontinue")))
        .alias("continue"),
    ))
    return pages.select("cat", "page_no", body.alias("body"))


def parse_member_responses(responses: DataFrame) -> DataFrame:
    """``(cat, page_no, member_pos, ns, title, cmcontinue)``; a response
    without members yields one row with null member (``posexplode_outer``)."""
    parsed = responses.withColumn("r", F.from_json("body", MEMBERS_RESPONSE_SCHEMA))
    members = F.coalesce(F.col("r.query.categorymembers"), F.array().cast(MEMBERS_RESPONSE_SCHEMA["query"].dataType["categorymembers"].dataType))
    return parsed.select(
        "cat", "page_no",
        F.posexplode_outer(members).alias("member_pos", "m"),
        F.col("r.continue.cmcontinue").alias("cmcontinue"),
    ).select("cat", "page_no", "member_pos", F.col("m.ns").alias("ns"), F.col("m.title").alias("title"), "cmcontinue")


def requested_responses(responses: DataFrame) -> DataFrame:
    """``(cat, token, body)``: the same responses as a crawler lands them, with
    the continuation token each was asked for (null: the first) and no number."""
    token = F.when(F.col("page_no") > 0, F.format_string("page|%s|%d", F.col("cat"), F.col("page_no")))
    return responses.select("cat", token.alias("token"), "body")


def follow_continuations(responses: DataFrame) -> DataFrame:
    """``(cat, page_no, body, error)`` of responses ``(cat, token, body)``.

    A response's place is its distance from the first one along the tokens
    that the responses name as their continuation: list ranking by pointer
    doubling, so a chain of n pages takes about log2(n) joins, however long the
    chains of single categories are.  Kept as quarantine rows (``error`` set,
    no ``page_no``) are responses whose body does not parse, those that no
    chain from a first response reaches, and rings.  A malformed body ends its
    chain.  Of responses that answer one request the first body in
    order counts; categories must be non-null."""
    bad = F.try_parse_json("body").isNull()
    nodes = responses.groupBy("cat", "token").agg(F.min("body").alias("body")).withColumn("bad", bad)
    nodes = nodes.withColumn("next", F.when(~F.col("bad"), F.from_json("body", MEMBERS_RESPONSE_SCHEMA)["continue"]["cmcontinue"]))
    nodes = materialised(nodes, "responses")
    # Who names a token; two responses that name one are no chain, the smaller counts.  "" stands for the first response.
    key = F.coalesce("token", F.lit(""))
    named = nodes.where("next IS NOT NULL").groupBy("cat", F.col("next").alias("token")).agg(F.min(key).alias("prev"))
    links = nodes.select("cat", key.alias("token")).join(named, ["cat", "token"], "left")
    at = links.select("cat", "token", F.when(F.col("token") != "", F.col("prev")).alias("ptr"), F.when(F.col("token") != "", 1).otherwise(0).cast("long").alias("hops"))
    at = materialised(at, "chain-0")
    n_longest = at.groupBy("cat").count().agg(F.max("count")).first()[0] or 0
    for i in range(1, int(n_longest).bit_length() + 1):
        ahead = at.select("cat", F.col("token").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("hops").alias("_hops"))
        open_ = F.col("ptr").isNotNull() & (F.col("ptr") != "")
        step = at.join(ahead, ["cat", "ptr"], "left").select(
            "cat", "token", F.when(open_, F.col("_ptr")).otherwise(F.col("ptr")).alias("ptr"),
            (F.col("hops") + F.when(open_, F.coalesce("_hops", F.lit(0))).otherwise(F.lit(0))).alias("hops"), open_.alias("moved"))
        step = materialised(step, f"chain-{i}")
        at = step.select("cat", "token", "ptr", "hops")
        if step.where("moved").isEmpty():
            break
    reached = (F.col("_t") == "") | (F.col("ptr") == "")
    placed = nodes.withColumn("_t", key).join(at.withColumnRenamed("token", "_t"), ["cat", "_t"])
    error = F.when(F.col("bad"), F.lit("malformed response")).when(reached, F.lit(None)).when(F.col("ptr").isNull(), F.lit("broken chain")).otherwise(F.lit("ring of continuations"))
    return placed.withColumn("error", error).select("cat", F.when(F.col("error").isNull(), F.col("hops").cast("int")).alias("page_no"), "body", "error")


# ------------------------------------------------------------------------ extracts
def extract_title(doc_id: Column) -> Column:
    """Titles repeat: two documents share one title (last arrival wins)."""
    return F.concat(F.lit("Doc "), F.floor(doc_id / 2).cast("string"))


def extract_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(arrival_pos, body)``: one landed extract response per document.

    Some pages lack ``extract`` (doc_id % 10 = 3), some lack ``title``
    (doc_id % 25 = 5), some extracts are whitespace only (doc_id % 15 = 8) and
    some bodies are cut in half (doc_id % 50 = 17, malformed JSON).
    """
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    d = F.col("doc_id")
    page = F.struct(
        F.when(d % 25 != 5, extract_title(d)).alias("title"),
        F.when(d % 10 == 3, F.lit(None).cast("string")).when(d % 15 == 8, F.lit("  \n")).otherwise(F.col("text")).alias("extract"),
    )
    raw = F.to_json(F.struct(F.struct(F.create_map(d.cast("string"), page).alias("pages")).alias("query")))
    a = F.col("arrival_pos")
    return docs.select(d.alias("arrival_pos"), raw.alias("b")).select(
        "arrival_pos",
        F.when(a % 50 == 17, F.expr("substring(b, 1, length(b) div 2)")).otherwise(F.col("b")).alias("body"),
    )


def parse_extract_responses(responses: DataFrame) -> DataFrame:
    """S6 + S14: ``(arrival_pos, page_key, title, extract, error)``.

    Defaults as in the collector: missing ``title`` -> ``"?"``, missing
    ``extract`` -> ``""``.  A malformed body becomes one quarantine row with
    ``error`` set (the reference loses the whole batch of 20; we lose the row).
    """
    pages_type = EXTRACTS_RESPONSE_SCHEMA["query"].dataType["pages"].dataType
    bad = F.try_parse_json("body").isNull()
    pages = F.when(bad, F.lit(None).cast(pages_type)).otherwise(
        F.coalesce(F.from_json("body", EXTRACTS_RESPONSE_SCHEMA)["query"]["pages"], F.create_map().cast(pages_type))
    )
    # One pass: a malformed body explodes to a single null entry and is kept
    # as its quarantine row; an empty page map yields nothing.
    return (
        responses.select("arrival_pos", bad.alias("bad"), F.explode_outer(pages).alias("page_key", "p"))
        .where(F.col("page_key").isNotNull() | F.col("bad"))
        .select(
            "arrival_pos",
            "page_key",
            F.when(~F.col("bad"), F.coalesce(F.col("p.title"), F.lit("?"))).alias("title"),
            F.when(~F.col("bad"), F.coalesce(F.col("p.extract"), F.lit(""))).alias("extract"),
            F.when(F.col("bad"), F.lit("malformed response")).alias("error"),
        )
    )


def lost_bodies(pages: DataFrame) -> DataFrame:
    """Landed pages, the body of every 50th lost on the way (null)."""
    return pages.withColumn("html", F.when(F.col("page_id") % 50 != 17, F.col("html")))
