"""Category expansion.

The reference walks a FIFO queue one category at a time.  Because every seed
is queued before any subcategory and a subcategory found at depth ``d`` is
queued after everything of depth ``d``, the walk is exactly level by level:

    level d: candidates with an order key
             -> first occurrence per category (min of the key)
             -> left-anti join with the visited set
             -> the first ``cap - visited`` by key (a top-k of at most ``cap`` rows)
             -> their members, read page by page (W3)
             -> subcategories on *read* pages become level d+1 candidates,
                keyed by (parent visit order, member position).

One Spark job per level; the depth bound makes the plan finite; each level's
result is cut from the lineage with a reliable checkpoint.  The processed set
per level is bounded by ``cap`` and is broadcast into the member join.

Paging (W3): a category's pages are read while the articles collected so far
are fewer than ``limit``; articles are then truncated to ``limit`` and
subcategories on unread pages are lost.  Computed on the page table (members
pre-aggregated per page, 1/page_size of the rows) with a range-partitioned
running sum, and a within-page rank, so no task holds all members or pages
of a (possibly huge) category.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.functions.text import CATEGORY_PREFIX
from textkiln.operators.positions import group_offsets, row_index
from textkiln.session import cut_lineage
from textkiln.sources.seeds import require_nonempty
from textkiln.sources.landed import NS_ARTICLE, NS_CATEGORY, PAGE_SIZE

# Reference crawl limits.
MAX_PAGES_PER_CATEGORY = 150
MAX_DEPTH = 1
MAX_CATEGORIES_TOTAL = 60
BATCH_SIZE = 20
# Namespaces requested by the older and the newer collector.
NAMESPACES_OLDER = [NS_ARTICLE]
NAMESPACES_NEWER = [NS_ARTICLE, NS_CATEGORY]


def is_subcategory(title: Column) -> Column:
    """P5: a member is a subcategory when its title carries the prefix."""
    return title.startswith(CATEGORY_PREFIX)


def classify_members(members: DataFrame, namespaces: list[int] = NAMESPACES_NEWER) -> DataFrame:
    """F4 + P5: keep requested namespaces; ``kind`` is subcategory/article."""
    kept = members.where(F.col("ns").isin(namespaces))
    return kept.withColumn("kind", F.when(is_subcategory(F.col("title")), "subcategory").otherwise("article"))


def read_members(members: DataFrame, limit: int = MAX_PAGES_PER_CATEGORY, page_size: int = PAGE_SIZE,
                 namespaces: list[int] = NAMESPACES_NEWER) -> DataFrame:
    """W3 + L2 over ``members(cat, ns, title, pos)``: members on read pages,
    with ``kind`` and ``kept`` (article within ``limit``, or subcategory)."""
    # Response pages hold requested namespaces only: ranks are taken after the filter.
    m = group_offsets(classify_members(members, namespaces), ["cat"], ["pos"], out="_rank")
    m = m.withColumn("page_no", F.floor(F.col("_rank") / page_size).cast("long")).drop("_rank")
    art = (F.col("kind") == "article").cast("long")
    pages = m.groupBy("cat", "page_no").agg(F.sum(art).alias("n_art"))
    # Articles on earlier pages of the category; a hot category's pages are
    # spread over range partitions instead of one window task.
    pages = group_offsets(pages, ["cat"], ["page_no"], "n_art", out="art_before")
    read = pages.where(F.col("art_before") < limit).select("cat", "page_no", "art_before")
    on_read = m.join(read, ["cat", "page_no"])
    # Rank of an article inside its page: groups are bounded by page_size.
    in_page = F.sum(art).over(Window.partitionBy("cat", "page_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    ranked = on_read.withColumn("art_rank", F.col("art_before") + in_page)
    kept = (F.col("kind") == "subcategory") | (F.col("art_rank") <= limit)
    return ranked.withColumn("kept", kept).drop("art_before")


@dataclass
class Walk:
    visited: DataFrame  # (cat, depth, visit_pos)
    read: DataFrame  # (cat, page_no, pos, ns, title, kind, art_rank, kept) members on read pages of visited categories

    def titles(self) -> DataFrame:
        """Kept articles of every visited category: ``(cat, title)``."""
        return self.read.where(F.col("kept") & (F.col("kind") == "article")).select("cat", "title")

    def member_counts(self) -> DataFrame:
        """A2: articles kept and subcategories found per visited category."""
        r = self.read.where("kept")
        counts = r.groupBy("cat").agg(
            F.count_if(F.col("kind") == "article").cast("long").alias("n_articles"),
            F.count_if(F.col("kind") == "subcategory").cast("long").alias("n_subcats"),
        )
        return self.visited.join(counts, "cat", "left").select(
            "cat", "depth", "visit_pos",
            F.coalesce("n_articles", F.lit(0)).alias("n_articles"),
            F.coalesce("n_subcats", F.lit(0)).alias("n_subcats"),
        )


def walk(
    seeds: DataFrame,
    members: DataFrame,
    limit: int = MAX_PAGES_PER_CATEGORY,
    page_size: int = PAGE_SIZE,
    max_depth: int = MAX_DEPTH,
    cap: int = MAX_CATEGORIES_TOTAL,
    namespaces: list[int] = NAMESPACES_NEWER,
) -> Walk:
    """Level-wise walk from ``seeds(seed_pos, cat)``."""
    spark = seeds.sparkSession
    require_nonempty(seeds, "category seed list")  # S3
    cands = seeds.select("cat", F.lit(0).cast("long").alias("o1"), F.col("seed_pos").cast("long").alias("o2"))
    visited = None
    reads = []
    n_visited = 0
    for depth in range(max_depth + 1):
        if n_visited >= cap:
            break
        first = cands.groupBy("cat").agg(F.min(F.struct("o1", "o2")).alias("o"))
        if visited is not None:
            first = first.join(visited.select("cat"), "cat", "left_anti")
        # L3: the next `cap - visited` categories in queue order; a top-k of
        # at most `cap` rows, then a window over those few rows.
        level = first.orderBy(F.col("o.o1"), F.col("o.o2")).limit(cap - n_visited)
        level = level.select(
            "cat", F.lit(depth).alias("depth"),
            (F.lit(n_visited) + F.row_number().over(Window.orderBy(F.col("o.o1"), F.col("o.o2")))).cast("long").alias("visit_pos"),
        )
        level = cut_lineage(level)
        n_level = level.count()
        if n_level == 0:
            break
        n_visited += n_level
        visited = level if visited is None else cut_lineage(visited.unionByName(level))
        # Members of this level's categories; the level has at most `cap`
        # rows, so it is broadcast into the member scan.
        mine = members.join(F.broadcast(level.select("cat", "visit_pos")), "cat")
        read = cut_lineage(read_members(mine, limit, page_size, namespaces))
        reads.append(read.drop("visit_pos"))
        if depth < max_depth:
            cands = read.where(F.col("kind") == "subcategory").select(
                F.col("title").alias("cat"), F.col("visit_pos").alias("o1"), F.col("pos").cast("long").alias("o2")
            )
    if visited is None:
        empty = spark.createDataFrame([], "cat string, depth int, visit_pos long")
        return Walk(empty, spark.createDataFrame([], "cat string, page_no long, pos long, ns int, title string, kind string, art_rank long, kept boolean"))
    all_read = reads[0]
    for r in reads[1:]:
        all_read = all_read.unionByName(r)
    return Walk(visited, all_read)


def distinct_titles(titles: DataFrame) -> DataFrame:
    """A1 + U1 + L1: distinct titles over all categories, numbered in code-point
    order (binary UTF-8 order) from 0 without a single-partition sort."""
    d = titles.select("title").distinct()
    return row_index(d, ["title"], out="title_pos")


def title_batches(numbered: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """W2 + P9 + P10: fixed batches of sorted titles, ``|``-joined, with the
    progress label ``[min(end, n)/n]``.  Each group holds ``batch_size`` rows."""
    n = numbered.agg(F.count(F.lit(1))).first()[0]
    b = numbered.withColumn("batch", (F.col("title_pos") / batch_size).cast("long"))
    g = b.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_titles"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("title_pos", "title"))), lambda s: s["title"]), "|").alias("titles"),
    )
    done = F.least((F.col("batch") + 1) * batch_size, F.lit(n))
    return g.withColumn("progress", F.format_string("[%d/%d]", done, F.lit(n)))
