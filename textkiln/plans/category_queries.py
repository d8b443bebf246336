"""Queries for category expansion and title batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.operators import categories as K
from textkiln.operators import collector as C
from textkiln.operators.corpus import write_corpus
from textkiln.plans.catalog import query
from textkiln.plans.sql_text import EXTRACT_ROWS, nonblank, ref_cut
from textkiln.session import scratch_path
from textkiln.sources import landed

# Reference crawl limits, and a paged/capped variant that exercises the
# page-consumption stop and the category cap (FIXTURES.md).
REF = dict(limit=K.MAX_PAGES_PER_CATEGORY, page_size=landed.PAGE_SIZE, max_depth=K.MAX_DEPTH, cap=K.MAX_CATEGORIES_TOTAL)
CAPPED = dict(limit=15, page_size=10, max_depth=1, cap=12)

MEMBERS_SQL = """
edges AS (
  SELECT 'Kategorie:' || r_name AS cat, 14 AS ns, 'Kategorie:' || n_name AS title
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'Kategorie:' || r_name, 0, s_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'Kategorie:' || n_name, 0, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT DISTINCT 'Kategorie:' || r_name, 14, 'Kategorie:' || n_name || ' ' || CAST(c_custkey // 500 AS VARCHAR)
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'Kategorie:' || n_name || ' ' || CAST(c_custkey // 500 AS VARCHAR), 0, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'Kategorie:' || n_name, 6, 'Datei:' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 = 0
),
members AS (
  SELECT cat, ns, title, CAST(row_number() OVER (PARTITION BY cat ORDER BY md5(title)) - 1 AS BIGINT) AS pos FROM edges
),
seeds AS (SELECT CAST(r_regionkey + 1 AS BIGINT) AS seed_pos, 'Kategorie:' || r_name AS cat FROM region)"""


def _read_sql(name: str, level: str, limit: int, page: int, namespaces: str = "0, 14") -> str:
    """CTEs ``{name}_pm``, ``{name}_pg``, ``{name}`` = members of ``level`` on read pages."""
    art = "CASE WHEN kind = 'article' THEN 1 ELSE 0 END"
    return f"""
{name}_pm AS (
  SELECT m.cat, m.ns, m.title, m.pos, l.visit_pos, CAST((row_number() OVER (PARTITION BY m.cat ORDER BY m.pos) - 1) // {page} AS BIGINT) AS page_no,
         CASE WHEN starts_with(m.title, 'Kategorie:') THEN 'subcategory' ELSE 'article' END AS kind
  FROM members m JOIN {level} l USING (cat) WHERE m.ns IN ({namespaces})
),
{name}_pg AS (
  SELECT cat, page_no,
         coalesce(sum(n_art) OVER (PARTITION BY cat ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS art_before
  FROM (SELECT cat, page_no, sum({art}) AS n_art FROM {name}_pm GROUP BY cat, page_no)
),
{name} AS (
  SELECT *, kind = 'subcategory' OR art_rank <= {limit} AS kept FROM (
    SELECT p.*, g.art_before + sum({art}) OVER (PARTITION BY p.cat, p.page_no ORDER BY p.pos ROWS UNBOUNDED PRECEDING) AS art_rank
    FROM {name}_pm p JOIN {name}_pg g USING (cat, page_no) WHERE g.art_before < {limit})
)"""


def walk_sql(limit: int, page_size: int, max_depth: int, cap: int, namespaces: str = "0, 14", graph: str = MEMBERS_SQL) -> str:
    """CTEs ending in ``visited(cat, depth, visit_pos)`` and ``rd(...)``; depth <= 1."""
    parts = [graph, f"""
l0 AS (
  SELECT cat, 0 AS depth, CAST(row_number() OVER (ORDER BY o) AS BIGINT) AS visit_pos
  FROM (SELECT cat, min(seed_pos) AS o FROM seeds GROUP BY cat)
  QUALIFY row_number() OVER (ORDER BY o) <= {cap}
)""", _read_sql("rd0", "l0", limit, page_size, namespaces)]
    if max_depth >= 1:
        parts.append(f"""
f1 AS (
  SELECT cat, o1, o2 FROM (
    SELECT title AS cat, visit_pos AS o1, pos AS o2,
           row_number() OVER (PARTITION BY title ORDER BY visit_pos, pos) AS rn
    FROM rd0 WHERE kind = 'subcategory')
  WHERE rn = 1 AND cat NOT IN (SELECT cat FROM l0)
),
l1 AS (
  SELECT cat, 1 AS depth, CAST((SELECT count(*) FROM l0) + row_number() OVER (ORDER BY o1, o2) AS BIGINT) AS visit_pos
  FROM f1 QUALIFY row_number() OVER (ORDER BY o1, o2) <= {cap} - (SELECT count(*) FROM l0)
)""")
        parts.append(_read_sql("rd1", "l1", limit, page_size, namespaces))
        parts.append("""
visited AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1),
rd AS (SELECT * FROM rd0 UNION ALL SELECT * FROM rd1)""")
    else:
        parts.append("""
visited AS (SELECT * FROM l0),
rd AS (SELECT * FROM rd0)""")
    return ",".join(parts)


_WALK_CACHE: dict = {}


def _walk(spark, sf_dir, params):
    key = (spark.sparkContext.applicationId, sf_dir, repr(sorted(params.items())))
    if key not in _WALK_CACHE:
        seeds = landed.category_seeds(spark, sf_dir)
        members = landed.category_members(spark, sf_dir)
        _WALK_CACHE[key] = K.walk(seeds, members, **params)
    return _WALK_CACHE[key]


@query("member_kinds", f"""
WITH {MEMBERS_SQL}
SELECT cat, ns, title, pos,
       CASE WHEN starts_with(title, 'Kategorie:') THEN 'subcategory' ELSE 'article' END AS kind,
       ns IN (0) AS ns_older, ns IN (0, 14) AS ns_newer
FROM members
""")
def member_kinds(spark, sf_dir):
    """P5 + F4: member kind and the two namespace filters."""
    m = landed.category_members(spark, sf_dir)
    return K.classify_members(m, [0, 14, *range(1, 14)]).select(
        "cat", "ns", "title", F.col("pos").cast("long"), "kind",
        F.col("ns").isin(K.NAMESPACES_OLDER).alias("ns_older"),
        F.col("ns").isin(K.NAMESPACES_NEWER).alias("ns_newer"),
    )


@query("api_members_parse", f"""
WITH {MEMBERS_SQL},
paged AS (SELECT *, CAST(pos // 50 AS INTEGER) AS page_no, max(pos // 50) OVER (PARTITION BY cat) AS last_page FROM members)
SELECT cat, page_no, CAST(pos % 50 AS INTEGER) AS member_pos, ns, title,
       CASE WHEN page_no < last_page THEN 'page|' || cat || '|' || CAST(page_no + 1 AS VARCHAR) END AS cmcontinue
FROM paged
""")
def api_members_parse(spark, sf_dir):
    """Landed member responses parsed back into rows, continuation kept."""
    responses = landed.member_responses(landed.category_members(spark, sf_dir))
    return landed.parse_member_responses(responses)


@query("continuation_chain", f"""
WITH {MEMBERS_SQL}
SELECT cat, CAST(pos // {K.BATCH_SIZE} AS INTEGER) AS page_no, CAST(pos % {K.BATCH_SIZE} AS INTEGER) AS member_pos, ns, title FROM members
""")
def continuation_chain(spark, sf_dir):
    """S5 + W3: responses in pages of 20 without numbers, put in order along their continuation tokens."""
    landed_pages = landed.member_responses(landed.category_members(spark, sf_dir), K.BATCH_SIZE)
    ordered = landed.follow_continuations(landed.requested_responses(landed_pages))
    return landed.parse_member_responses(ordered.where("error IS NULL")).select("cat", "page_no", "member_pos", "ns", "title")


@query("paged_members", f"""
WITH {MEMBERS_SQL},
everyone AS (SELECT DISTINCT cat, CAST(0 AS BIGINT) AS visit_pos FROM members),
{_read_sql("rd", "everyone", CAPPED["limit"], CAPPED["page_size"])}
SELECT cat, page_no, pos, ns, title, kind, CAST(art_rank AS BIGINT) AS art_rank, kept FROM rd
""")
def paged_members(spark, sf_dir):
    """W3 + L2: members on read pages of every category (limit 15, pages of 10)."""
    m = landed.category_members(spark, sf_dir)
    r = K.read_members(m, CAPPED["limit"], CAPPED["page_size"])
    return r.select("cat", "page_no", F.col("pos").cast("long"), "ns", "title", "kind", F.col("art_rank").cast("long"), "kept")


@query("category_walk", f"""
WITH {walk_sql(**REF)}
SELECT cat, depth, visit_pos FROM visited
""")
def category_walk(spark, sf_dir):
    """J1 + J2 + L3 + L4 + F5 + U2 with the reference limits."""
    return _walk(spark, sf_dir, REF).visited


@query("category_walk_capped", f"""
WITH {walk_sql(**CAPPED)}
SELECT cat, depth, visit_pos FROM visited
""")
def category_walk_capped(spark, sf_dir):
    """The walk with paging and the category cap reached mid-level."""
    return _walk(spark, sf_dir, CAPPED).visited


@query("member_counts", f"""
WITH {walk_sql(**CAPPED)}
SELECT v.cat, v.depth, v.visit_pos,
       CAST(count(*) FILTER (WHERE r.kept AND r.kind = 'article') AS BIGINT) AS n_articles,
       CAST(count(*) FILTER (WHERE r.kept AND r.kind = 'subcategory') AS BIGINT) AS n_subcats
FROM visited v LEFT JOIN rd r USING (cat)
GROUP BY v.cat, v.depth, v.visit_pos
""")
def member_counts(spark, sf_dir):
    """A2: articles and subcategories found per visited category."""
    return _walk(spark, sf_dir, CAPPED).member_counts()


_TITLES_SQL = f"""
WITH {MEMBERS_SQL},
t AS (SELECT DISTINCT title FROM members WHERE ns IN (0, 14) AND NOT starts_with(title, 'Kategorie:')),
numbered AS (SELECT CAST(row_number() OVER (ORDER BY title) - 1 AS BIGINT) AS title_pos, title FROM t)"""


def _article_titles(spark, sf_dir):
    """Every classified article member; the crawl limits belong to the walk."""
    return K.classify_members(landed.category_members(spark, sf_dir)).where(F.col("kind") == "article").select("cat", "title")


@query("distinct_titles", _TITLES_SQL + """
SELECT title_pos, title FROM numbered
""")
def distinct_titles(spark, sf_dir):
    """A1 + U1 + L1: distinct article titles of all categories in code-point order."""
    return K.distinct_titles(_article_titles(spark, sf_dir))


@query("title_batches", _TITLES_SQL + f"""
SELECT CAST(title_pos // {K.BATCH_SIZE} AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_titles,
       string_agg(title, '|' ORDER BY title_pos) AS titles,
       '[' || CAST(least((title_pos // {K.BATCH_SIZE} + 1) * {K.BATCH_SIZE}, (SELECT count(*) FROM numbered)) AS VARCHAR)
           || '/' || CAST((SELECT count(*) FROM numbered) AS VARCHAR) || ']' AS progress
FROM numbered GROUP BY title_pos // {K.BATCH_SIZE}
""")
def title_batches(spark, sf_dir):
    """W2 + P9 + P10: batches of 20 sorted titles with progress labels."""
    return K.title_batches(K.distinct_titles(_article_titles(spark, sf_dir)))


OLDER = dict(REF, max_depth=0)


@query("older_collector_titles", f"""
WITH {walk_sql(**OLDER, namespaces="0")}
SELECT DISTINCT cat, title FROM rd WHERE kept AND kind = 'article'
""")
def older_collector_titles(spark, sf_dir):
    """F4 + W3 + L2 of the older collector: articles only, no subcategories."""
    return _walk(spark, sf_dir, dict(OLDER, namespaces=K.NAMESPACES_OLDER)).titles().distinct()


# The graph over the sources of documents; its titles are those of the landed extracts.
SOURCE_GRAPH_SQL = """
edges AS (
  SELECT DISTINCT cat, ns, title FROM (
    SELECT 'Kategorie:' || source AS cat, 14 AS ns, 'Kategorie:' || source || ' ' || lang AS title FROM documents
    UNION ALL
    SELECT 'Kategorie:' || source || ' ' || lang, 0, 'Doc ' || CAST(doc_id // 2 AS VARCHAR) FROM documents
    UNION ALL
    SELECT 'Kategorie:' || source, 0, 'Doc ' || CAST(doc_id // 2 AS VARCHAR) FROM documents
  ) WHERE cat IS NOT NULL AND title IS NOT NULL
),
members AS (
  SELECT cat, ns, title, CAST(row_number() OVER (PARTITION BY cat ORDER BY md5(title)) - 1 AS BIGINT) AS pos FROM edges
),
seeds AS (
  SELECT CAST(row_number() OVER (ORDER BY cat) AS BIGINT) AS seed_pos, cat
  FROM (SELECT DISTINCT 'Kategorie:' || source AS cat FROM documents WHERE source IS NOT NULL)
)"""


def _collect_sql(titles: str, text: str, keep: str) -> str:
    return f"""{EXTRACT_ROWS},
usable AS (SELECT arrival_pos, title, {text} AS text FROM extract_rows),
texts AS (SELECT title, arg_max(text, arrival_pos) AS text FROM usable WHERE {keep} GROUP BY title),
asked AS (
  SELECT title, CAST(row_number() OVER (ORDER BY title) - 1 AS BIGINT) AS title_pos
  FROM (SELECT DISTINCT title FROM {titles} WHERE kept AND kind = 'article')
)
SELECT title_pos, CAST(title_pos // {K.BATCH_SIZE} AS BIGINT) AS batch, title, text, text || chr(10) || chr(10) AS framed
FROM asked JOIN texts USING (title)
"""


def _collected(spark, sf_dir, collect, **limits):
    """A fresh corpus that one collector appended to."""
    extracts = landed.parse_extract_responses(landed.extract_responses(spark, sf_dir))
    found = collect(landed.source_seeds(spark, sf_dir), landed.source_members(spark, sf_dir), extracts, **limits)
    path = scratch_path(spark, "collected")
    write_corpus(found, path)
    return spark.read.parquet(path)


@query("collect_newer", f"WITH {walk_sql(**REF, graph=SOURCE_GRAPH_SQL)}," + _collect_sql("rd", ref_cut("extract"), nonblank("text")))
def collect_newer(spark, sf_dir):
    """The newer collector end to end with its own crawl limits: walk, distinct
    titles, batches, extracts, cut, non-blank, framed append."""
    return _collected(spark, sf_dir, C.collect_newer, **REF)


@query("collect_older", f"""
WITH {SOURCE_GRAPH_SQL},
chosen AS (SELECT DISTINCT cat, CAST(0 AS BIGINT) AS visit_pos FROM seeds),
{_read_sql("rd", "chosen", K.MAX_PAGES_PER_CATEGORY, landed.PAGE_SIZE, "0")},""" + _collect_sql("rd", "extract", "text <> ''"))
def collect_older(spark, sf_dir):
    """The older collector end to end: articles of the seed categories, whole texts."""
    return _collected(spark, sf_dir, C.collect_older)


def clear_caches() -> None:
    _WALK_CACHE.clear()
