"""SQL fragments shared by the DuckDB oracles (RE2 syntax)."""

from textkiln.functions.text import PY_LINE_BREAK, PY_NONSPACE, PY_SPACE, reference_cut_pattern

# Lines of documents.text as (doc_id, line_no, line), line_no 0-based.
DOC_LINES = f"""
doc_lines AS (
  SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split_regex(text, '{PY_LINE_BREAK}') AS parts FROM documents)
)"""

STRIP = "regexp_replace({x}, '^" + PY_SPACE + "+|" + PY_SPACE + "+$', '', 'g')"
NONBLANK = "regexp_matches({x}, '" + PY_NONSPACE + "')"
REF_CUT = "regexp_replace({x}, '" + reference_cut_pattern() + "', '')"

# Landed extract responses, derived directly from documents (see sources.landed).
EXTRACT_ROWS = """
extract_rows AS (
  SELECT doc_id AS arrival_pos,
         CAST(doc_id AS VARCHAR) AS page_key,
         CASE WHEN doc_id % 25 = 5 THEN '?' ELSE 'Doc ' || CAST(doc_id // 2 AS VARCHAR) END AS title,
         CASE WHEN doc_id % 10 = 3 THEN '' WHEN doc_id % 15 = 8 THEN '  ' || chr(10) ELSE text END AS extract
  FROM documents WHERE doc_id % 50 <> 17
)"""


def strip(x: str) -> str:
    return STRIP.replace("{x}", x)


def nonblank(x: str) -> str:
    return NONBLANK.replace("{x}", x)


def ref_cut(x: str) -> str:
    return REF_CUT.replace("{x}", x)
