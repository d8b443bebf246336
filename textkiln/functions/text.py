"""Column expressions with Python string semantics, kept JVM-side.

Spark and DuckDB ``trim`` remove spaces only and Java ``\\s`` differs from
Python's whitespace, so the classes are spelled out.  ``\\x{..}`` escapes are
understood by both Java regex and RE2, so the same pattern text also serves
the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.isspace()/str.strip() treat as whitespace.
PY_SPACE_CHARS = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
PY_SPACE = f"[{PY_SPACE_CHARS}]"
PY_NONSPACE = f"[^{PY_SPACE_CHARS}]"
# Line boundaries of Python's str.splitlines().
PY_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

# The same two classes apart: breaks end a line, the other blanks lie inside one.
_BREAK_CHARS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
_INNER_BLANKS = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"

# Section headings after which only references follow.
REFERENCE_HEADINGS = [
    "Einzelnachweise", "Weblinks", "Siehe auch", "Literatur",
    "Anmerkungen", "Fußnoten", "Quellen",
]

# Fixed value: namespace prefix of a subcategory title.
CATEGORY_PREFIX = "Kategorie:"


def py_strip(col: Column | str) -> Column:
    """``str.strip()``; a run of blanks inside the text is passed once."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, f"^{PY_SPACE}++|(?<!{PY_SPACE}){PY_SPACE}++$", "")


def py_nonblank(col: Column | str) -> Column:
    """``bool(s.strip())``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(PY_NONSPACE)


def py_splitlines(col: Column | str) -> Column:
    """Lines of a text as an array; like ``str.splitlines()`` but a trailing
    break yields one trailing empty element (callers drop empty lines)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, PY_LINE_BREAK, -1)


def seed_item_array(col: Column | str) -> Column:
    """The seed rule over all lines of a text in one pass: its non-blank lines
    that do not begin with ``#``, stripped, in order."""
    c = F.col(col) if isinstance(col, str) else col
    first = f"(?:^|(?<=[{_BREAK_CHARS}]))[{_INNER_BLANKS}]*+"
    item = f"([^#{PY_SPACE_CHARS}](?:[^{_BREAK_CHARS}]*{PY_NONSPACE})?+)"
    return F.regexp_extract_all(c, F.lit(first + item), F.lit(1))


def reference_cut_pattern(headings: list[str] | None = None) -> str:
    """Pattern matching from the first reference heading line to the end."""
    names = "|".join(headings or REFERENCE_HEADINGS)
    return f"(?s)\\n(?:{names}){PY_SPACE}*\\n.*$"


def strip_reference_sections(col: Column | str, headings: list[str] | None = None) -> Column:
    """Cut everything from the first ``\\n<heading><blanks>\\n``; keep all if none."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, reference_cut_pattern(headings), "")


def frame_document(col: Column | str) -> Column:
    """Document framing of the corpus file: text followed by a blank line."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(c, F.lit("\n\n"))
