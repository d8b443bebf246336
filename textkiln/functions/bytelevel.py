"""Byte-level alphabet of the BPE vocabulary, built from its rule.

Every byte maps to one printable character: the printable ranges ``!``..``~``,
``¡``..``¬`` and ``®``..``ÿ`` map to themselves, the remaining 68 bytes map in
byte order to U+0100, U+0101, ...  Vocabulary ids: 0 is the special token,
1..256 are the 256 byte characters sorted by code point, merges follow from 257.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The special token and its id.
SPECIAL_TOKEN = "<|endoftext|>"
SPECIAL_ID = 0
FIRST_MERGE_ID = 257

# Byte ranges printed as themselves (inclusive bounds).
PRINTABLE_RANGES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def _build_tables():
    printable = [b for lo, hi in PRINTABLE_RANGES for b in range(lo, hi + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    char_of = {b: chr(b) for b in printable}
    for n, b in enumerate(others):
        char_of[b] = chr(256 + n)
    ordered = sorted(range(256), key=lambda b: ord(char_of[b]))
    id_of = {b: i + 1 for i, b in enumerate(ordered)}
    return char_of, id_of


BYTE_CHAR, BYTE_ID = _build_tables()
ID_BYTE = {i: b for b, i in BYTE_ID.items()}
CHAR_BYTE = {c: b for b, c in BYTE_CHAR.items()}


def byte_id_expr(b: Column) -> Column:
    """Vocabulary id of a byte value (0..255) as a JVM expression (same rule)."""
    n_printable = sum(hi - lo + 1 for lo, hi in PRINTABLE_RANGES)  # 188
    expr = None
    base = 1
    for lo, hi in PRINTABLE_RANGES:
        cond = (b >= lo) & (b <= hi)
        val = b - lo + base
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        base += hi - lo + 1
    # Non-printable bytes follow in byte order: rank among them + 189.
    rank = b - F.when(b > 0xAD, F.lit(n_printable)).when(b > 0xA0, F.lit(94 + 12)).when(b > 0x7E, F.lit(94)).otherwise(F.lit(0))
    return expr.otherwise(rank + n_printable + 1).cast("int")


def utf8_byte_values(word: Column) -> Column:
    """``array<int>`` of the UTF-8 bytes of ``word`` (JVM-side: the bytes read
    back as ISO-8859-1 give one character per byte, whose code point is the
    byte value)."""
    latin1 = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.transform(F.split(latin1, ""), F.ascii)  # one pass; a substring for each byte would be quadratic


def utf8_byte_ids(word: Column) -> Column:
    """``array<int>`` of byte ids of the UTF-8 encoding of ``word``; each byte
    is computed once, then mapped by the alphabet rule."""
    return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(utf8_byte_values(word), byte_id_expr)
    )


def to_bytelevel(text: str) -> str:
    return "".join(BYTE_CHAR[b] for b in text.encode("utf-8"))


def from_bytelevel(token: str) -> bytes:
    return bytes(CHAR_BYTE[c] for c in token)
