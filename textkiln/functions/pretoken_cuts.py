"""Where the byte-level pattern cuts texts, found over whole Arrow batches.

The pattern's tokens cover a text without gaps, so a token is known by its
start.  A text is a series of runs of one class (letters, numbers, blanks, all
else), and the pattern comes to rules on where runs begin:

* every run begins a token, but not behind a space, which the token takes in;
* the last of several blanks before something else begins a token;
* ``'s 't 'm 'd 're 've 'll`` at a token's start are one, and what follows them
  begins the next;
* read line by line, a token begins behind each line's end, and blanks belong
  to the line's end behind them.

The classes of the code points come from the JVM's own pattern (``char_classes``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3
SPACE, LINE_END, APOSTROPHE = 0x20, 0x0A, 0x27


def _byte_classes(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each byte's code point (``data`` is valid UTF-8)."""
    out = np.concatenate([classes[:128], np.zeros(128, np.uint8)])[data]
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead]
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF8, 3)):
        at = lead[(first >= low) & (first < high)]
        point = data[at].astype(np.int32) & (0x3F >> more)
        for k in range(1, more + 1):
            point = (point << 6) | (data[at + k] & 0x3F)
        found = classes[point]
        for k in range(more + 1):
            out[at + k] = found
    return out


def token_starts(data: np.ndarray, text_starts: np.ndarray, classes: np.ndarray, lines: bool) -> np.ndarray:
    """Bytes of ``data`` where a token begins; ``text_starts`` are the first
    bytes of its texts, none of them empty."""
    if not len(data):
        return np.zeros(0, np.int64)
    kinds = _byte_classes(data, classes)
    first = np.zeros(len(data) + 3, bool)
    first[text_starts] = True
    begins = first.copy()  # of runs, and behind the last one
    begins[1 : len(data)] |= kinds[1:] != kinds[:-1]
    begins[len(data) :] = first[len(data) :] = True
    cut = begins[: len(data)].copy()
    blank, inside = kinds == BLANK, ~first[1 : len(data)]
    joined = np.zeros(len(data), bool)
    joined[1:] = cut[1:] & ~blank[1:] & inside & (data[:-1] == SPACE)
    cut &= ~joined

    closes = blank[:-1] & ~blank[1:] & inside  # the last byte of blanks before something else
    wide = np.flatnonzero(closes & (data[:-1] >= 0x80))
    cut[:-1] |= closes & (data[:-1] < 0x80) & (data[:-1] != LINE_END) if lines else closes & (data[:-1] < 0x80)
    for _ in range(3):
        wide = wide - ((data[wide] & 0xC0) == 0x80)
    cut[wide] = True
    if lines:
        behind = np.flatnonzero(data[:-1] == LINE_END) + 1
        cut[behind] = True

    at = np.flatnonzero(data == APOSTROPHE)
    start = at[begins[at] & ~joined[at] & begins[at + 1] & ~first[at + 1]] + 1
    start = start[kinds[start] == LETTER]
    one, two = data[start], data[np.minimum(start + 1, len(data) - 1)]
    long = ~begins[start + 1] & (((two == ord("e")) & np.isin(one, list(b"rv"))) | ((one == ord("l")) & (two == ord("l"))))
    short = np.isin(one, list(b"stmd"))
    cut[start[short | long]] = False
    behind = np.concatenate([start[short] + 1, start[long] + 2])
    cut[behind[~begins[behind]]] = True
    return np.flatnonzero(cut)


def cut_texts(texts: pa.Array, classes: np.ndarray, lines: bool) -> pa.ListArray:
    """The tokens of each text, over the same bytes; null texts have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    base = int(ends[0])
    ends = ends - base
    data = np.frombuffer(data, np.uint8, int(ends[-1]), base) if ends[-1] else np.zeros(0, np.uint8)
    starts = token_starts(data, ends[:-1][np.diff(ends) > 0], classes, lines)
    bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
    tokens = pa.Array.from_buffers(pa.string(), len(starts), [None, bounds, pa.py_buffer(data)])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, ends).astype(np.int32)), tokens)
