"""Line-first quality rules.

Each line of a text is judged by itself, failing lines are removed, and a
document is rejected if it is too short, repeats itself, or loses too much of
its text with its lines. A line without a word is neither judged nor counted.

Rules for a line (the first that holds names its fault):

* `repeated`: equal to an earlier line of the text;
* `navigation`: menu or table separators make up a fifth of its words or more (two at least);
* `symbols`: `# * $ % & | < >` outnumber a tenth of its words (three at least);
* `stutter`: a third of its words (of ten at least) equal the word before;
* `shouting`: five words or more and no lower-case letter beside upper-case ones;
* `punctuation`: it ends in no closing punctuation although it is short (fewer than `short_line` words)
  and neither the first nor the last such line: headings stay, menu entries go;
* `boilerplate`: one of the stock phrases in a line of at most 20 words.

Defined results: null and empty texts have no words and are rejected; a text of
any length is judged whole; every row is judged by itself, so repeated rows get
equal results; no other column is looked at.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The counted symbols, and white space as in [\x20\x09-\x0D].
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
SEPARATORS = (b"|", b"\xc2\xbb", b"\xe2\x80\xba", b"\xe2\x80\xa2", b"\xc2\xb7")
CLOSING = tuple(c.encode() for c in '.!?:;…"”’\')]}»。！？')
STOCK_PHRASES = (
    b"accept cookies",
    b"all rights reserved",
    b"click here",
    b"cookie policy",
    b"enable javascript",
    b"log in",
    b"privacy policy",
    b"sign up",
    b"subscribe to our",
    b"terms of service",
    b"terms of use",
)

RESULT = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, "
    "base_failed: boolean, kept_words: bigint, kept: boolean, text: string, faults: map<string, bigint>>"
)


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    # Percent of words that may lie in repeated windows, and that removed lines may hold.
    repeat_percent: int = 20
    lost_percent: int = 50
    short_line: int = 4


# Multipliers that mix five word hashes into one window hash.
_MIX = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], "u8")


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """The number of words in windows that occur twice or more, by exact comparison of what the hashes suggest."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), "i8", len(words)).view("u8")
    windows = np.zeros(n, "u8")
    for i in range(width):
        windows += hashes[i : i + n] * _MIX[i]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(windows, again)).tolist():
        places.setdefault(tuple(words[i : i + width]), []).append(i)
    hit = np.zeros(len(words), bool)
    starts = np.array([i for found in places.values() if len(found) > 1 for i in found], "i8")
    for i in range(width):
        hit[starts + i] = True
    return int(hit.sum())


def line_fault(line: bytes, words: list[bytes], seen: bool, edge: bool, limits: Limits) -> str | None:
    """The first rule that a line breaks, or none. `edge`: it is the first or last line with a word."""
    n = len(words)
    if seen:
        return "repeated"
    separators = sum(map(line.count, SEPARATORS))
    if separators >= 2 and 5 * separators >= n:
        return "navigation"
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols >= 3 and 10 * symbols > n:
        return "symbols"
    if n >= 10 and 3 * sum(map(eq, words, words[1:])) >= n:
        return "stutter"
    if n >= 5 and (text := line.decode()).upper() == text and text.lower() != text:
        return "shouting"
    if n < limits.short_line and not edge and not words[-1].endswith(CLOSING):
        return "punctuation"
    if n <= 20 and any(phrase in (low := line.lower()) for phrase in STOCK_PHRASES):
        return "boilerplate"
    return None


def judge(text: bytes, n_points: int, limits: Limits) -> dict:
    """All figures of one text, given as UTF-8 with its number of code points."""
    words = text.split()
    lines = text.split(b"\n")
    split = [line.split() for line in lines]
    full = [i for i, w in enumerate(split) if w]
    edges = {full[0], full[-1]} if full else set()
    seen: set[bytes] = set()
    kept, faults, kept_words, repeated = [], {}, 0, 0
    for i, line in enumerate(lines):
        if not split[i]:
            kept.append(line)
            continue
        fault = line_fault(line, split[i], line in seen, i in edges, limits)
        repeated += line in seen
        seen.add(line)
        if fault is None:
            kept.append(line)
            kept_words += len(split[i])
        else:
            faults[fault] = faults.get(fault, 0) + 1
    n, repeats = len(words), repeat_words(words)
    failed = n < limits.min_words or 100 * repeats > limits.repeat_percent * n
    return {
        "n_words": n,
        "word_chars": n_points - (len(text) - len(text.translate(None, WHITE))),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": repeated,
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept_words": kept_words,
        "kept": not failed and kept_words >= limits.min_words and 100 * (n - kept_words) <= limits.lost_percent * n,
        "text": b"\n".join(kept).decode(),
        "faults": list(faults.items()),
    }


def _arrow_type() -> pa.DataType:
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return pa.struct(
        [(c, pa.int64()) for c in longs]
        + [("base_failed", pa.bool_()), ("kept_words", pa.int64()), ("kept", pa.bool_())]
        + [("text", pa.string()), ("faults", pa.map_(pa.string(), pa.int64()))]
    )


def judge_text(text: Column, limits: Limits = Limits()) -> Column:
    """The figures, verdict, cleaned text and faults of a text as a struct; never null."""

    @F.arrow_udf(RESULT)
    def judged(column: pa.Array) -> pa.Array:
        texts = pc.fill_null(column.cast(pa.string()), "")
        points = pc.utf8_length(texts).to_pylist()
        rows = [judge(t, n, limits) for t, n in zip(texts.cast(pa.binary()).to_pylist(), points, strict=True)]
        return pa.array(rows, _arrow_type())

    return judged(text)
