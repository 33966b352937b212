"""Quality rules by repetition coverage.

Words become small integers per document; one pass of rolling hashes per n-gram length (each
length extends the hashes of the one before by a multiply and an add, in numpy) finds the n-grams
that occur more than once, and the characters inside them are measured: the union of all repeated
n-grams for the longer lengths, the most frequent n-gram for the shorter ones, and repeated lines.
A document fails the method's verdict when any of these shares exceeds its limit.

Edge cases: null, empty and blank texts have no words (all counts 0, base_failed, not kept);
documents shorter than an n-gram have share 0 there; rows are independent, so repeated rows, ties
and null ids pass through; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import map_texts

SYMBOLS = re.compile(r"[#*$%&|<>]")
# limits on shares of the word characters: lines, the most frequent n-gram, repeated n-grams
LINE_SHARE, LINE_CHAR_SHARE = 0.30, 0.20
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MULT = np.uint64(0x9E3779B97F4A7C15)
COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "line_share double, line_char_share double, top_shares array<double>, dup_shares array<double>")


def repeats(h: np.ndarray) -> np.ndarray | None:
    """How often each element's value occurs; None when no value occurs twice."""
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return None
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    return counts[inverse]


def covered(start: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside a window of n words that begins at a marked position."""
    step = np.zeros(words + 1, dtype=np.int64)
    at = np.flatnonzero(start)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step)[:words] > 0


def measure(text: str) -> tuple:
    raw = text.encode("utf-8")
    words = raw.split()  # bytes.split(): runs of [\x20\x09-\x0D] only
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.uint64)
    if raw.isascii():
        size = np.array([len(w) for w in words], dtype=np.int64)
    else:
        size = np.array([len(w.decode("utf-8")) for w in words], dtype=np.int64)
    total = int(size.sum())
    lines, n_lines, n_dup, dup_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        parts = line.encode("utf-8").split()
        if parts:
            n_lines += 1
            if line in lines:
                n_dup += 1
                dup_chars += sum(len(p.decode("utf-8")) for p in parts)
            lines.add(line)
    repeat3 = 0
    if n >= 3:
        k = np.uint64(len(seen))
        # below 2^21 different words three ids fit into 63 bits and are compared exactly
        tri = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
        count = repeats(tri)
        repeat3 = 0 if count is None else int(covered(count > 1, 3, n).sum())
    tops, dups = [], []
    mixed = (ids + np.uint64(1)) * MULT
    mixed ^= mixed >> np.uint64(29)
    h, ends = mixed, np.concatenate([[0], np.cumsum(size)])
    alive = True  # a repeated n-gram holds repeated shorter ones: stop at the first length without
    for g in range(2, max(DUP_LIMITS) + 1):
        count = None
        if alive and n >= g:
            h = h[:-1] * MULT + mixed[g - 1:]
            count = repeats(h ^ (h >> np.uint64(31)))
        alive = count is not None
        if g in TOP_LIMITS:
            tops.append(float(((ends[g:] - ends[:-g]) * count)[count > 1].max() / total) if alive else 0.0)
        else:
            dups.append(float(size[covered(count > 1, g, n)].sum() / total) if alive else 0.0)
    return (n, total, len(SYMBOLS.findall(text)), n_dup, repeat3, n_dup / max(n_lines, 1),
            dup_chars / max(total, 1), tops, dups)


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts and shares of :data:`COLUMNS`, ``base_failed`` and ``kept``."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    m = map_texts(d, lambda: measure, COLUMNS)
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    over = (F.col("line_share") > LINE_SHARE) | (F.col("line_char_share") > LINE_CHAR_SHARE)
    for name, limits in (("top_shares", TOP_LIMITS), ("dup_shares", DUP_LIMITS)):
        for i, limit in enumerate(limits.values()):
            over = over | (F.col(name)[i] > limit)
    return m.withColumn("base_failed", base).withColumn("kept", ~base & ~over)
