"""Sequence packing by non-negative least squares over shallow length combinations.

Documents become token ids plus one end id.  Whole windows of ``window`` tokens are cut off as
sequences of their own; the remaining tails (shorter than the window) are packed in blocks: a
block's tails give a histogram of lengths, all combinations of two or three lengths that fill the
window exactly are enumerated, non-negative least squares finds how often to repeat each so that
the histogram is used up, the counts are rounded down to what the histogram holds, and the
residual tails are laid greedily one after the other, cut where a sequence is full.  The last,
unfilled stretch of a block is cut into sequences of power-of-two lengths, which need no padding.

A block is a run of rows of one Spark partition (``block_tokens`` at most, plus one document), so
packing needs no shuffle, a task holds one block, and a lost task is simply run again.  Sequence
ids are (partition, block, number) and so unique without coordination.

Edge cases: null text is empty and gives the end id alone; empty tables give no pieces; repeated
rows and null ids are packed like any other row; very long texts are cut; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SPECIAL = "<|endoftext|>"
PIECES = ("doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long")


# -- tokens ------------------------------------------------------------------------------------
class Encoder:
    """Ids of ``byte_bpe_50k.json``.  The rank file of the same vocabulary gives the same ids
    several times faster; texts with the special token's string go through the json tokenizer."""

    def __init__(self, tokenizer_path: str):
        import base64

        import public_tokenizers
        import tiktoken
        self.path, self.slow = tokenizer_path, None
        with open(tokenizer_path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


# -- plan --------------------------------------------------------------------------------------
def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All multisets of two or three of the given lengths with sum ``window``: rows (a, b, c),
    a <= b <= c, with a = 0 for pairs.  At most window^2 / 12 + window / 2 rows."""
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    have[0] = True
    a, b = np.meshgrid(np.flatnonzero(have), lengths, indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    ok = (a <= b) & (b <= c)
    a, b, c = a[ok], b[ok], c[ok]
    ok = have[c]
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def nnls_counts(combos: np.ndarray, hist: np.ndarray, steps: int = 100) -> np.ndarray:
    """x >= 0 minimising |A x - hist|, A[l, j] = times length l is in combination j: accelerated
    projected gradient; a column of A has at most three entries, so A is never built."""
    if not len(combos):
        return np.zeros(0)
    n = len(hist)
    cols = [np.ascontiguousarray(combos[:, i]) for i in range(3)]
    deg = sum(np.bincount(c, minlength=n) for c in cols).astype(float)
    # a length's misfit is shared among the combinations that use it (a diagonal preconditioner)
    scale = 1.0 / np.maximum(deg, 1.0)
    scale[0] = 0.0
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(steps):
        r = (sum(np.bincount(c, y, minlength=n) for c in cols) - hist) * scale
        new = np.maximum(y - (r[cols[0]] + r[cols[1]] + r[cols[2]]) / 3.0, 0.0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = np.maximum(new + (t - 1) / t2 * (new - x), 0.0)
        x, t = new, t2
    return x


def rounded(combos: np.ndarray, x: np.ndarray, hist: np.ndarray) -> np.ndarray:
    """Whole repeat counts that the histogram can serve, largest shares first: the counts rounded
    down, then one more round for what that leaves of the same combinations' lengths."""
    left = hist.tolist()
    counts = np.zeros(len(combos), dtype=np.int64)
    order = np.argsort(-x, kind="stable")
    order = order[x[order] > 1e-2]
    rows, share = combos[order].tolist(), x[order].astype(np.int64).tolist()
    for extra in (False, True):
        for j, (a, b, c), want in zip(order.tolist(), rows, share, strict=True):
            if not (extra or want) or not (left[b] and left[c]):
                continue
            if a == c:
                most = left[c] // 3
            elif b == c:
                most = min(left[c] // 2, left[a] if a else left[c])
            elif a == b:
                most = min(left[a] // 2, left[c])
            else:
                most = min(left[b], left[c], left[a] if a else left[b])
            k = most if extra else min(want, most)
            if k:
                counts[j] += k
                for part in (a, b, c):
                    if part:
                        left[part] -= k
    return counts


def plan_tails(tails: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence number and offset of every tail placed by the plan (-1: residual), and the number
    of sequences used."""
    hist = np.bincount(tails, minlength=window + 1)
    combos = combinations(np.flatnonzero(hist), window)
    counts = rounded(combos, nnls_counts(combos, hist.astype(float)), hist)
    used = np.flatnonzero(counts)
    seq0 = np.concatenate([[0], np.cumsum(counts[used])])
    by_len = np.argsort(tails, kind="stable")
    at = np.concatenate([[0], np.cumsum(hist)])[: window + 1].astype(np.int64)
    seq, off = np.full(len(tails), -1, dtype=np.int64), np.zeros(len(tails), dtype=np.int64)
    for s, j in zip(seq0, used, strict=False):
        o, k = 0, counts[j]
        for length in combos[j]:
            if length:
                rows = by_len[at[length]:at[length] + k]
                seq[rows], off[rows] = np.arange(s, s + k), o
                at[length] += k
                o += int(length)
    return seq, off, int(seq0[-1])


def pack_block(lengths: np.ndarray, window: int = 1024) -> np.ndarray:
    """Pieces of a block of documents: rows (doc, start, length, sequence, offset, sequence length);
    every token of every document lies in exactly one piece."""
    full = lengths // window
    tail = lengths - full * window
    out = []
    d = np.repeat(np.arange(len(lengths)), full)
    k = np.arange(len(d)) - np.repeat(np.cumsum(full) - full, full)
    n_full = len(d)
    w = np.full(n_full, window)
    out.append(np.stack([d, k * window, w, np.arange(n_full), np.zeros(n_full, dtype=np.int64), w], axis=1))
    docs = np.flatnonzero(tail)
    if len(docs):
        t = tail[docs]
        seq, off, n_seq = plan_tails(t, window)
        placed = seq >= 0
        p = docs[placed]
        out.append(np.stack([p, full[p] * window, tail[p], n_full + seq[placed], off[placed],
                             np.full(len(p), window)], axis=1))
        # residuals, longest first, one after the other; bounds: full windows, then powers of two
        rest = docs[~placed][np.argsort(-t[~placed], kind="stable")]
        total = int(tail[rest].sum())
        sizes = [window] * (total // window) + [1 << b for b in range(62, -1, -1) if (total % window) >> b & 1]
        ends = np.cumsum(sizes).astype(np.int64)
        begin = np.cumsum(tail[rest]) - tail[rest]
        cuts = np.unique(np.concatenate([begin, ends - np.array(sizes, dtype=np.int64), [total]]))
        a, b = cuts[:-1], cuts[1:]
        i = np.searchsorted(begin, a, side="right") - 1
        s = np.searchsorted(ends, a, side="right")
        size = np.array(sizes, dtype=np.int64)[s] if len(a) else np.zeros(0, dtype=np.int64)
        r = rest[i] if len(a) else rest[:0]
        out.append(np.stack([r, full[r] * window + a - begin[i], b - a, n_full + n_seq + s,
                             a - (ends[s] - size), size], axis=1))
    return np.concatenate(out).astype(np.int64)


# -- operator ----------------------------------------------------------------------------------
def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0,
         block_tokens: int = 16_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: ``doc_id, start, length, ids`` (little-endian uint32), ``doc_tokens, sequence_id,
    offset, sequence_length``.  A sequence's pieces are gapless from offset 0; sequences have
    ``window`` tokens or a power of two."""
    id_type = docs.schema[id_col].dataType.simpleString()

    schema = pa.schema([("doc_id", to_arrow_type(docs.schema[id_col].dataType)), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("sequence_length", pa.int64())])

    def flush(part: int, block: int, ids: list, tokens: list) -> Iterator[pa.RecordBatch]:
        rows = pack_block(np.array([len(t) for t in tokens], dtype=np.int64), window)
        base = (part << 42) + (block << 28)
        for k in range(0, len(rows), 4096):
            r = rows[k:k + 4096]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in r[:, 0]], schema.field("doc_id").type), pa.array(r[:, 1]), pa.array(r[:, 2]),
                pa.array([tokens[i][s:s + n].tobytes() for i, s, n in r[:, :3].tolist()], pa.binary()),
                pa.array([len(tokens[i]) for i in r[:, 0]], pa.int64()), pa.array(base + r[:, 3]),
                pa.array(r[:, 4]), pa.array(r[:, 5])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Encoder(tokenizer_path), np.array([end_id], dtype=np.uint32)
        part = TaskContext.get().partitionId()
        block, n, ids, tokens = 0, 0, [], []
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                tokens.append(np.concatenate([encode(text), end]))
                n += len(tokens[-1])
                if n >= block_tokens:
                    yield from flush(part, block, ids, tokens)
                    block, n, ids, tokens = block + 1, 0, [], []
        if ids:
            yield from flush(part, block, ids, tokens)

    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.mapInArrow(run, PIECES.format(id_type=id_type))
