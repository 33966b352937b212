"""Spelling variants: words one edit apart, by range searches in k-d trees over letter counts.

One replaced letter takes one letter from a word's letter counts and adds one; an inserted or deleted
one only adds or takes: at most 2 in L1 distance.  So the near words of a word are, per pair of
lengths, a range search around its letter counts, and an order check of what the search finds.

1. Words are counted over whole texts: a counter per task, then one sum per word.
2. A k-d tree per word length cuts the letter-count space into cells of at most CELL words.  Splits
   are found level by level: the executors count letter values per open node, one aggregate
   picks the best balanced cut, and only the cuts (one a node) reach the driver.
3. A word goes to its own cell as a point, and as a query to every cell whose box it can reach: per
   pair of lengths with one letter up and one down (same length), one up (longer) or one
   down (shorter).  Cells are searched alone, each with its own smaller k-d tree and box pruning.
4. A cell answers a query with one row: how many near words, and the best of them.  No pairs leave it.

Words of equal letter counts are never near (two edits at least), so a cell that can't be split, which
holds these only, costs its queries and nothing inside.  Roots follow forms by pointer doubling.

Edge cases: null and empty texts have no words; a null id counts as an empty one in the deletion rule;
repeated rows count again; words of any length take part; an empty table gives an empty result; other
columns are never touched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import written

FIRST, LAST = 0xC0, 0xFF        # letters beyond a-z
DIMS = 26 + LAST - FIRST + 1
CELL = 16_384                   # words a cell
LEAF = 48                       # words a leaf of a cell's own tree
PAIRS = 4_000_000               # distances computed at once
HELD = 400_000                  # different words a task holds before it hands its counts on
REACH = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}  # length difference -> letters up, letters down


# -- words -------------------------------------------------------------------------------------
def word_counts(docs: DataFrame, min_chars: int = 6, min_count: int = 5, drop_one_in: int | None = 199,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all runs of letters (A-Z lower-cased) with enough letters and occurrences.  Where
    ``drop_one_in`` divides crc32 of ``<id>:<run>``, the run has lost its letter number crc32 modulo its length."""
    d = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")) \
        .where(F.col("text").isNotNull())

    def run(batches):
        import re
        import zlib
        runs = re.compile(f"[A-Za-z{chr(FIRST)}-{chr(LAST)}]{{{min_chars},}}")
        total: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                               pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = Counter(runs.findall(t.encode("utf-8").lower().decode("utf-8")))  # bytes: A-Z only
                if drop_one_in:
                    begun, dropped = zlib.crc32(f"{i}:".encode()), []
                    for w in found:
                        h = zlib.crc32(w.encode("utf-8"), begun)
                        if h % drop_one_in == 0:
                            dropped.append((w, h % len(w)))
                    short = [(w[:k] + w[k + 1:], found.pop(w)) for w, k in dropped]
                    for w, n in short:
                        if len(w) >= min_chars:
                            found[w] += n
                total.update(found)
                if len(total) >= HELD:
                    yield flush()
                    total.clear()
        yield flush()

    return (d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def letter_codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letter numbers (a-z, then the others)."""
    size = len(words[0])
    c = np.array(words, dtype=f"U{size}").view(np.uint32).reshape(len(words), size).astype(np.int64)
    return np.where(c < FIRST, c - 97, c - FIRST + 26)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    flat = (np.arange(len(codes))[:, None] * DIMS + codes).ravel()
    return np.bincount(flat, minlength=len(codes) * DIMS).reshape(len(codes), DIMS)


def by_length(words: list[str]) -> dict[int, np.ndarray]:
    sizes = np.array([len(w) for w in words])
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


# -- the tree over all words ---------------------------------------------------------------------
@dataclass
class Tree:
    """Node numbers: ``cut[node] = (letter, value, low, high)`` for inner nodes (low: count <= value); other nodes are
    cells.  ``roots``: word length -> node."""
    roots: dict[int, int] = field(default_factory=dict)
    cut: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)

    def home(self, size: int, counts: np.ndarray) -> np.ndarray:
        """The cell of every word."""
        out = np.empty(len(counts), dtype=np.int64)
        todo = [(self.roots[size], np.arange(len(counts)))]
        while todo:
            node, at = todo.pop()
            if node not in self.cut:
                out[at] = node
                continue
            d, v, low, high = self.cut[node]
            below = counts[at, d] <= v
            todo += [(low, at[below]), (high, at[~below])]
        return out

    def reached(self, size: int, counts: np.ndarray, up: int, down: int):
        """``cell, words`` of every cell of words of length ``size`` that lies within reach of the words."""
        if size not in self.roots:
            return
        todo = [(self.roots[size], np.arange(len(counts)), {}, {})]
        while todo:
            node, at, lo, hi = todo.pop()
            more = sum((np.maximum(v - counts[at, d], 0) for d, v in lo.items()), np.zeros(len(at), dtype=np.int64))
            less = sum((np.maximum(counts[at, d] - v, 0) for d, v in hi.items()), np.zeros(len(at), dtype=np.int64))
            at = at[(more <= up) & (less <= down)]
            if not len(at):
                continue
            if node not in self.cut:
                yield node, at
                continue
            d, v, low, high = self.cut[node]
            todo += [(low, at, lo, {**hi, d: min(v, hi.get(d, v))}), (high, at, {**lo, d: max(v + 1, lo.get(d, 0))}, hi)]


def best_cuts(vocab: DataFrame, tree: Tree, open_nodes: set[int]) -> list:
    """``node, total, letter, value`` of the best balanced cut of the open nodes (value null: none cuts)."""
    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            rows = []
            for size, at in by_length(words).items():
                counts = letter_counts(letter_codes([words[i] for i in at]))
                node = tree.home(size, counts)
                for k in np.unique(node):
                    if int(k) not in open_nodes:
                        continue
                    mine = counts[node == k]
                    rows.append((int(k), -1, 0, len(mine)))
                    r, d = np.nonzero(mine)
                    key, n = np.unique(d * (1 << 32) + mine[r, d], return_counts=True)
                    rows += [(int(k), int(x >> 32), int(x & 0xFFFFFFFF), int(y)) for x, y in zip(key, n, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows
                                             else [pa.array([], pa.int64())] * 4, names=["node", "d", "v", "n"])

    h = (vocab.select("word").mapInArrow(run, "node long, d long, v long, n long")
         .groupBy("node", "d", "v").agg(F.sum("n").alias("n")))
    node = Window.partitionBy("node")
    h = (h.withColumn("total", F.max(F.when(F.col("d") == -1, F.col("n"))).over(node)).where("d >= 0")
         .withColumn("above", F.sum("n").over(Window.partitionBy("node", "d").orderBy(F.desc("v"))))
         .withColumn("even", F.least("above", F.col("total") - F.col("above"))))
    best = F.max(F.when(F.col("even") > 0, F.struct("even", (-F.col("d")).alias("d"), (-F.col("v")).alias("v"))))
    return [(r["node"], r["total"], None if r["b"] is None else -r["b"]["d"], None if r["b"] is None else -r["b"]["v"] - 1)
            for r in h.groupBy("node").agg(F.max("total").alias("total"), best.alias("b")).collect()]


def grow(vocab: DataFrame, cell: int = CELL) -> Tree:
    """Splits every length's words until a cell holds at most ``cell`` of them or only equal counts."""
    tree = Tree()
    sizes = vocab.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()
    for i, r in enumerate(sizes):
        tree.roots[r["size"]] = i
    n_nodes, todo = len(sizes), {i for i, r in enumerate(sizes) if r["n"] > cell}
    while todo:
        cuts = sorted((node, total, d, v) for node, total, d, v in best_cuts(vocab, tree, todo)
                      if total > cell and d is not None)
        todo = set()
        for node, _, d, v in cuts:
            tree.cut[node] = (d, v, n_nodes, n_nodes + 1)
            todo |= {n_nodes, n_nodes + 1}
            n_nodes += 2
    return tree


def dealt(vocab: DataFrame, tree: Tree) -> DataFrame:
    """``cell, step, word, n``: words as points of their own cell (step null) and as queries of the cells in reach
    (step: the cell's word length less the word's)."""
    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            cell, step, at = [], [], []
            for size, mine in by_length(words).items():
                counts = letter_counts(letter_codes([words[i] for i in mine]))
                cell.append(tree.home(size, counts))
                step.append(np.full(len(mine), 9))
                at.append(mine)
                for s, (up, down) in REACH.items():
                    for node, x in tree.reached(size + s, counts, up, down):
                        cell.append(np.full(len(x), node))
                        step.append(np.full(len(x), s))
                        at.append(mine[x])
            if not at:
                continue
            step, at = np.concatenate(step), pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cell), pa.int64()), pa.array(step, pa.int64(), mask=step == 9),
                 b.column(0).take(at), b.column(1).take(at)], names=["cell", "step", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, "cell long, step long, word string, n long")


# -- inside a cell -------------------------------------------------------------------------------
def ordered(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which pairs of letter rows are one edit apart."""
    if q.shape[1] == p.shape[1]:
        return (q != p).sum(axis=1) == 1
    short, long = (q, p) if q.shape[1] < p.shape[1] else (p, q)
    size = short.shape[1]
    head = np.argmin(np.append(short == long[:, :size], np.zeros((len(q), 1), dtype=bool), axis=1), axis=1)
    tail = np.argmin(np.append((short == long[:, 1:])[:, ::-1], np.zeros((len(q), 1), dtype=bool), axis=1), axis=1)
    return head + tail >= size


def search(points: np.ndarray, queries: np.ndarray, up: int, down: int):
    """``query, point`` index pairs whose letter counts differ by exactly ``up`` letters more and ``down`` fewer."""
    goal = up + down
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        s, q = todo.pop()
        mine = points[s]
        lo, hi = mine.min(axis=0), mine.max(axis=0)
        x = queries[q]
        q = q[(np.maximum(lo - x, 0).sum(axis=1) <= up) & (np.maximum(x - hi, 0).sum(axis=1) <= down)]
        if not len(q):
            continue
        spread = mine.astype(np.float32).var(axis=0)
        d = int(spread.argmax())
        if len(s) <= LEAF or not spread[d]:
            # squared distance 1 or 2 with the given sum of differences is one letter up, down or both
            a = mine.astype(np.float32)
            for i in range(0, len(q), max(1, PAIRS // len(s))):
                part = q[i:i + max(1, PAIRS // len(s))]
                b = queries[part].astype(np.float32)
                far = (b * b).sum(axis=1)[:, None] + (a * a).sum(axis=1)[None, :] - 2 * (b @ a.T)
                i1, i2 = np.nonzero(far == goal)
                yield part[i1], s[i2]
            continue
        v = int(np.floor(mine[:, d].mean()))
        below = mine[:, d] <= v
        todo += [(s[below], q), (s[~below], q)]


def answers(cells: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every query that finds a near word in a cell."""
    def run(t: pa.Table) -> pa.Table:
        step = np.array([9 if x is None else x for x in t.column("step").to_pylist()])
        word, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        mine = np.flatnonzero(step == 9)
        names = [word[i] for i in mine]
        code = letter_codes(names)
        count = letter_counts(code)
        order = sorted(range(len(mine)), key=lambda i: (-n[mine[i]], names[i]))
        rank = np.empty(len(mine), dtype=np.int64)
        rank[order] = np.arange(len(mine))
        out = []
        for s, (up, down) in REACH.items():
            q = np.flatnonzero(step == s)
            if not len(q):
                continue
            q_code = letter_codes([word[i] for i in q])
            q_count = letter_counts(q_code)
            used = np.flatnonzero(count.any(axis=0) | q_count.any(axis=0))
            near, best = np.zeros(len(q), dtype=np.int64), np.full(len(q), len(mine))
            for a, b in search(count[:, used].astype(np.int32), q_count[:, used].astype(np.int32), up, down):
                ok = ordered(q_code[a], code[b])
                np.add.at(near, a[ok], 1)
                np.minimum.at(best, a[ok], rank[b[ok]])
            out += [(word[q[i]], int(near[i]), int(n[mine[order[best[i]]]]), names[order[best[i]]])
                    for i in np.flatnonzero(near)]
        return pa.table([pa.array(c, k) for c, k in zip(
            list(zip(*out, strict=True)) or [()] * 4, [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)],
            names=["word", "n_near", "best_n", "best"])

    # a cell that no query reaches has nothing to answer; one without points does not exist
    return cells.groupBy("cell").applyInArrow(run, "word string, n_near long, best_n long, best string")


# -- forms and roots -----------------------------------------------------------------------------
def near_words(vocab: DataFrame, cell: int = CELL) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near words; ``vocab``: ``word, n``, read several times."""
    found = answers(dealt(vocab, grow(vocab, cell)))
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("x"))
            .select("word", "n_near", (-F.col("x.n")).alias("best_n"), F.col("x.w").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (no cycles): every round doubles the way each word has gone."""
    way = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = way.join(on, "root", "left")
        if step.where(F.col("further").isNotNull()).isEmpty():
            return way
        way = written(step.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, drop_one_in: int | None = 199,
             id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """``word, n, n_near, form, form_n, root``: a word's form is its near word of largest n (ties: the smallest
    word) where that n is at least ``ratio`` times the word's; the root is the last form."""
    vocab = written(word_counts(docs, min_chars, min_count, drop_one_in, id_col, text_col), "spelling-words")
    near = vocab.join(near_words(vocab, cell), "word", "left")
    big = F.col("best_n") >= ratio * F.col("n")
    out = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(big, F.col("best")).alias("form"), F.when(big, F.col("best_n")).alias("form_n")),
                  "spelling-forms")
    last = roots(out.where(F.col("form").isNotNull()))
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
