"""Operators 11 to 13: against brute force over random and edge rows, and hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import cover_dedup as cd
from tabwright.llm import merkle_manifest as mm
from tabwright.llm import spelling_groups as sg
from tabwright.llm.queries import LEAF_COLUMNS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = r"[^\x20\x09-\x0D]+"


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# -- Merkle manifest ---------------------------------------------------------------------------
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(digests):
    """The top, and per leaf the (left, right) siblings from the leaf upwards."""
    paths, now, below = [[] for _ in digests], list(digests), [[i] for i in range(len(digests))]
    while len(now) > 1:
        up, held = [], []
        for a in range(0, len(now), 16):
            run = now[a:a + 16]
            for k in range(len(run)):
                for i in below[a + k]:
                    paths[i].append((run[:k], run[k + 1:]))
            up.append(H(*run))
            held.append([i for x in below[a:a + 16] for i in x])
        now, below = up, held
    return now[0], paths


def brute_proofs(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: brute_tree([d for _, d in groups[s]]) for s in names}
    if not names:
        return []
    root, crown = brute_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, crown, strict=True):
        for (r, d), path in zip(groups[s], trees[s][1], strict=True):
            path = path + above
            f = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                f = leaf((*r[:4], r[4].translate(str.maketrans(UPPER, UPPER.lower()))))
            for left, right in path:
                f = H(*left, f, *right)
            out.append((r[0], d, trees[s][0], root, H(*[x for a, b in path for x in a + b]), f, f == root))
    return out


def proofs(docs):
    """As the query does it."""
    changed = mm.leaf_of(*[F.translate(c, UPPER, UPPER.lower()) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    m = mm.build(docs, LEAF_COLUMNS, carry={"tampered": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.unhex(changed))})
    p = mm.prove(m, m.leaves, "id", "tampered")
    f = mm.fold(mm.hex_text(F.coalesce("tampered", "leaf")), F.col("path"))
    rows = p.select("id", mm.hex_text(F.col("leaf")), mm.hex_text(F.col("subroot")), F.lit(m.root), mm.proof_digest(F.col("path")), f)
    return [(*r, r[5] == r[3]) for r in rows.collect()]


DOC = "doc_id long, source string, lang string, n_chars long, text string"


def documents(spark, rows):
    """With further columns that are named as the operators' own."""
    d = spark.createDataFrame(rows, DOC).repartition(3)
    return d.select("*", *[F.lit(1).alias(c) for c in ("node", "gid", "rank", "n", "path", "chunk", "word", "cell", "g", "grp")])


def manifest_cases():
    rng = random.Random(2)
    mixed = [(rng.choice([None, *range(300)]), rng.choice([None, "a", "a", "a", "é", "b"]), "l", 3, rng.choice([None, "", "Ab", "é"]))
             for _ in range(400)]
    return {"mixed": mixed, "one": [(1, "a", None, None, "X")], "17 without source": [(i, None, None, None, "X") for i in range(17)],
            "many sources": [(i, str(i), "l", 1, "t") for i in range(300)], "repeated row": [(5, "a", "l", 1, "Same")] * 40, "none": []}


@pytest.mark.parametrize("case", sorted(manifest_cases()))
def test_manifest_equals_brute_force(spark, case):
    rows = manifest_cases()[case]
    same(proofs(documents(spark, rows)), brute_proofs(rows))


def test_proofs_of_some_leaves_only(spark):
    rows = [(i, "ab"[i % 3 == 0], "l", 1, f"T{i}") for i in range(600)]
    m = mm.build(documents(spark, rows), LEAF_COLUMNS)
    asked = m.leaves.where("rank in (0, 255, 399)")
    p = mm.prove(m, asked, "id")
    got = [(r["id"], r["f"]) for r in p.select("id", mm.fold(mm.hex_text(F.col("leaf")), F.col("path")).alias("f")).collect()]
    assert len(got) == asked.count() == 4
    assert {f for _, f in got} == {m.root}
    # every record of a written level is addressed by its content
    level = m.trees.levels[0].select(mm.hex_text(F.col("node")).alias("d"), mm.hex_text(F.col("children")).alias("k")).collect()
    assert all(H(r["k"]) == r["d"] for r in level)


# -- cover dedup -------------------------------------------------------------------------------
def brute_repeats(rows, width=13):
    far = float("inf")
    words = [re.findall(BLANKS, t or "") for _, t in rows]
    keys = [far if i is None else i for i, _ in rows]
    first = {}
    for k, w in zip(keys, words, strict=True):
        for s in range(len(w) - width + 1):
            q = tuple(w[s:s + width])
            first[q] = min(first.get(q, far), k)
    out = []
    for (i, _), k, w in zip(rows, keys, words, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < k:
                gone[s:s + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def cover_rows(r):
    return [(x["doc_id"], x["n_words"], sum(s["end"] - s["begin"] for s in x["spans"]), x["kept"]) for x in r.collect()]


def passages(n, seed=1):
    """Documents cut from a few passages, edges of 12 and 13 words among them."""
    rng = random.Random(seed)
    pool = [[rng.choice(["a", "bb", "été", "x" * 70, "x" * 69 + "y", f"w{rng.random()}"]) for _ in range(60)] for _ in range(4)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.choice([0, 1, 3])):
            p, size = rng.choice(pool), rng.choice([5, 12, 13, 14, 40])
            a = rng.randrange(60 - size)
            w += p[a:a + size] + [f"u{rng.random()}"] * rng.choice([0, 1, 20])
        rows.append((rng.choice([None, *range(40)]), None if rng.random() < .05 else rng.choice([" ", "\n", " \t\r "]).join(w)))
    return rows


@pytest.mark.parametrize("period", range(1, 33))
def test_cover_has_every_difference(period):
    cover = cd.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert period != 7 or cover == [0, 1, 3]


@pytest.mark.parametrize("chunk, block", [(8_000_000, 1_000_000), (900, 150)])
def test_cover_dedup_equals_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(cd, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(cd, "HASH_BYTES", block)
    rows = passages(150)
    docs = documents(spark, [(i, "s", "l", 1, t) for i, t in rows]).repartition(4)
    for width in (13, 8):
        got = cover_rows(cd.remove_repeats(docs, width))
        assert sum(r[2] for r in got) > 500
        same(got, brute_repeats(rows, width))


def test_cover_dedup_edges(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(None, None), (None, ""), (1, " \n\t "), (2, "a b"), (3, long), (4, long + " tail"), (4, long), (None, long),
            (5, "z" * 3_000_000), (6, " ".join(["same"] * 40)), (7, " ".join(["same"] * 13)), (7, " ".join(["same"] * 13))]
    same(cover_rows(cd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))), brute_repeats(rows))
    none = cd.remove_repeats(spark.createDataFrame([], "doc_id int, text string"))
    assert none.collect() == [] and dict(none.dtypes)["doc_id"] == "int"


def test_a_hot_passage_reaches_its_bucket_once_a_chunk(spark):
    """The rows that leave a chunk for the buckets don't grow with the copies that the chunk holds."""
    passage = " ".join(f"p{i}" for i in range(40))
    sent = []
    for n in (50, 800):
        docs = spark.createDataFrame([(i, passage) for i in range(n)], "doc_id long, text string").coalesce(1)
        chunks = cd.chunked(docs, "doc_id", "text")
        rows = cd.anchor_codes(chunks, 13, 32).collect()
        sent.append(sum(len(r["codes"]) for r in rows))
    assert sent[0] == sent[1] > 0


# -- spelling variants -------------------------------------------------------------------------
def brute_variants(rows):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(str.maketrans(UPPER, UPPER.lower()))
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                count[w] += 1
    n = {w: k for w, k in count.items() if k >= 5}
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
    near = defaultdict(set)
    for (a, b), ws in holes.items():
        for w in ws:
            near[w] |= ws - {w}
            if a + b in n:
                near[w].add(a + b)
                near[a + b].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return out


def edited(rng, w):
    k = rng.randrange(len(w))
    return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÀé") + w[k:], w[:k] + rng.choice("abÀé") + w[k + 1:]])


@pytest.mark.parametrize("cell", [25, 16_384])
def test_variants_equal_brute_force(spark, cell):
    """Small cells make a deep tree; words of few letters share their counts; chains of forms."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abÀé") for _ in range(rng.choice([6, 7, 8, 15]))) for _ in range(40)]
    rows = []
    for w in words:
        u = edited(rng, w)
        rows += [(k, f"{w} {w}, {w}") for k in range(60)] + [(k, f"{u.upper()}-{u}") for k in range(15)] + [(None, edited(rng, u))] * 6
    rows += [(1, None), (2, ""), (3, " "), (4, "q" * 5000)] + [(9, "z" * 3000 + " zz")] * 6 + [(7, "ÀÀÀÀÀÀ ÿÿÿÿÿÿ ×÷×÷×÷")] * 7
    got = [(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
           for r in sg.variants(documents(spark, [(i, "s", "l", 1, t) for i, t in rows]), cell=cell).collect()]
    want = brute_variants(rows)
    same(got, want)
    assert sum(r[3] is not None for r in want) > 30 and any(r[3] and r[5] != r[3] for r in want)


def test_variants_of_nothing(spark):
    assert sg.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert sg.variants(spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")).collect() == []


def test_cell_search_prunes_but_finds_all():
    rng = np.random.default_rng(5)
    points, queries = (rng.integers(0, 3, (n, 12)) for n in (700, 300))
    for up, down in sg.REACH.values():
        got = {(int(a), int(b)) for x, y in sg.search(points, queries, up, down) for a, b in zip(x, y, strict=True)
               if points[b].sum() - queries[a].sum() == up - down}
        diff = points[None] - queries[:, None]
        ok = (np.maximum(diff, 0).sum(axis=2) == up) & (np.maximum(-diff, 0).sum(axis=2) == down)
        assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(ok), strict=True)}
