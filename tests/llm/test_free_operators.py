"""Operators 1, 2, 6, 7, 8, 10 and the pipeline: against brute force, exact round trips, held-out
accuracy, and defined results on edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import cotrain_quality as cq
from tabwright.llm import line_dedup as ld
from tabwright.llm import minhash_dedup as mh
from tabwright.llm import packing as pk
from tabwright.llm import repetition as rp
from tabwright.llm import suffix_dedup as sd
from tabwright.llm import toxicity_mil as tm
from tabwright.llm.common import table
from tabwright.llm.queries import QUERIES, tokenizer_path

SF, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
EDGE = [(None, None), (None, ""), (1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "same text here is short"),
        (5, "same text here is short"), (6, "same text here is short"), (6, "another text under the id"),
        (7, LONG), (8, LONG + " tail"), (9, "é😀 <|endoftext|> \x00\x01 x"), (10, "z" * 5000), (11, "z" * 5000 + "y")]


def edge(spark, rows=EDGE):
    return spark.createDataFrame([(i, t, n, "k", 1) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, node int, comp string, __row int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def jaccard_classes(rows, n=5, threshold=0.8):
    """Brute force over all pairs that share a shingle: list of class numbers."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders, by_text = defaultdict(list), {}
    for i, (_, t) in enumerate(rows):
        if (t or "") in by_text:
            parent[find(i)] = find(by_text[t or ""])
        by_text[t or ""] = i
        shared = Counter(j for g in sets[i] for j in holders[g])
        for j, k in shared.items():
            if k >= threshold * (len(sets[i]) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for g in sets[i]:
            holders[g].append(i)
    return [find(i) for i in range(len(rows))]


def partition(keys, classes):
    out = defaultdict(list)
    for k, c in zip(keys, classes, strict=True):
        out[c].append(str(k))
    return sorted(sorted(v) for v in out.values())


# -- op1 ---------------------------------------------------------------------------------------
def test_dart_signatures_estimate_weighted_jaccard():
    rnd = np.random.default_rng(0)
    a = rnd.integers(0, 2 ** 63, 800).astype(np.uint64)
    wa = rnd.random(800) * 4
    wb = np.where(np.arange(800) < 250, wa * 0.3, wa)
    doc = np.repeat([0, 1], 800)
    s = mh.dart_signatures(doc, np.concatenate([a, a]), np.concatenate([wa, wb]), 2, 3000)
    exact = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((s[0] == s[1]).mean() - exact) < 0.04
    b = np.concatenate([a[:600], rnd.integers(0, 2 ** 63, 100).astype(np.uint64)])
    s = mh.dart_signatures(np.repeat([0, 1], [800, 700]), np.concatenate([a, b]), None, 2, 3000)
    assert abs((s[0] == s[1]).mean() - 600 / 900) < 0.04
    # repeats of an element and the company in the batch change nothing
    alone = mh.dart_signatures(np.zeros(801, dtype=int), np.append(a, a[0]), None, 1, 64)
    assert (alone[0] == mh.dart_signatures(np.repeat([1, 0], 800), np.concatenate([a, a]), None, 2, 64)[1]).all()


def test_near_duplicates_equal_brute_force(spark):
    docs = table(spark, SF_MID, "documents", "doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = mh.near_duplicates(docs).select("doc_id", "class_id").collect()
    assert partition([r[0] for r in got], [r[1] for r in got]) == partition([r[0] for r in rows], jaccard_classes(rows))


@pytest.mark.parametrize("partners,hot_bucket", [(0, 1000), (32, 4)])
def test_large_group_of_different_near_copies(spark, partners, hot_bucket):
    """Copies of one base, each edited elsewhere: the base links them all, most pairs are not links."""
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 150):
        w = list(base)
        for j in rnd.sample(range(200), k % 7):
            w[j] = f"e{k}_{j}"
        rows.append((k, " ".join(w[:200 - k % 11])))
    rows += [(200 + k, " ".join(f"r{k}_{i}" for i in range(60))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = mh.near_duplicates(docs, partners=partners, hot_bucket=hot_bucket).select("doc_id", "class_id").collect()
    assert partition([r[0] for r in got], [r[1] for r in got]) == partition([r[0] for r in rows], jaccard_classes(rows))


def test_near_duplicate_edges(spark):
    docs = edge(spark)
    got = mh.near_duplicates(docs).select("doc_id", "class_id", "class_size").collect()
    assert len(got) == len(EDGE)
    expect = jaccard_classes(EDGE)
    sizes = Counter(expect)
    assert sorted(r["class_size"] for r in got) == sorted(sizes[c] for c in expect)
    kept = mh.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    assert {r["doc_id"] for r in kept.collect()} >= {1, 3, 4, 5, 7, 9, 10, 11}
    assert mh.near_duplicates(empty(spark)).count() == 0 and mh.keep_one(empty(spark)).count() == 0


# -- op2 ---------------------------------------------------------------------------------------
def check_pieces(rows, pieces, window=1024):
    """Round trip: every id of every document once, gapless sequences of the window or a power of two."""
    slow = pk.Encoder(tokenizer_path())
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in rows:
        ids = exact.encode(t or "", add_special_tokens=False).ids + [0]
        assert slow(t or "").tolist() == ids[:-1]
        want[(i, np.array(ids, dtype="<u4").tobytes())] += 1
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at and len(p["ids"]) == 4 * p["length"]
            at += p["length"]
        assert at == s[0]["sequence_length"] and (at == window or at & (at - 1) == 0)
    # rows that share an id: match pieces to texts by start and content
    left = Counter()
    for (i, raw), n in want.items():
        left[(i, len(raw) // 4)] += n * len(raw) // 4
    for i, ps in docs.items():
        for p in ps:
            left[(i, p["doc_tokens"])] -= p["length"]
            assert any(k[0] == i and k[1][4 * p["start"]:4 * (p["start"] + p["length"])] == bytes(p["ids"]) for k in want)
    assert not +left and not -left


def test_packing_round_trip(spark):
    docs = table(spark, SF, "documents", "doc_id", "text")
    for block in (5_000, 16_000_000):
        check_pieces([tuple(r) for r in docs.collect()],
                     pk.pack(docs, tokenizer_path(), block_tokens=block).collect())


def test_packing_edges(spark):
    check_pieces(EDGE, pk.pack(edge(spark), tokenizer_path()).collect())
    assert pk.pack(empty(spark), tokenizer_path()).count() == 0


def test_nnls_uses_the_histogram():
    rnd = np.random.default_rng(1)
    tails = np.concatenate([rnd.integers(1, 1024, 4000), np.full(500, 512), np.full(300, 341), np.full(300, 342)])
    seq, off, n = pk.plan_tails(tails, 1024)
    on = seq >= 0
    assert on.mean() > 0.7
    assert (np.bincount(seq[on], tails[on], minlength=n) == 1024).all()
    combos = pk.combinations(np.unique(tails), 1024)
    assert (combos.sum(1) == 1024).all()
    hist = np.bincount(tails, minlength=1025)
    x = pk.nnls_counts(combos, hist.astype(float))
    assert (x >= 0).all()
    left = hist - sum(np.bincount(combos[:, i], x, minlength=1025) for i in range(3))
    left[0] = 0
    assert (left ** 2).sum() < 0.1 * (hist.astype(float) ** 2).sum()


# -- op6 ---------------------------------------------------------------------------------------
def brute_repetition(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    in3 = {j + k for j in range(len(w) - 2) if c[tuple(w[j:j + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, w))
    dups = []
    for g in rp.DUP_LIMITS:
        c = Counter(tuple(w[j:j + g]) for j in range(len(w) - g + 1))
        inside = {j + k for j in range(len(w) - g + 1) if c[tuple(w[j:j + g])] > 1 for k in range(g)}
        dups.append(round(sum(len(w[j]) for j in inside) / max(chars, 1), 9))
    return (len(w), chars, len(re.findall(r"[#*$%&|<>]", t)), dup, len(in3),
            len(w) < 50 or 100 * len(in3) > 50 * len(w), dups)


def test_repetition_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents", "doc_id", "text").collect()]
    rows += [x for x in EDGE if x[0] != 8] + [(900, "a\x85b  c\x1cd\x0be\n \na\x85b"), (901, "one two three\n" * 40)]
    got = rp.repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: str(r)
    a = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                 r["base_failed"], [round(x, 9) for x in r["dup_shares"]]) for r in got), key=key)
    b = sorted(((i, *brute_repetition(t)) for i, t in rows), key=key)
    assert a == b
    assert not any(r["kept"] for r in got if r["base_failed"]) and rp.repetition(empty(spark)).count() == 0


def test_a_fifth_in_repeated_passages_is_not_kept(spark):
    passage = " ".join(f"p{i:03d}" for i in range(12))
    fill = [" ".join(f"{c}{i:03d}" for i in range(n)) for c, n in (("a", 48), ("b", 48))]
    rows = [(1, f"{passage} {fill[0]} {passage} {fill[1]}"), (2, " ".join(fill)), (3, " ".join([passage, *fill]))]
    got = {r["doc_id"]: r for r in rp.repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(math.isclose(x, 0.2) for x in got[1]["dup_shares"])
    assert [got[i]["kept"] for i in (1, 2, 3)] == [False, True, True] and not got[1]["base_failed"]


# -- op7 ---------------------------------------------------------------------------------------
def brute_repeats(texts, n):
    c = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        cov = np.zeros(len(t) + 2, dtype=int)
        for i in range(len(t) - n + 1):
            if c[t[i:i + n]] > 1:
                cov[i + 1:i + n + 1] = 1
        kept = bytes(np.frombuffer(t, np.uint8)[cov[1:-1] == 0])
        out.append((len(t), kept, int((np.diff(cov) == 1).sum())))
    return out


def test_difference_cover_meets_every_pair():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))
    d = sd.offset_table()
    for a in range(sd.PERIOD):
        for b in range(sd.PERIOD):
            assert (a + d[a, b]) % sd.PERIOD in sd.COVER and (b + d[a, b]) % sd.PERIOD in sd.COVER


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh", bytes(range(256))])
def test_block_suffix_sort(alphabet):
    rnd = random.Random(len(alphabet))
    for _ in range(8):
        base = bytes(rnd.choice(alphabet) for _ in range(700))
        parts = set()
        for _ in range(14):
            s = bytearray(base)
            for _ in range(rnd.randint(0, 3)):
                s[rnd.randrange(700)] = rnd.choice(alphabet)
            a = rnd.randrange(0, 350)
            parts.add(bytes(s[a:a + rnd.randint(200, 340)]))
        parts, text, starts = sorted(parts), b"", []
        for x in parts:
            starts += range(len(text), len(text) + len(x) - 199)
            text += x
        c = Counter(text[s:s + 200] for s in starts)
        got = sd.repeated_suffixes(np.frombuffer(text, np.uint8), np.array(starts), 200)
        assert got.tolist() == [c[text[s:s + 200]] > 1 for s in starts]


@pytest.mark.parametrize("hot_anchor", [2, 10_000])
def test_suffix_dedup_equals_brute_force(spark, hot_anchor):
    rows = [tuple(r) for r in table(spark, SF, "documents", "doc_id", "text").collect()]
    cut = [t for _, t in rows if len(t) > 900]
    rows += [(500 + i, f"fresh {i} " * 40 + t[100:100 + n]) for i, (t, n) in
             enumerate(zip(cut, (198, 199, 200, 201, 260, 333, 399, 400, 500), strict=False))]
    rows += [x for x in EDGE if x[0] not in (7, 8)]
    texts = [(t or "").encode() for _, t in rows]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot_anchor=hot_anchor).collect()
    a = Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in got)
    b = Counter((i, *x) for (i, _), x in zip(rows, brute_repeats(texts, 200), strict=True))
    assert a == b and sum(x[1] - len(x[2]) for x in b) > 0
    assert sd.remove_repeats(empty(spark)).count() == 0


def hot_passage(n):
    """One passage of 1,500 bytes in n texts that differ around it."""
    rnd = random.Random(8)
    word = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    passage = word(1500)
    return [(i, f"{word(260)}{passage if i % 10 else passage[:700]}{word(260)}") for i in range(n)]


@pytest.mark.parametrize("n", [60, 240])
def test_hot_passages_equal_brute_force(spark, monkeypatch, n):
    """Digests settled inside a flush, single ones of several flushes, and both mixed."""
    rows = hot_passage(n)
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_repeats([t.encode() for _, t in rows], 200), strict=True))
    for flush in (sd.FLUSH_BYTES, 300_000):
        monkeypatch.setattr(sd, "FLUSH_BYTES", flush)
        got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), hot_anchor=10).collect()
        assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in got) == want


def test_a_hot_passage_adds_no_entries_to_a_bucket(spark, monkeypatch):
    """Neither the entries that a flush sends for a shared passage nor the rows that come back per text grow with the texts."""
    monkeypatch.setattr(sd, "FLUSH_BYTES", 1 << 40)
    most, returned = [], []
    for n in (100, 800):
        d = spark.createDataFrame(hot_passage(n), "doc_id long, text string").coalesce(1)
        rows = sd.prepared(d, 200, "doc_id", "text")
        every = rows.withColumn("chosen", F.expr("transform(hs, (h, i) -> struct(i as idx, true as hot))"))
        blobs = sd.contexts(every, 1, 200).cache()
        shared = [np.frombuffer(r["rid"], dtype=np.int64) for r in blobs.where("rid is not null").collect()]
        most.append(sum((x == -1).sum() for x in shared))
        settled = [np.frombuffer(r["settled"], dtype=np.int64).reshape(-1, 3) for r in blobs.where("settled is not null").collect()]
        returned.append(sum(map(len, settled)) / n)
    assert 0 < most[1] < 2 * most[0] and returned[1] <= returned[0] + 0.1 <= 2


def test_long_text_in_segments(monkeypatch):
    rnd = random.Random(3)
    piece = bytes(rnd.randrange(97, 123) for _ in range(3000))
    text = piece + bytes(rnd.randrange(97, 123) for _ in range(9000)) + piece[500:1500]
    whole = sd.anchored([text], 200)[0]
    monkeypatch.setattr(sd, "CHUNK", 1000)
    monkeypatch.setattr(sd, "SEGMENT", 4096)
    h, m = sd.anchored([text], 200)[0]
    assert sum(m) == sum(whole[1]) == len(text) - 199
    assert set(h.tolist()) == set(whole[0].tolist())


# -- op8 ---------------------------------------------------------------------------------------
def auc(s, y):
    order = np.argsort(np.argsort(s)) + 1
    p = int(y.sum())
    return (order[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text"), \
        table(spark, "/root/testdata/sf0.1", "labels", "doc_id", "toxic")
    model = tm.fit(docs, labels)
    out = tm.score(docs, model).withColumn("held", tm.held_out(F.col("doc_id"))).join(labels, "doc_id").toPandas()
    for i, h in zip(out["doc_id"], out["held"], strict=True):
        assert h == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = out[out["held"]]
    assert auc(held["score"].to_numpy(), held["toxic"].to_numpy()) > 0.9
    assert ((held["score"] >= 0.5) == (held["toxic"] == 1)).mean() > 0.95
    assert held["score"].between(0, 1).all()
    clean = held[held["toxic"] == 0]
    assert (clean["score"] >= 0.5).mean() < 0.02


def test_noisy_or_locates_the_sentence(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows, labs = [], []
    for i in range(600):
        s = [" ".join(rnd.choice(words) for _ in range(8)) for _ in range(5)]
        if i % 4 == 0:
            s[i % 5] += " vile"
        rows.append((i, ". ".join(s) + "."))
        labs.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labs + [(7, None), (8, 1)], "doc_id long, toxic int")
    model = tm.fit(docs, labels)
    for r in tm.score(docs.where("doc_id % 4 = 0 AND doc_id > 8"), model).collect():
        text = rows[r["doc_id"]][1]
        assert r["score"] > 0.5
        assert ["vile" in text[x["start"]:x["end"]] for x in r["offending"]] == [True]


def test_toxicity_edges(spark):
    docs, none = edge(spark), spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in tm.score(docs, tm.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(4, 1), (7, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in tm.score(docs, tm.fit(docs, one)).collect()} == {0.0}
    scored = tm.score(docs, tm.Model({"same": 9.0}, -4.0)).collect()
    assert len(scored) == len(EDGE)
    assert sorted(r["score"] for r in scored)[:5] == [0.0] * 5
    assert tm.score(empty(spark), tm.Model({"a": 1.0}, 0.0)).count() == 0


# -- op10 --------------------------------------------------------------------------------------
def test_cotraining_keeps_clean_documents(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels", "doc_id", "quality")
    out = cq.co_train(docs, labels).join(labels, "doc_id").toPandas()
    held = out[[zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"]]]
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.97
    assert held[held["quality"] == 1]["kept"].mean() > 0.97
    assert (~held[held["quality"] == 0]["kept"]).mean() > 0.8


def test_cotraining_uses_unlabelled_documents(spark):
    """Few labels: the views' pseudo-labels are used (weights above 0) and do not spoil the result."""
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels", "doc_id", "quality")
    few = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    a = cq.co_train(docs, few, rounds=0).join(labels, "doc_id").toPandas()
    b = cq.co_train(docs, few, rounds=2).join(labels, "doc_id").toPandas()
    y = b["quality"].to_numpy()
    assert auc(b["score"].to_numpy(), y) >= auc(a["score"].to_numpy(), a["quality"].to_numpy()) - 0.01


def test_cotraining_edges(spark):
    docs = (edge(spark).withColumn("lang", F.lit(None).cast("string"))
            .withColumn("source", F.when(F.col("doc_id") > 5, "s")).withColumn("n_chars", F.lit(None).cast("long")))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] for r in cq.co_train(docs, none).collect())
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = cq.co_train(docs, labels).collect()
    assert len(out) == len(EDGE) and all(0 <= r["score"] <= 1 for r in out)
    kept = cq.good_documents(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(EDGE)
    assert cq.co_train(empty(spark), labels).count() == 0


# -- pipeline ----------------------------------------------------------------------------------
def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = table(spark, SF_MID, "documents")
    columns, rows = docs.columns, None
    for name, stage in cp.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, SF_MID).cache()
        if name == "packing":
            check_pieces_digest(before, docs.collect())
            break
        assert docs.columns == columns
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality":
            scores = {r["doc_id"]: r["kept"] for r in QUERIES["op10_cotrain_quality"](spark, SF_MID).collect()}
            assert set(rows) == {i for i, k in scores.items() if k}
        elif name == "line_dedup":
            seen = defaultdict(set)
            low = lambda x: re.sub("[A-Z]", lambda m: m.group().lower(), x.strip(ld.BLANK))
            for i, t in before:
                for x in t.split("\n"):
                    seen[low(x)].add(i)
            assert rows == {i: "\n".join(x for x in t.split("\n") if not low(x) or len(seen[low(x)]) < 10)
                            for i, t in before}
        elif name == "near_duplicates":
            groups = partition([i for i, _ in before], jaccard_classes(before))
            assert set(rows) == {min(map(int, g)) for g in groups}
        else:
            words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
            tok = lambda t: words.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t))
            bench = [tok(r["text"]) for r in table(spark, SF_MID, "benchmark").collect()]
            grams = {tuple(w[i:i + 10]) for w in bench for i in range(max(len(w) - 9, 1)) if w}
            hit = lambda t: any(tuple(t[i:i + k]) in grams for k in {len(g) for g in grams}
                                for i in range(len(t) - k + 1))
            assert set(rows) == {i for i, t in before if not hit(tok(t))}


def check_pieces_digest(rows, pieces):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array(exact.encode(t, add_special_tokens=False).ids + [0], dtype="<u4") for i, t in rows}
    total = Counter()
    for p in pieces:
        x = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert zlib.crc32(x.tobytes()) == p["ids_crc32"] and len(ids[p["doc_id"]]) == p["doc_tokens"]
        total[p["doc_id"]] += p["length"]
    assert total == Counter({i: len(x) for i, x in ids.items()})


def test_registered_queries_digest(spark):
    """The thin queries' digests follow from the operators' outputs."""
    rows = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op7_suffix_dedup"](spark, SF).collect()}
    for (i, t), (n, kept, spans) in zip(rows.items(), brute_repeats([t.encode() for t in rows.values()], 200), strict=True):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (
            n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())
    assert QUERIES["op1_dart_minhash"](spark, SF).columns == ["doc_id", "class_id", "class_size"]
