"""Exact substring dedup: bytes covered by a string of ``length`` bytes that also starts elsewhere.

Suffixes are sorted blockwise, one suffix bucket at a time, with a difference cover.

1. Buckets.  The first ``length`` bytes of a suffix pick its anchor: the leftmost of the smallest
   hashes of all ``GRAM``-byte strings in them.  Equal strings pick equal anchors, and neighbouring
   suffixes mostly share theirs, so a document falls into runs of suffixes ("contexts": the bytes
   that the run's suffixes need) per anchor.  Anchors that occur once in the whole corpus cannot
   hold a repeat; a count drops them, and only the other contexts are sent to their bucket.
2. Sorting a bucket.  Equal contexts collapse.  In the text of the remaining ones the positions
   p with p mod 32 in a difference cover are the sample; the ranks of their 160-byte strings
   are computed first, by doubling.  The bucket's suffixes are then sorted by their first 32 bytes,
   and ties are resolved by comparing sample ranks at the one offset (below 32) where both
   suffixes meet the sample: a three-way quicksort over all tie groups at once, never looking at
   more bytes.  The last bytes up to ``length`` settle what is still equal.  Neighbours that agree
   in all ``length`` bytes are repeats.
3. A run's repeats cover one stretch of its document; the stretches return to their documents.

Memory: a bucket is about BUCKET_BYTES of contexts and is sorted BLOCK_BYTES at a time.  An anchor
with more than ``hot_anchor`` occurrences would make its bucket grow with the corpus; its suffixes
become 128-bit digests, spread by digest.  A task settles digests that it holds twice itself (their
places are merged to stretches there) and sends each digest to its bucket once a flush, so a passage that
a third of all texts share adds one digest per FLUSH_BYTES of them to a bucket, not one per text.
Of equal texts one takes part; all of them are then repeats as a whole.

Edge cases: null and empty texts have no bytes; texts shorter than ``length`` lose nothing; null ids,
repeated ids and repeated rows are separate documents (a repeated row of ``length`` bytes or more
is a copy and goes); an empty table gives an empty result; other columns are never touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut, hash_pair
from tabwright.llm.minhash_dedup import M3, mix

GRAM = 32
PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 19)  # every difference modulo 32 occurs between two members
SEGMENT = 1 << 21
CHUNK = 1 << 19
BLOCK_BYTES = 1_000_000
BUCKET_BYTES = 4_000_000
FLUSH_BYTES = 16_000_000
DIGEST = 16
LOW = np.uint64((1 << 24) - 1)


# -- anchors -----------------------------------------------------------------------------------
def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * M3
    n, mult = 1, 0x9E3779B97F4A7C15
    while n < GRAM:
        mult = (mult * 0xD1342543DE82EF95 + 2) & 0xFFFFFFFFFFFFFFFF | 1
        h = h[:-n] * np.uint64(mult) + h[n:]
        n *= 2
    return mix(h)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return np.minimum(v[:len(v) - (width - n)], v[width - n:])


def runs(b: np.ndarray, ok: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of suffixes with one anchor, over the starts allowed by ``ok``: start, number, anchor hash.
    At most 2^24 bytes, so that a hash's high bits and its position fit one word."""
    h = gram_hashes(b)
    v = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    low = sliding_min(v, length - GRAM + 1)
    at = np.flatnonzero(ok[:len(low)])
    if not len(at):
        return at, at, np.zeros(0, dtype=np.int64)
    m = low[at]
    first = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (at[1:] != at[:-1] + 1)]))
    return at[first], np.diff(np.append(first, len(at))), h[(m[first] & LOW).astype(np.int64)].view(np.int64)


def anchored(texts: list[bytes], length: int) -> list[tuple[np.ndarray, bytes]]:
    """Per text the anchor hashes of its runs and their numbers of suffixes (one byte each); the
    runs follow each other without gaps from position 0."""
    out: list = [(np.zeros(0, dtype=np.int64), b"")] * len(texts)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        if size > SEGMENT:  # one long text: overlapping segments, whose runs simply follow each other
            b, hs, ms = np.frombuffer(texts[i], dtype=np.uint8), [], []
            for a in range(0, len(b) - length + 1, SEGMENT - length + 1):
                part = b[a:a + SEGMENT]
                ok = np.ones(len(part) - length + 1, dtype=bool)
                _, m, h = runs(part, ok, length)
                hs.append(h)
                ms.append(m)
            out[i] = (np.concatenate(hs), np.concatenate(ms).astype(np.uint8).tobytes())
        elif size >= length:
            b = np.frombuffer(b"".join(texts[i:j]), dtype=np.uint8)
            sizes = np.array([len(t) for t in texts[i:j]], dtype=np.int64)
            ends = np.cumsum(sizes)
            ok = np.zeros(size, dtype=bool)
            for e, n in zip(ends, sizes, strict=True):
                ok[e - n:max(e - length + 1, e - n)] = True
            start, m, h = runs(b, ok, length)
            cuts = np.searchsorted(start, ends)
            for k, (x, y) in enumerate(zip(np.append(0, cuts[:-1]), cuts, strict=True)):
                out[i + k] = (h[x:y], m[x:y].astype(np.uint8).tobytes())
        i = j
    return out


# -- suffix sorting ----------------------------------------------------------------------------
def offset_table() -> np.ndarray:
    """[a, b]: the least d below PERIOD with a + d and b + d both in the cover."""
    inside = np.zeros(PERIOD, dtype=bool)
    inside[list(COVER)] = True
    a, b, d = np.meshgrid(*[np.arange(PERIOD)] * 3, indexing="ij")
    return np.argmax(inside[(a + d) % PERIOD] & inside[(b + d) % PERIOD], axis=2)


def dense_ranks(keys: list[np.ndarray]) -> np.ndarray:
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def cover_ranks(words: np.ndarray, n: int, reach: int) -> np.ndarray:
    """Ranks of the ``reach``-byte strings at the sample positions (others: -1); ``reach`` is 32 times
    a whole number.  ``words``: the 8 bytes at every position as a big-endian number."""
    p = np.arange(n, dtype=np.int64)
    p = p[np.isin(p % PERIOD, COVER)]
    p = p[p + PERIOD <= n]
    rank = np.full(n, -1, dtype=np.int64)
    rank[p] = dense_ranks([words[p + o] for o in range(0, PERIOD, 8)])
    base, have = rank.copy(), PERIOD
    while have < reach:
        more = min(have, reach - have) // PERIOD * PERIOD
        more = have if more == have else PERIOD
        p = p[p + have + more <= n]
        second = rank if more == have else base
        merged = dense_ranks([rank[p], second[p + have]])
        rank = np.full(n, -1, dtype=np.int64)
        rank[p] = merged
        have += more
    return rank


def repeated_suffixes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes share their first ``length`` bytes with another of the given starts."""
    n = len(text)
    w = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    for s in (1, 2, 4):
        w = (w[:-s] << np.uint64(8 * s)) | w[s:]
    reach = (length - PERIOD + 1) // PERIOD * PERIOD
    rank = cover_ranks(w, n, reach)
    meet = offset_table()
    # suffix array by the first PERIOD bytes
    head = dense_ranks([w[starts + o] for o in range(0, PERIOD, 8)])
    size = np.bincount(head)
    place = (np.cumsum(size) - size)[head]
    live = np.flatnonzero(size[head] > 1)
    if not len(live):
        return np.zeros(len(starts), dtype=bool)
    # ranks of the bytes from the cover's least reach to ``length`` (the last word ends there)
    at = [*range(reach, length - 7, 8), *([length - 8] if (length - reach) % 8 else [])]
    tail = np.zeros(len(starts), dtype=np.int64)
    tail[live] = dense_ranks([w[starts[live] + o] for o in at])
    group = head
    while len(live):
        # a pivot for every tie group, every member against it at the offset where both are sampled
        _, g, count = np.unique(group[live], return_inverse=True, return_counts=True)
        order = np.argsort(g, kind="stable")
        middle = live[order[np.cumsum(count) - count + count // 2]]
        pivot, mine = starts[middle][g], starts[live]
        d = meet[mine % PERIOD, pivot % PERIOD]
        cmp = np.sign(rank[mine + d] - rank[pivot + d])
        cmp = np.where(cmp == 0, np.sign(tail[live] - tail[middle][g]), cmp)
        less = np.bincount(g, cmp < 0).astype(np.int64)
        same = np.bincount(g, cmp == 0).astype(np.int64)
        place[live] += np.where(cmp < 0, 0, np.where(cmp == 0, less[g], (less + same)[g]))
        # members equal to the pivot are in place; the two sides go on where more than one is left
        side = np.where(cmp < 0, less[g], (count - less - same)[g])
        stay = (cmp != 0) & (side > 1)
        group = group.copy()
        group[live] = 2 * g + (cmp > 0)
        live = live[stay]
    # suffixes that share a place in the array agree in all ``length`` bytes
    return np.bincount(place, minlength=len(starts))[place] > 1


def bucket_stretches(body: list[bytes], anchor: np.ndarray, ctx: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per location (``ctx`` indexes ``body``) the repeated stretch of its context, (0, 0) if none."""
    index: dict[bytes, int] = {}
    same = np.array([index.setdefault(x, len(index)) for x in body], dtype=np.int64)
    ctx = same[ctx]
    first = np.full(len(index), -1, dtype=np.int64)
    first[same[::-1]] = np.arange(len(body))[::-1]
    texts = list(index)
    anchor = anchor[first]
    copies = np.bincount(ctx, minlength=len(texts))
    size = np.array([length if len(x) == DIGEST else len(x) for x in texts], dtype=np.int64)
    lo, hi = np.zeros(len(texts), dtype=np.int64), np.where(copies > 1, size, 0)
    order = np.argsort(anchor, kind="stable")
    whole = np.array([len(x) != DIGEST for x in texts], dtype=bool)
    order = order[whole[order]]
    _, inv, n = np.unique(anchor[order], return_inverse=True, return_counts=True)
    # an anchor all of whose contexts are equal is settled by the count of copies
    order = order[(n[inv] > 1)]
    a = 0
    while a < len(order):
        b, total = a, 0
        while b < len(order) and (total < BLOCK_BYTES or anchor[order[b]] == anchor[order[b - 1]]):
            total += size[order[b]]
            b += 1
        part = order[a:b]
        text = np.frombuffer(b"".join(texts[i] for i in part), dtype=np.uint8)
        begin = np.cumsum(size[part]) - size[part]
        n_suf = size[part] - length + 1
        owner = np.repeat(np.arange(len(part)), n_suf)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(n_suf) - n_suf, n_suf)
        hit = repeated_suffixes(text, begin[owner] + inner, length)
        o, x = owner[hit], inner[hit]
        left, right = np.full(len(part), 1 << 40), np.full(len(part), -1)
        np.minimum.at(left, o, x)
        np.maximum.at(right, o, x)
        got = (right >= 0) & (copies[part] == 1)
        lo[part[got]], hi[part[got]] = left[got], right[got] + length
        a = b
    return lo[ctx], hi[ctx]


# -- Spark jobs --------------------------------------------------------------------------------
def prepared(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: ``rid``, ``doc_id``, text hash, ``n_bytes``, compressed text, the runs."""
    a, b = hash_pair("text")
    d = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
         .select(F.monotonically_increasing_id().alias("rid"), "doc_id", a.alias("t1"), b.alias("t2"), "text"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=5)
        for x in batches:
            raw = [t.encode("utf-8") for t in x.column(4).to_pylist()]
            found = anchored(raw, length)
            yield pa.RecordBatch.from_arrays(
                [*x.columns[:4], pa.array([len(t) for t in raw], pa.int64()),
                 pa.array([pack.compress(t) for t in raw], pa.binary()),
                 pa.array([h for h, _ in found], pa.list_(pa.int64())), pa.array([m for _, m in found], pa.binary())],
                names=["rid", "doc_id", "t1", "t2", "n_bytes", "z", "hs", "ms"])

    return d.mapInArrow(run, f"rid long, doc_id {id_type}, t1 long, t2 long, n_bytes long, z binary, "
                             "hs array<long>, ms binary")


def contexts(rows: DataFrame, n_buckets: int, length: int) -> DataFrame:
    """Contexts of the chosen runs, packed per bucket; equal ones of a flush are packed once.  Digests of hot
    anchors' suffixes go with their place if the flush holds one, else with none (``rid`` -1): the places of
    these are ``settled`` stretches (rid, begin, end), which pass through a bucket as they are."""
    cols = "bucket long, body binary, size binary, anchor binary, ctx binary, rid binary, start binary, settled binary"
    names = [c.split()[0] for c in cols.split(", ")]

    def run(batches):
        import zstandard
        pack, unpack = zstandard.ZstdCompressor(level=5), zstandard.ZstdDecompressor()
        bins: dict[int, tuple[dict, list, list, list, list]] = {}
        hot: dict[bytes, list[tuple[int, int]]] = {}
        held = 0

        def flush():
            places = []
            for digest, at in hot.items():
                rid, s1 = at[0] if len(at) == 1 else (-1, 0)
                add(int.from_bytes(digest[:8], "little"), digest, int.from_bytes(digest[8:], "little", signed=True), rid, s1)
                if len(at) > 1:
                    places += at
            settled: dict[int, list] = {}
            for rid, s1 in sorted(places):
                mine = settled.setdefault(rid % n_buckets, [])
                if mine and mine[-1][0] == rid and s1 <= mine[-1][2]:
                    mine[-1][2] = s1 + length
                else:
                    mine.append([rid, s1, s1 + length])
            for k, v in settled.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), *(pa.array([None], pa.binary()) for _ in range(6)),
                     pa.array([np.array(v, dtype=np.int64).tobytes()], pa.binary())], names=names)
            for k, (index, anchor, ctx, rid, start) in bins.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([k], pa.int64()), pa.array([pack.compress(b"".join(index))], pa.binary()),
                    *(pa.array([np.array(v, dtype=t).tobytes()], pa.binary()) for v, t in (
                        ([len(x) for x in index], np.int32), (anchor, np.int64), (ctx, np.int32),
                        (rid, np.int64), (start, np.int64))), pa.array([None], pa.binary())], names=names)

        def add(key: int, content: bytes, anchor: int, rid: int, start: int) -> int:
            index, anchors, ctx, rids, starts = bins.setdefault(key % n_buckets, ({}, [], [], [], []))
            i = index.setdefault(content, len(index))
            if i == len(anchors):
                anchors.append(anchor)
            ctx.append(i)
            rids.append(rid)
            starts.append(start)
            return len(content) + 160  # with the lists' own objects

        for b in batches:
            for rid, z, hs, ms, chosen in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                text = unpack.decompress(z)
                m = np.frombuffer(ms, dtype=np.uint8).astype(np.int64)
                at = np.cumsum(m) - m
                for x in chosen:
                    i = x["idx"]
                    s, n = int(at[i]), int(m[i])
                    if x["hot"]:
                        for s1 in range(s, s + n):
                            digest = hashlib.blake2b(text[s1:s1 + length], digest_size=DIGEST).digest()
                            hot.setdefault(digest, []).append((rid, s1))
                            held += 400
                    else:
                        held += add(hs[i] >> 1, text[s:s + n + length - 1], hs[i], rid, s)
                if held >= FLUSH_BYTES:
                    yield from flush()
                    bins.clear()
                    hot.clear()
                    held = 0
        yield from flush()

    return rows.select("rid", "z", "hs", "ms", "chosen").mapInArrow(run, cols)


def stretches(blobs: DataFrame, length: int) -> DataFrame:
    """``rid, begin, end`` of the repeated stretches, bucket by bucket."""
    def run(table: pa.Table) -> pa.Table:
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        body, anchor, ctx, rid, start = ([np.zeros(0, dtype=np.int64)] * (k > 0) for k in range(5))
        done = [np.zeros((0, 3), dtype=np.int64)]
        for r in table.to_pylist():
            if r["settled"] is not None:
                done.append(np.frombuffer(r["settled"], dtype=np.int64).reshape(-1, 3))
                continue
            raw, at = unpack.decompress(r["body"]), 0
            ctx.append(np.frombuffer(r["ctx"], dtype=np.int32).astype(np.int64) + len(body))
            for n in np.frombuffer(r["size"], dtype=np.int32).tolist():
                body.append(raw[at:at + n])
                at += n
            anchor.append(np.frombuffer(r["anchor"], dtype=np.int64))
            rid.append(np.frombuffer(r["rid"], dtype=np.int64))
            start.append(np.frombuffer(r["start"], dtype=np.int64))
        lo, hi = bucket_stretches(body, np.concatenate(anchor), np.concatenate(ctx), length)
        rid, s, done = np.concatenate(rid), np.concatenate(start), np.concatenate(done)
        on = (hi > 0) & (rid >= 0)
        return pa.table({"rid": np.append(rid[on], done[:, 0]), "begin": np.append((s + lo)[on], done[:, 1]),
                         "end": np.append((s + hi)[on], done[:, 2])})

    return blobs.groupBy("bucket").applyInArrow(run, "rid long, begin long, end long")


def remove_repeats(docs: DataFrame, length: int = 200, hot_anchor: int = 10_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: ``doc_id, n_bytes, spans`` (removed byte ranges, maximal, in order) and ``kept``
    (the other bytes)."""
    if length < 2 * PERIOD + GRAM or length > 255 + GRAM:
        raise ValueError("length must lie between 96 and 287 bytes")
    rows = cut(prepared(docs, length, id_col, text_col))
    texts = cut(rows.groupBy("t1", "t2").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies")))
    occ = (rows.select("rid", "hs").join(texts.select("rid"), "rid")
           .select("rid", F.posexplode("hs").alias("idx", "h")))
    busy = cut(occ.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    chosen = (occ.join(busy, "h").groupBy("rid")
              .agg(F.collect_list(F.struct("idx", (F.col("n") > hot_anchor).alias("hot"))).alias("chosen")))
    n_busy = busy.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(64, n_busy * (length + 85) // BUCKET_BYTES)
    blobs = contexts(rows.select("rid", "z", "hs", "ms").join(chosen, "rid"), n_buckets, length)
    # every row of a text that has copies is a repeat from end to end
    copied = (rows.where(F.col("n_bytes") >= length).select("rid", "t1", "t2", "n_bytes")
              .join(texts.where(F.col("copies") > 1).select("t1", "t2"), ["t1", "t2"])
              .select("rid", F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    spans = (stretches(blobs, length).unionByName(copied).groupBy("rid")
             .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("found")))
    full = rows.select("rid", "doc_id", "n_bytes", "z").join(spans, "rid", "left")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            spans, kept = [], []
            for z, found in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for x in found or ():
                    if merged and x["begin"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x["end"])
                    else:
                        merged.append([x["begin"], x["end"]])
                text, at, out = unpack.decompress(z), 0, []
                for s, e in merged:
                    out.append(text[at:s])
                    at = e
                spans.append([{"begin": s, "end": e} for s, e in merged])
                kept.append(b"".join(out) + text[at:])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return full.select("doc_id", "n_bytes", "z", "found").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
