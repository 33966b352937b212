"""Word-level substring dedup by difference-cover anchors.

A word goes when it lies in a window of ``window`` words whose word sequence also starts in a
document with a smaller id.  Windows are judged on the input, not on what is left.

1. Anchors.  ``cover`` is a difference cover modulo ``period``: for any two positions some shift
   below the period brings both onto the cover.  Short windows of ``window - period + 1`` words are
   hashed at cover positions only, so two equal windows share an anchor that sits at the same
   offset in both (window 13: period 7, cover 0, 1, 3, anchors of 7 words).
2. Documents are written in chunks of a few MB.  A chunk sends every different anchor once, as a
   40-bit code packed per bucket; a bucket answers each chunk with the codes that other chunks hold too.
   A code only nominates; equal codes of different anchors cost a check, never a result.
3. Extension.  Around nominated anchors a chunk takes all windows that hold one, in 128-bit hashes of
   their words.  Equal windows of a chunk are settled inside it; those of its smallest document
   go to the hash's bucket, where the smallest document of all chunks decides.
4. Covered positions return to their chunks, and the chunk's documents lose these words.

Skew: a chunk sends an anchor once however often it holds it, and windows of one of its documents
only, so the anchors and windows of a passage that a third of all documents share reach their
bucket once a chunk.  No pairs are built.  Memory: a chunk is CHUNK_BYTES of text (or one longer
text), a bucket about BUCKET_BYTES of codes.  Nothing reaches the driver but
one count of words.

Edge cases: null and empty texts have no words; texts of fewer words than a window lose nothing;
ids are integers; rows of one id are one document to each other (no removal between them), a null
id counts as larger than every other; repeated rows give repeated result rows; an empty table gives
an empty result; other columns are never touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import written
from tabwright.llm.minhash_dedup import mix

CHUNK_BYTES = 8_000_000
HASH_BYTES = 1_000_000      # bytes hashed at once inside a task
BUCKET_BYTES = 8_000_000
CODE_BITS = 40
NO_ID = np.iinfo(np.int64).max
U = np.uint64
STEPS = (U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95))  # odd factors of the two window hashes
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


# -- hashes ------------------------------------------------------------------------------------
def difference_cover(period: int) -> list[int]:
    """Residues whose differences modulo ``period`` are all residues; grown by the one that adds most."""
    cover = [0]
    while True:
        missing = set(range(period)) - {(a - b) % period for a in cover for b in cover}
        if not missing:
            return sorted(cover)
        gain = lambda x: len(missing & {d for a in cover for d in ((a - x) % period, (x - a) % period)})
        cover.append(max(range(1, period), key=lambda x: (gain(x), -x)))


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Two random words for every (place in the word modulo 64, byte)."""
    at = np.arange(64 * 256, dtype=U)
    return mix(at + U(1)), mix(at + U(1 << 40))


def word_hashes(b: np.ndarray, tables, seeds: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words of a byte block (``seeds`` of them), and the words' first bytes."""
    blank = BLANK[b]
    start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(start):
        return [np.zeros(0, dtype=U)] * seeds, start
    at = np.arange(len(b)) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [len(b)]])))
    key = (at & 63) << 8 | b
    late = np.flatnonzero((at > 63) & ~blank)
    out = []
    for t in tables[:seeds]:
        r = t[key]
        r[blank] = 0
        if len(late):  # long words: places 64 further on count with another odd factor
            r[late] *= mix((at[late] >> 6).astype(U)) | U(1)
        out.append(mix(np.add.reduceat(r, start)))
    return out, start


def text_words(texts: list[bytes], seeds: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Word hashes of all texts one after the other, and every text's number of words."""
    tables, parts, n, i = byte_tables(), [[] for _ in range(seeds)], np.zeros(len(texts), dtype=np.int64), 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < HASH_BYTES):
            size += len(texts[j]) + 1
            j += 1
        whole = b" ".join(texts[i:j])
        begun = 0
        while begun < len(whole):
            end = min(begun + HASH_BYTES, len(whole))
            while end < len(whole) and whole[end] not in b" \t\n\v\f\r":  # a word is never cut
                end += 1
            h, start = word_hashes(np.frombuffer(whole, dtype=np.uint8)[begun:end], tables, seeds)
            for p, x in zip(parts, h, strict=True):
                p.append(x)
            ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
            n[i:j] += np.bincount(np.searchsorted(ends, start + begun, side="right"), minlength=j - i)
            begun = end
        i = j
    return [np.concatenate(p) if p else np.zeros(0, dtype=U) for p in parts], n


def windows(h: np.ndarray, width: int, step: np.uint64) -> np.ndarray:
    """Hash of the ``width`` words from every position on."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = h[:n].copy()
    for k in range(1, width):
        out *= step
        out += h[k:k + n]
    return mix(out)


def cover_anchors(h: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the concatenated words) and hashes of the anchors at the cover of every text."""
    period = (window + 1) // 2
    width = window - period + 1
    a = windows(h, width, STEPS[0])
    ends = np.cumsum(n)
    inner = np.arange(len(h)) - np.repeat(ends - n, n)
    left = np.repeat(ends, n) - np.arange(len(h))
    p = np.flatnonzero(np.isin(inner % period, difference_cover(period)) & (left >= width))
    return p, a[p]


def bucket_code(a: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket and code of an anchor in one word."""
    return ((a >> U(CODE_BITS)) % U(n_buckets)) << U(CODE_BITS) | a & U((1 << CODE_BITS) - 1)


def pack_codes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BITS // 8]).tobytes()


def unpack_codes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) * 8 // CODE_BITS, 8), dtype=np.uint8)
    out[:, :CODE_BITS // 8] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, CODE_BITS // 8)
    return out.view("<u8").ravel()


def groups_of(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order by the keys, and in that order the number of the group of equal keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def smallest_in_group(keys: list[np.ndarray], value: np.ndarray) -> np.ndarray:
    if not len(value):
        return value
    order, g = groups_of(keys)
    least = np.full(g[-1] + 1, NO_ID, dtype=np.int64)
    np.minimum.at(least, g, value[order])
    out = np.empty(len(value), dtype=np.int64)
    out[order] = least[g]
    return out


def deltas(pos: np.ndarray) -> np.ndarray:
    return np.diff(pos, prepend=0).astype(np.int32)


def positions(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, dtype=np.int32).astype(np.int64))


# -- Spark jobs --------------------------------------------------------------------------------
def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Chunks of documents: ``chunk`` (its first row number), ids, compressed texts, sizes, words."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=6)

        def block(rid, ids, texts):
            n = text_words(texts, 1)[1]
            return pa.RecordBatch.from_arrays(
                [pa.array([rid[0]], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([pack.compress(b"".join(texts))], pa.binary()),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([int(n.sum())], pa.int64())],
                names=["chunk", "ids", "z", "sizes", "n_words"])

        rid, ids, texts, held = [], [], [], 0
        for b in batches:
            for r, i, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                t = t.encode("utf-8")
                rid.append(r)
                ids.append(i)
                texts.append(t)
                held += len(t) + 64
                if held >= CHUNK_BYTES:
                    yield block(rid, ids, texts)
                    rid, ids, texts, held = [], [], [], 0
        if rid:
            yield block(rid, ids, texts)

    return d.mapInArrow(run, "chunk long, ids array<long>, z binary, sizes array<long>, n_words long")


def unpacked(z: bytes, sizes: list[int]) -> list[bytes]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(z), 0, []
    for n in sizes:
        out.append(raw[at:at + n])
        at += n
    return out


def anchor_codes(chunks: DataFrame, window: int, n_buckets: int) -> DataFrame:
    """``bucket, chunk, codes``: a chunk's different anchors by bucket."""
    def run(batches):
        for b in batches:
            for chunk, z, sizes in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                (h,), n = text_words(unpacked(z, sizes), 1)
                x = np.unique(bucket_code(cover_anchors(h, n, window)[1], n_buckets))
                k = (x >> U(CODE_BITS)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(k, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[cuts]), pa.array([chunk] * len(cuts), pa.int64()),
                     pa.array([pack_codes(p) for p in np.split(x, cuts[1:])] if len(cuts) else [], pa.binary())],
                    names=["bucket", "chunk", "codes"])

    return chunks.select("chunk", "z", "sizes").mapInArrow(run, "bucket long, chunk long, codes binary")


def shared_codes(codes: DataFrame) -> DataFrame:
    """``chunk, bucket, codes``: the codes that another chunk holds too."""
    def run(t: pa.Table) -> pa.Table:
        bucket, chunk = t.column("bucket")[0].as_py(), t.column("chunk").to_pylist()
        parts = [unpack_codes(x) for x in t.column("codes").to_pylist()]
        x = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(x, kind="stable")
        same = x[order][1:] == x[order][:-1]
        hit = order[np.append(same, False) | np.append(False, same)]
        hit.sort()
        who, cuts = np.unique(owner[hit], return_index=True)
        out = [pack_codes(p) for p in np.split(x[hit], cuts[1:])] if len(who) else []
        return pa.table({"chunk": pa.array([chunk[w] for w in who], pa.int64()),
                         "bucket": pa.array([bucket] * len(who), pa.int64()), "codes": pa.array(out, pa.binary())})

    return codes.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, codes binary")


def with_replies(chunks: DataFrame, replies: DataFrame, *cols: str) -> DataFrame:
    """Chunks with all their replies (null: none)."""
    side = replies.groupBy("chunk").agg(F.collect_list(F.struct(*cols)).alias("replies"))
    return (chunks.select("chunk", "ids", "z", "sizes").join(side, "chunk", "left")
            .select("chunk", "ids", "z", "sizes", "replies"))


def candidate_windows(chunks: DataFrame, shared: DataFrame, window: int, n_buckets: int) -> DataFrame:
    """Windows around shared anchors, packed by bucket of their hash.  ``settled`` holds the positions
    that the chunk itself has judged; these pass through the bucket as they are."""
    cols = "bucket long, chunk long, h binary, pos binary, docs binary, settled binary"
    names = [c.split()[0] for c in cols.split(", ")]
    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for chunk, ids, z, sizes, replies in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                hs, n = text_words(unpacked(z, sizes), 2)
                p, a = cover_anchors(hs[0], n, window)
                x = bucket_code(a, n_buckets)
                known = [unpack_codes(r["codes"]) | U(r["bucket"] << CODE_BITS) for r in replies or ()]
                away = np.isin(x, np.concatenate(known)) if known else np.zeros(len(x), dtype=bool)
                _, inv, count = np.unique(x, return_inverse=True, return_counts=True)
                here = count[inv] > 1
                end = np.cumsum(n)
                doc = np.repeat(np.arange(len(n)), n)
                fits = np.repeat(end, n) - np.arange(len(doc)) >= window

                def around(p, n_words=len(doc), fits=fits):
                    edge = np.zeros(n_words + 1, dtype=np.int64)
                    np.add.at(edge, np.maximum(p - (window + 1) // 2 + 1, 0), 1)
                    np.add.at(edge, p + 1, -1)
                    return (np.cumsum(edge[:-1]) > 0) & fits

                far = around(p[away])
                s = np.flatnonzero(far | around(p[here]))
                h1, h2 = (windows(h, window, step)[s] for h, step in zip(hs, STEPS, strict=True))
                key = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)[doc[s]]
                least = smallest_in_group([h1, h2], key)
                send = (key == least) & far[s]
                settled = s[key > least]
                s, h1, h2, key = s[send], h1[send], h2[send], key[send]
                k = ((h1 >> U(CODE_BITS)) % U(n_buckets)).astype(np.int64)
                order = np.argsort(k, kind="stable")
                k, s, h1, h2, key = (v[order] for v in (k, s, h1, h2, key))
                cuts = np.append(np.flatnonzero(np.diff(k, prepend=-1)), len(k))
                rows = [(int(k[i]), chunk, np.stack([h1[i:j], h2[i:j]], axis=1).tobytes(),
                         pack.compress(deltas(s[i:j]).tobytes()), pack.compress(key[i:j].tobytes()), None)
                        for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                if len(settled):
                    rows.append((chunk % n_buckets, chunk, None, None, None,
                                 pack.compress(deltas(settled).tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6,
                                                    [pa.int64()] * 2 + [pa.binary()] * 4, strict=True)], names=names)

    return with_replies(chunks, shared, "bucket", "codes").mapInArrow(run, cols)


def covered_starts(candidates: DataFrame) -> DataFrame:
    """``chunk, pos``: starts of windows that a smaller document holds too."""
    def run(t: pa.Table) -> pa.Table:
        import zstandard
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        rows = t.to_pylist()
        out = [(r["chunk"], r["settled"]) for r in rows if r["settled"] is not None]
        rows = [r for r in rows if r["h"] is not None]
        if rows:
            h = [np.frombuffer(r["h"], dtype=U).reshape(-1, 2) for r in rows]
            cuts = np.cumsum([len(x) for x in h])[:-1]
            h = np.concatenate(h)
            key = np.concatenate([np.frombuffer(unpack.decompress(r["docs"]), dtype=np.int64) for r in rows])
            gone = key > smallest_in_group([h[:, 0], h[:, 1]], key)
            for r, g in zip(rows, np.split(gone, cuts), strict=True):
                if g.any():
                    out.append((r["chunk"], pack.compress(deltas(positions(unpack.decompress(r["pos"]))[g]).tobytes())))
        return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()),
                         "pos": pa.array([p for _, p in out], pa.binary())})

    return candidates.groupBy("bucket").applyInArrow(run, "chunk long, pos binary")


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: ``doc_id, n_words, spans`` (removed word ranges, maximal, in order) and ``kept``
    (the other words, joined by one space)."""
    if window < 3:
        raise ValueError("a window holds at least three words")
    chunks = written(chunked(docs, id_col, text_col), "cover-chunks")
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    n_buckets = int(max(32, n_words * 5 // 2 // BUCKET_BYTES))
    shared = shared_codes(anchor_codes(chunks, window, n_buckets))
    starts = covered_starts(candidate_windows(chunks, shared, window, n_buckets))
    full = with_replies(chunks, starts, "pos").drop("chunk")
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches):
        import re

        import zstandard
        unpack, word = zstandard.ZstdDecompressor(), re.compile(rb"[^\x20\x09-\x0D]+")
        for b in batches:
            for ids, z, sizes, replies in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                texts = [word.findall(t) for t in unpacked(z, sizes)]
                end = np.cumsum([len(t) for t in texts])
                starts = [positions(unpack.decompress(r["pos"])) for r in replies or ()]
                starts = np.concatenate([np.zeros(0, dtype=np.int64), *starts])
                edge = np.zeros((end[-1] if len(end) else 0) + 1, dtype=np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans, kept = [], []
                for t, e in zip(texts, end, strict=True):
                    g = gone[e - len(t):e]
                    turn = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    spans.append([{"begin": int(x), "end": int(y)} for x, y in turn])
                    kept.append(b" ".join(t if not len(turn) else [t[i] for i in np.flatnonzero(~g)]).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.string())], names=["doc_id", "n_words", "spans", "kept"])

    out = full.mapInArrow(run, "doc_id long, n_words long, spans array<struct<begin:long,end:long>>, kept string")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
