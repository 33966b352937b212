"""Near-duplicate classes by DartMinHash.

Signatures.  An element of weight w owns the region [0, w) x [0, inf) of (weight, rank).  Darts fall
on it as a Poisson process that depends on the element alone (hashes of element, weight cell and
dart number), so two documents see the same darts wherever their regions overlap.  Only darts of
rank below theta = T / total weight, T = k (ln k + 2), are thrown: about T for a document of any
length.  A dart is hashed to one of k coordinates, and each coordinate keeps its earliest dart;
documents with an empty coordinate throw again with theta doubled.  Two signatures agree in a
coordinate with probability equal to the weighted Jaccard similarity.

Classes.  ``bands`` keys of ``rows`` coordinates each bring candidates together; a link is a pair of
texts whose exact Jaccard similarity on sets of ``shingle``-word shingles is at least ``threshold``,
and classes are the connected components of the links.  Equal texts are one node from the start.
A bucket of more than ``hot_bucket`` texts often holds a passage that many otherwise different texts
share, or copies edited too much to be links.  Its texts are dealt anew by the exact rule of
:func:`prefix_keys` (rarest shingles first), which brings together all links and few other pairs.

Inside a bucket no set of all pairs is built: the member with the most bucket companions (the
likely centre) is compared with the others, the linked ones merge into one component, and the centre
leaves the bucket.  Rounds (with 1, 4, 16, ... centres) go on until the pairs left across components
are at most ``partners`` for an average row; then these are compared.  So every candidate pair is
either compared or already in one class.  With 20 bands of 4 rows a pair of similarity 0.8
is missed with probability 3e-5, less for more similar ones.

Words are runs of non-blank characters; a text of fewer words than a shingle is one shingle.

Edge cases: null text is empty; equal texts (also empty ones) are one class; texts without words
link to nothing else; null ids are kept; repeated rows get equal results; an empty table gives an
empty result; other columns are never touched.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import K1, K2, ROW, bounded, cut, keyed, keyed_rows, written

CHUNK_BYTES = 1_000_000
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


# -- shingles ----------------------------------------------------------------------------------
class WordHash(dict):
    """Word bytes -> 64-bit hash; forgets everything when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(texts: list[str], n: int, cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash) of all texts, in order, repeats included."""
    words, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        w = t.encode("utf-8").split()
        sizes[i] = len(w)
        words.append(np.fromiter(map(cache.__getitem__, w), dtype=np.uint64, count=len(w)))
    flat = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    h = np.zeros(max(len(flat) - n + 1, 0), dtype=np.uint64)
    for j in range(n):
        h = h * M3 + flat[j:j + len(h)]
    whole = np.flatnonzero(doc[:len(h)] == doc[n - 1:]) if len(h) else np.zeros(0, dtype=np.int64)
    d, e = [doc[whole]], [h[whole]]
    for i in np.flatnonzero((sizes > 0) & (sizes < n)):
        x = sizes[i:i + 1].astype(np.uint64)
        for j in range(begin[i], begin[i] + sizes[i]):
            x = x * M3 + flat[j:j + 1]
        d.append(np.array([i]))
        e.append(x)
    return np.concatenate(d), mix(np.concatenate(e))


# -- darts -------------------------------------------------------------------------------------
def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray | None, n_docs: int,
                    k: int, seed: int = 1) -> np.ndarray:
    """k coordinates per document (uint64; EMPTY throughout for documents without elements).
    ``weight`` None: every element weighs 1 (an element repeated in a document then throws the same
    darts again, which changes nothing)."""
    sig = np.full(n_docs * k, EMPTY, dtype=np.uint64)
    if weight is None:
        weight = np.ones(len(element))
        cell_doc, cell_el, room = doc, element, weight
    else:  # unit cells along the weight axis; the last one is cut off at the weight
        cells = np.ceil(weight).astype(np.int64)
        at = np.repeat(np.arange(len(element)), cells)
        j = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
        cell_doc, cell_el = doc[at], mix(element[at] + M3 * j.astype(np.uint64))
        room = np.minimum(weight[at] - j, 1.0)
    total = np.bincount(doc, weight, minlength=n_docs)
    theta = k * (math.log(k) + 2) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        pick = np.flatnonzero(todo[cell_doc])
        d, e, r_max, w = cell_doc[pick], cell_el[pick], theta[cell_doc[pick]], room[pick]
        rank, t = np.zeros(len(d)), 0
        while len(d):
            x = mix(e + np.uint64((2 * t + 1) * 0x632BE59BD9B4E019 + seed & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log1p(-(x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53)
            on = np.flatnonzero(rank < r_max)
            d, e, r_max, w, rank, x = d[on], e[on], r_max[on], w[on], rank[on], x[on]
            y = mix(x ^ M2)
            inside = np.flatnonzero((y >> np.uint64(40)).astype(np.float64) / 2.0 ** 24 < w)
            coord = (mix(y[inside]) % np.uint64(k)).astype(np.int64)
            # earliest first: the rank's bits above the dart's own bits
            value = (rank[inside].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) \
                | (y[inside] & np.uint64(0xFFFFFFFF))
            np.minimum.at(sig, d[inside] * k + coord, value)
            t += 1
        todo &= (sig.reshape(n_docs, k) == EMPTY).any(1)
        theta = theta * 2
    return sig.reshape(n_docs, k)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    x = np.zeros((len(sig), bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        x = mix(x * M3 + sig[:, j::rows][:, :bands])
    return x.view(np.int64)


def chunks(texts: list[str], limit: int = CHUNK_BYTES):
    """Runs of texts of about ``limit`` characters."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def with_bands(texts: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``node, row, keys`` (no keys for texts without words) from ``node, row, text``."""
    schema = pa.schema([("node", pa.binary()), ("row", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        cache = WordHash()
        for b in batches:
            text = b.column(2).to_pylist()
            for i, j in chunks(text):
                doc, el = shingles(text[i:j], shingle, cache)
                keys = band_keys(dart_signatures(doc, el, None, j - i, bands * rows), bands, rows)
                has = np.bincount(doc, minlength=j - i) > 0
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i).cast(pa.binary()), b.column(1).slice(i, j - i),
                    pa.array([k if ok else [] for k, ok in zip(keys.tolist(), has.tolist(), strict=True)],
                             pa.list_(pa.int64()))], schema=schema)

    return texts.select("node", "row", "text").mapInArrow(run, "node binary, row long, keys array<long>")


# -- links -------------------------------------------------------------------------------------
def linked(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose texts' shingle sets have at least the threshold's similarity."""
    def run(batches):
        cache, last, last_set = WordHash(), None, None
        for b in batches:
            a_id, b_id, ta, tb = (b.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a_id)):
                if a_id[i] != last:
                    last, last_set = a_id[i], np.unique(shingles([ta[i]], shingle, cache)[1])
                other = np.unique(shingles([tb[i]], shingle, cache)[1])
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                either = len(last_set) + len(other) - both
                keep.append(either > 0 and both >= threshold * either)
            on = [i for i, k in enumerate(keep) if k]
            yield pa.RecordBatch.from_arrays([pa.array([a_id[i] for i in on], pa.binary()),
                                              pa.array([b_id[i] for i in on], pa.binary())], names=["a", "b"])

    t = texts.select("node", "text")
    full = (pairs.join(t.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(t.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"))
    return full.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node of the component) by alternating large and small stars."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        e = e.distinct()
        least = written(e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        j = e.join(least, "a")
        if large:
            return j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))

    state = None
    e = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        state = now
        e = star(star(e, True).where(F.col("a") != F.col("b")), False)
        e = written(e.where(F.col("a") != F.col("b")).distinct(), "edges")


def labelled(nodes: DataFrame, comp: DataFrame | None) -> DataFrame:
    """The rows with ``comp``: the component of ``node`` so far, the node itself if it has no link."""
    if comp is None:
        return nodes.withColumn("comp", F.col("node"))
    return nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after new links: the graph of the old components is the only one solved."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = ends if comp is None else ends.union(comp.select("node")).distinct()
    old = written(labelled(known, comp), "components")
    graph = (links.join(old.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
             .join(old.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
             .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    root = components(graph).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return written(old.join(root, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "components")


def prefix_keys(texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """``key, node, native``: exact blocking keys of texts.  A text's shingles are ordered rarest first,
    in one order for all texts.  For two texts of n >= s shingles and the wanted similarity t, the
    overlap is at least t / (1 + t) (n + s), so they share one of their first n - overlap + 1
    shingles.  Sizes s fall into classes 2 % wide; a text is native to the class of its own size
    and a guest, with the longer prefix that a smaller partner needs, in those below it down to
    t n.  Two guests of a class need not meet there."""
    def run(batches):
        cache = WordHash()
        for b in batches:
            sets = [np.unique(shingles([t], shingle, cache)[1]).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["node", "tokens"])

    token = written(texts.select("node", "text").mapInArrow(run, "node binary, tokens array<long>")
                    .select("node", F.explode("tokens").alias("token")), "tokens")
    freq = written(token.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "token-counts")
    n, wide = F.col("n"), math.log(1.02)
    size_class = lambda s: F.floor(F.log(s) / wide + 1e-9)
    ordered = (token.join(freq, "token").groupBy("node")
               .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")).withColumn("n", F.size("t")))
    each = ordered.withColumn("c", F.explode(F.sequence(size_class(F.ceil(n * threshold - 1e-9)), size_class(n))))
    least = F.greatest(F.exp(F.col("c") * wide) - 1e-6, n * threshold)
    overlap = F.ceil((n + least) * (threshold / (1 + threshold)) - 1e-6)
    prefix = F.greatest(n - overlap + 1, F.lit(0)).cast("int")
    return (each.select("node", "c", (F.col("c") == size_class(n)).alias("native"),
                        F.explode(F.filter(F.slice("t", F.lit(1), prefix), lambda x: x["df"] > 1)).alias("x"))
            .select(F.xxhash64(F.lit("prefix"), "c", "x.token").alias("key"), "node", "native"))


def node_components(docs: DataFrame, shingle: int, threshold: float, bands: int, rows: int,
                    partners: int, hot_bucket: int) -> DataFrame:
    """``node, comp`` of the texts that are linked to another text; ``docs``: row key and text."""
    texts = docs.select(F.unhex(F.md5(F.col("text"))).alias("node"), F.col(K1).alias("row"), "text")
    signed = cut(with_bands(texts, shingle, bands, rows))
    nodes = signed.groupBy("node").agg(F.min(F.struct("row", "keys")).alias("x")).select("node", "x.row", "x.keys")
    member = nodes.select(F.explode("keys").alias("key"), "node")
    busy = written(member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "busy")
    member = written(member.join(busy, "key"), "members")
    # the texts that may be compared, one row each, fetched once
    wanted = written(nodes.select("node", "row").join(member.select("node").distinct(), "node"), "wanted")
    candidates = written(texts.join(bounded(wanted, 64), ["node", "row"]).dropDuplicates(["node"])
                         .select("node", "text"), "texts")
    crowded = written(member.where(F.col("n") > hot_bucket).select("node").distinct(), "crowded")
    if not crowded.isEmpty():
        finer = prefix_keys(candidates.join(crowded, "node"), shingle, threshold)
        member = written(member.where(F.col("n") <= hot_bucket).select("key", "node", F.lit(True).alias("native"))
                         .union(finer), "members")
        shared = written(member.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("native").alias("met"))
                         .where((F.col("n") > 1) & F.col("met")).drop("met"), "busy")
        member = written(member.join(shared, "key"), "members")
    else:
        member = member.withColumn("native", F.lit(True))
    central = written(member.groupBy("node").agg(F.sum("n").alias("score")), "scores")
    member = member.join(central, "node").select("key", "node", "native", "score")
    comp = compared = None
    hubs = 1
    while True:
        rows_now = written(labelled(member, comp), "buckets")
        # buckets with pairs left: across components, not both guests
        square = lambda c: F.sum(F.col(c) * F.col(c))
        half = lambda s, q: (F.col(s) * F.col(s) - F.col(q)) / 2
        per = rows_now.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("c"),
                                                  F.count_if(~F.col("native")).cast("double").alias("g"))
        state = written(per.groupBy("key").agg(F.sum("c").alias("n"), square("c").alias("n2"),
                                               F.sum("g").alias("m"), square("g").alias("m2"))
                        .select("key", "n", (half("n", "n2") - half("m", "m2")).alias("pairs"))
                        .where(F.col("pairs") > 0), "state")
        total = state.agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs")).first()
        if total["n"] is None:
            break
        member = written(rows_now.join(state.select("key"), "key"), "members")
        last = hubs > 1 and total["pairs"] <= partners * total["n"]
        centre = member.where("native").select("key", F.col("node").alias("b"), F.col("comp").alias("comp_b"), "score")
        if not last:
            place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "b"))
            centre = written(centre.withColumn("place", place).where(F.col("place") <= hubs), "hubs")
        centre = centre.select("key", "b", "comp_b")
        pairs = (member.join(centre, "key").where(F.col("comp") != F.col("comp_b"))
                 .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct())
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        links = written(linked(pairs, candidates, shingle, threshold), "links")
        if not links.isEmpty():
            comp = merged(comp, links)
        if last:
            break
        compared = pairs if compared is None else written(compared.union(pairs), "compared")
        member = (member.join(centre.select("key", F.col("b").alias("node")), ["key", "node"], "left_anti")
                  .select("key", "node", "native", "score"))
        hubs *= 4
    if comp is None:
        return docs.sparkSession.createDataFrame([], "node binary, comp binary")
    return comp


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, bands: int = 20,
                    rows: int = 4, partners: int = 10, hot_bucket: int = 8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per input row: row key, ``doc_id``, ``comp`` (binary class key), ``class_id`` (the class's
    smallest id) and ``class_size`` (rows)."""
    d = keyed(docs, id_col, text_col)
    comp = node_components(d, shingle, threshold, bands, rows, partners, hot_bucket)
    ids = d.select(K1, K2, "doc_id", F.unhex(F.md5("text")).alias("node"))
    full = ids.join(comp, "node", "left").select(K1, K2, "doc_id", F.coalesce("comp", "node").alias("comp"))
    classes = written(full.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")),
                      "classes")
    return full.join(classes, "comp").select(K1, K2, "doc_id", "comp", "class_id", "class_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows, all columns, of one document per class: the one with the smallest id."""
    c = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", K1, K2)).alias("x")
    stay = written(c.groupBy("comp").agg(first).select(f"x.{K1}", f"x.{K2}"), "stay")
    rows = keyed_rows(docs, id_col, text_col).join(stay, [K1, K2]).dropDuplicates([K1, K2])
    return rows.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns])
