"""Quality classifier by co-training on two views of a page.

View ``content``: what the text is made of (character and word statistics).  View ``meta``: what a
crawler knows of the page without reading it (source, language, length and line layout).  Each
view has its own logistic model.

1. One pass turns every document into its two feature vectors; only these are kept.
2. Rounds: each view scores the unlabelled documents, and those it is confident about become
   pseudo-labelled training rows of the *other* view (weighted so that their class shares follow
   the labelled ones).  Confident means beyond the score at which the view is ``precision`` right
   on labelled rows it was not trained on.  Both models are then refitted by Newton steps; a step
   sums gradients and Hessians over all rows of the feature table on the executors.
3. The views' logits are calibrated (Platt) on labelled rows kept out of training (a fifth, by
   crc32 of the id; at most ``max_calibration`` of them, chosen by a hash), a logistic combination
   of the two calibrated logits is fitted there, and all documents are scored.

Edge cases: null text is empty, null source, language or length are values of their own; null
labels are ignored, the largest of several labels of one id counts; without both classes every
score is the only label (1 without labels); repeated rows are scored alike; an empty table gives
an empty result; other columns are never touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import K1, K2, ROW, cut, hash_pair, keyed_rows

SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SOURCES, LANGS = 32, 8
BINS = 2000
VIEWS = ("content", "meta")


# -- views -------------------------------------------------------------------------------------
def content_view(text: str) -> list[float]:
    raw = text.encode("utf-8")
    n = max(len(raw), 1)
    c = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    m = max(len(words), 1)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    tri = (ids[:-2] * len(seen) + ids[1:-1]) * len(seen) + ids[2:]
    ends = np.bincount(np.frombuffer(bytes(w[-1] for w in words), dtype=np.uint8), minlength=128)
    shares = [c[65:91].sum(), c[48:58].sum(), c[128:].sum(), *(c[ord(s)] for s in SYMBOLS)]
    return [*np.sqrt(np.array(shares, dtype=float) / n).tolist(),
            np.sqrt(ends[33:48].sum() / m), np.sqrt(ends[65:91].sum() / m),
            len(seen) / m, len(np.unique(tri)) / max(len(tri), 1), float(np.log1p(n / m)), float(len(words) == 0)]


def meta_view(text: str, source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    import zlib
    one = np.zeros(SOURCES + LANGS)
    one[zlib.crc32(repr(source).encode()) % SOURCES] = 1.0
    one[SOURCES + zlib.crc32(repr(lang).encode()) % LANGS] = 1.0
    lines = text.split("\n")
    size = np.array([len(x) for x in lines], dtype=float)
    k = len(lines)
    return [*one.tolist(), float(np.log1p(max(n_chars or 0, 0))), float(n_chars is None), float(np.log1p(k)),
            float(np.log1p(size.mean())), float(np.log1p(size.max())), float(np.log1p(size.std())),
            float((size < 20).mean()), float((size == 0).mean()), 1 - len(set(lines)) / k]


def feature_table(docs: DataFrame, labels: DataFrame, cols: dict[str, str], label_col: str) -> DataFrame:
    """Row key, ``doc_id``, ``content``, ``meta``, ``y`` (null: unlabelled) and ``fold``."""
    a, b = hash_pair(F.col(cols["id"]), F.col(cols["text"]))
    d = docs.select(a.alias(K1), b.alias(K2), F.coalesce(F.col(cols["text"]), F.lit("")).alias("text"),
                    F.col(cols["source"]).cast("string").alias("source"),
                    F.col(cols["lang"]).cast("string").alias("lang"),
                    F.col(cols["n_chars"]).cast("long").alias("n_chars"), F.col(cols["id"]).alias("doc_id"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for x in batches:
            t = x.column(2).to_pylist()
            meta = [meta_view(*r) for r in zip(t, *(x.column(i).to_pylist() for i in (3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [x.column(0), x.column(1), x.column(6), pa.array([content_view(s) for s in t], pa.list_(pa.float32())),
                 pa.array(meta, pa.list_(pa.float32()))], names=[K1, K2, "doc_id", *VIEWS])

    f = d.mapInArrow(run, f"{K1} long, {K2} long, doc_id {id_type}, content array<float>, meta array<float>")
    lab = (labels.select(F.col(cols["id"]).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
           .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return cut(f.join(lab, "doc_id", "left").withColumn("fold", F.coalesce(fold, F.lit(1)).cast("int")))


# -- sums over the table -----------------------------------------------------------------------
def matrix(column: pa.Array, moments: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    if moments is None:
        return x
    return np.concatenate([np.clip((x - moments[0]) / moments[1], -8, 8), np.ones((len(x), 1))], axis=1)


def summed(table: DataFrame, fn, size: int) -> np.ndarray:
    """Sum of ``fn(batch) -> vector`` over all batches: one vector per task, added by Spark."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += fn(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "v"])

    rows = table.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def newton(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the weighted log-loss at beta, flattened together."""
    p = sigmoid(x @ beta)
    g = x.T @ (w * (p - y))
    h = (x * (w * p * (1 - p))[:, None]).T @ x
    return np.concatenate([g, h.ravel()])


class Views:
    """The two models and the thresholds beyond which each view is confident."""

    def __init__(self, moments: list, precision: float):
        self.moments, self.precision = moments, precision
        self.beta = [np.zeros(len(m[0]) + 1) for m in moments]
        self.sure = [(-np.inf, np.inf)] * 2
        self.share = [(0.0, 0.0)] * 2

    def inputs(self, b: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        i = b.schema.get_field_index
        y = b.column(i("y")).to_numpy(zero_copy_only=False).astype(float)  # null: nan
        return [matrix(b.column(i(v)), m) for v, m in zip(VIEWS, self.moments, strict=True)], y, \
            b.column(i("fold")).to_numpy(zero_copy_only=False)

    def pseudo(self, z: np.ndarray, view: int) -> np.ndarray:
        """1, 0 or nan (not confident) by the view's logits."""
        lo, hi = self.sure[view]
        return np.where(z >= hi, 1.0, np.where(z <= lo, 0.0, np.nan))

    def fit(self, table: DataFrame, steps: int, l2: float) -> None:
        """Newton steps of both models; teachers stay as they were before the first step."""
        teach = [b.copy() for b in self.beta]
        sizes = [len(b) + len(b) ** 2 for b in self.beta]
        for _ in range(steps):
            now, me = [b.copy() for b in self.beta], self

            def sums(b: pa.RecordBatch, now=now, teach=teach) -> np.ndarray:
                xs, y, fold = me.inputs(b)
                out = []
                for v in (0, 1):
                    other = 1 - v
                    guess = me.pseudo(xs[other] @ teach[other], other)
                    use = ~np.isnan(y) & (fold != 0)
                    new = np.isnan(y) & ~np.isnan(guess)
                    t = np.where(use, y, np.where(new, guess, 0.0))
                    w = np.where(use, 1.0, np.where(new, np.where(t > 0, me.share[other][1], me.share[other][0]), 0.0))
                    out.append(newton(xs[v], np.nan_to_num(t), w, now[v]))
                return np.concatenate(out)

            s = summed(table, sums, sum(sizes))
            for v, part in enumerate(np.split(s, [sizes[0]])):
                k = len(now[v])
                pen = np.full(k, l2)
                pen[-1] = 1e-6
                g, h = part[:k] + pen * now[v], part[k:].reshape(k, k) + np.diag(pen)
                step = np.linalg.solve(h, g)
                self.beta[v] = now[v] - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))

    def set_confidence(self, table: DataFrame, weight: float) -> None:
        """Thresholds from the histograms of labelled rows kept out of training; weights so that
        pseudo-labels add ``weight`` times the labelled rows, in the labelled class shares."""
        me = self

        def sums(b: pa.RecordBatch) -> np.ndarray:
            xs, y, fold = me.inputs(b)
            out = []
            for v in (0, 1):
                q = np.minimum((sigmoid(xs[v] @ me.beta[v]) * BINS).astype(int), BINS - 1)
                for rows in (~np.isnan(y) & (fold == 0) & (y == 0), ~np.isnan(y) & (fold == 0) & (y == 1),
                             np.isnan(y), ~np.isnan(y) & (fold != 0) & (y == 0), ~np.isnan(y) & (fold != 0) & (y == 1)):
                    out.append(np.bincount(q[rows], minlength=BINS))
            return np.concatenate(out).astype(float)

        hist = summed(table, sums, 2 * 5 * BINS).reshape(2, 5, BINS)
        for v in (0, 1):
            bad, good, free, bad_fit, good_fit = hist[v]
            edge = np.arange(BINS + 1) / BINS
            up_good, up_bad = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
            dn_good, dn_bad = good.cumsum(), bad.cumsum()
            # one more mistake than seen, so that a handful of rows proves nothing
            ok_hi = up_good / (up_good + up_bad + 1) >= self.precision
            ok_lo = dn_bad / (dn_bad + dn_good + 1) >= self.precision
            hi = int(np.argmax(ok_hi)) if ok_hi.any() else None
            lo = int(BINS - 1 - np.argmax(ok_lo[::-1])) if ok_lo.any() else None
            logit = lambda p: float(np.log(max(p, 1e-9) / max(1 - p, 1e-9)))
            n_hi = free[hi:].sum() if hi is not None else 0.0
            n_lo = free[:lo + 1].sum() if lo is not None else 0.0
            if n_hi < 1 or n_lo < 1:  # one-sided pseudo-labels would only shift the intercept
                self.sure[v], self.share[v] = (-np.inf, np.inf), (0.0, 0.0)
                continue
            self.sure[v] = (logit(edge[lo + 1]), logit(edge[hi]))
            self.share[v] = (min(1.0, weight * bad_fit.sum() / n_lo), min(1.0, weight * good_fit.sum() / n_hi))


def platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model with intercept (a ridge of one keeps separable rows finite)."""
    x = np.column_stack([z, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        s = newton(x, y, np.ones(len(y)), beta)
        k = len(beta)
        h = s[k:].reshape(k, k) + np.eye(k)
        beta = beta - np.clip(np.linalg.solve(h, s[:k] + beta), -3, 3)
    return beta


# -- operator ----------------------------------------------------------------------------------
def co_train(docs: DataFrame, labels: DataFrame, rounds: int = 3, precision: float = 0.97,
             pseudo_weight: float = 0.5, l2: float = 2.0, max_calibration: int = 20_000,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             lang_col: str = "lang", n_chars_col: str = "n_chars", label_col: str = "quality") -> DataFrame:
    """Row key, ``doc_id, score`` (probability of quality 1), ``content_score, meta_score`` and
    ``kept`` (score 0.5 or more), one row per input row."""
    cols = {"id": id_col, "text": text_col, "source": source_col, "lang": lang_col, "n_chars": n_chars_col}
    table = feature_table(docs, labels, cols, label_col)
    n = {r["y"]: r["n"] for r in table.where(F.col("y").isNotNull() & (F.col("fold") != 0))
         .groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        only = float(next(iter(n), 1))
        s = F.lit(only)
        return table.select(K1, K2, "doc_id", s.alias("score"), s.alias("content_score"), s.alias("meta_score"),
                            F.lit(only >= 0.5).alias("kept"))
    sizes = [len(content_view("")), len(meta_view("", None, None, None))]

    def moments(b: pa.RecordBatch) -> np.ndarray:
        xs = [matrix(b.column(b.schema.get_field_index(v)), None) for v in VIEWS]
        return np.concatenate([[b.num_rows], *(np.concatenate([x.sum(0), (x * x).sum(0)]) for x in xs)])

    s = summed(table, moments, 1 + 2 * sum(sizes))
    parts = np.split(s[1:] / s[0], [sizes[0], 2 * sizes[0], 2 * sizes[0] + sizes[1]])
    spread = lambda m, q: np.sqrt(np.maximum(q - m * m, 0.0)) + 1e-3
    views = Views([(parts[0], spread(*parts[:2])), (parts[2], spread(*parts[2:]))], precision)
    views.fit(table, steps=6, l2=l2)
    for _ in range(rounds):
        views.set_confidence(table, pseudo_weight)
        views.fit(table, steps=3, l2=l2)

    held = table.where(F.col("y").isNotNull() & (F.col("fold") == 0))
    share = min(1.0, max_calibration / max(held.count(), 1))
    held = held.where(F.pmod(F.col(K1), F.lit(1_000_000)) < int(share * 1_000_000))
    kept_out = scored(held, views).select("z0", "z1", "y").toPandas()
    calib, mix = [np.array([1.0, 0.0])] * 2, np.array([0.5, 0.5, 0.0])
    if kept_out["y"].nunique() > 1:
        y = kept_out["y"].to_numpy(dtype=float)
        calib = [platt(kept_out[f"z{v}"].to_numpy()[:, None], y) for v in (0, 1)]
        mix = platt(np.column_stack([kept_out[f"z{v}"] * c[0] + c[1] for v, c in enumerate(calib)]), y)
    z = [F.col(f"z{v}") * float(c[0]) + float(c[1]) for v, c in enumerate(calib)]
    p = lambda x: 1 / (1 + F.exp(-x))
    final = p(z[0] * float(mix[0]) + z[1] * float(mix[1]) + float(mix[2]))
    return (scored(table, views)
            .select(K1, K2, "doc_id", final.alias("score"), p(z[0]).alias("content_score"),
                    p(z[1]).alias("meta_score"))
            .withColumn("kept", F.col("score") >= 0.5))


def scored(table: DataFrame, views: Views) -> DataFrame:
    """The table's keys and labels with both views' logits ``z0, z1``."""
    id_type = table.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            i = b.schema.get_field_index
            if b.num_rows:
                xs, _, _ = views.inputs(b)
                yield pa.RecordBatch.from_arrays(
                    [b.column(i(c)) for c in (K1, K2, "doc_id", "y")]
                    + [pa.array(x @ w) for x, w in zip(xs, views.beta, strict=True)],
                    names=[K1, K2, "doc_id", "y", "z0", "z1"])

    return table.mapInArrow(run, f"{K1} long, {K2} long, doc_id {id_type}, y int, z0 double, z1 double")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """The input rows, all columns, that the classifier keeps."""
    bad = (co_train(docs, labels, id_col=id_col, text_col=text_col, **options).where(~F.col("kept"))
           .select(K1, K2))
    rows = keyed_rows(docs, id_col, text_col).join(cut(bad), [K1, K2], "left_anti")
    return rows.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns])
