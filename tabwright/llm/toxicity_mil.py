"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A logistic model scores sentences from their words and word
beginnings; a document is toxic when at least one sentence is, so its score is the noisy-or
1 - prod(1 - p_s).  Only documents carry labels: the likelihood of the bags trains the sentence
model, which then points at the offending sentences.

1. These features are screened over all labelled training documents (a Spark aggregation): one stays when
   its document rates in the two classes differ by ``min_z`` standard errors; the ``max_words``
   strongest make the vocabulary.
2. Bags of at most ``max_bags`` training documents (chosen by a hash of the id; all of them when
   there are fewer) hold only vocabulary words, and are fitted in numpy by gradient steps.
3. Every document is scored where it lies; nothing is shuffled.

Edge cases: null and empty texts have no sentence and score 0; null labels are ignored, and of
several labels of one id the largest counts; without both classes every score is 0; repeated rows
are scored alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import bounded, cut, map_texts

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
FLUSH = 200_000
PREFIXES = (4, 5, 6, 7)


def sentences(text: str) -> list[tuple[int, int]]:
    """Code-point spans of the sentences that hold a word."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m.group())]


def features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by ``^``: offending words come in many endings."""
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


class Known(dict):
    """Word -> its features that a vocabulary holds; forgets everything when it has grown large."""

    def __init__(self, vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> list[str]:
        if len(self) >= 500_000:
            self.clear()
        found = self[word] = [f for f in features(word) if f in self.vocabulary]
        return found


def sentence_features(text: str, spans: list[tuple[int, int]], known: Known) -> list[set[str]]:
    """Per sentence the set of known features of its words."""
    return [set().union(*map(known.__getitem__, WORD.findall(text[a:b].lower()))) for a, b in spans]


@dataclass(frozen=True)
class Model:
    """Word weights and bias of the sentence score; an empty ``weights`` scores everything 0."""
    weights: dict[str, float]
    bias: float

    def scorer(self):
        """``text -> (score, offending sentences)`` with a word cache of its own."""
        w, bias, known = self.weights, self.bias, Known(self.weights)

        def score(text: str) -> tuple[float, list[dict]]:
            spans = sentences(text) if w else []
            if not spans:
                return 0.0, []
            # in a fixed order, so that equal texts score equal to the last bit
            z = np.array([bias + sum(w[f] for f in sorted(s)) for s in sentence_features(text, spans, known)])
            p = 1.0 / (1.0 + np.exp(-z))
            total = -np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
            bad = [{"start": a, "end": b, "score": float(x)} for (a, b), x in zip(spans, p, strict=True) if x >= 0.5]
            return float(min(max(total, 0.0), 1.0)), bad

        return score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """``word, pos, neg``: training documents of either class that hold the word."""
    import pyarrow as pa
    schema = pa.schema([("word", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])

    def run(batches):
        counts: dict[str, list[int]] = {}
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w in {f for x in set(WORD.findall(text.lower())) for f in features(x)}:
                    counts.setdefault(w, [0, 0])[0 if y else 1] += 1
                if len(counts) >= FLUSH:
                    yield out(counts)
                    counts = {}
        yield out(counts)

    def out(counts):
        return pa.RecordBatch.from_arrays([
            pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
            pa.array([c[1] for c in counts.values()], pa.int64())], schema=schema)

    part = train.select("text", "y").mapInArrow(run, "word string, pos long, neg long")
    return part.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def vocabulary(train: DataFrame, n_pos: int, n_neg: int, max_words: int, min_z: float) -> list[str]:
    n = n_pos + n_neg
    rate = (F.col("pos") + F.col("neg")) / n
    se = F.sqrt(rate * (1 - rate + 1 / n) * (1 / n_pos + 1 / n_neg))
    z = F.abs(F.col("pos") / n_pos - F.col("neg") / n_neg) / se
    best = (word_counts(train).where(F.col("pos") + F.col("neg") >= 3)
            .select("word", z.alias("z")).where(F.col("z") >= min_z)
            .orderBy(F.desc("z"), "word").limit(max_words))
    return [r["word"] for r in best.collect()]


@dataclass(frozen=True)
class Bags:
    """Training documents as flat arrays: label, sentences without a vocabulary word and with one per
    document, vocabulary words per such sentence, and the words' indices."""
    label: np.ndarray
    empty: np.ndarray
    full: np.ndarray
    size: np.ndarray
    word: np.ndarray

    def packed(self) -> list[bytes]:
        return [np.asarray(x, dtype=np.int32).tobytes() for x in
                (self.label, self.empty, self.full, self.size, self.word)]

    @staticmethod
    def joined(rows: list[list[bytes]]) -> Bags:
        return Bags(*(np.frombuffer(b"".join(r[i] for r in rows), dtype=np.int32) for i in range(5)))


def collect_bags(chosen: DataFrame, words: list[str]) -> Bags:
    """One packed row per batch comes to the driver; ``chosen`` is a bounded sample."""
    import pyarrow as pa
    index = {w: i for i, w in enumerate(words)}
    names = ["label", "n_empty", "n_full", "size", "word"]

    def run(batches):
        known = Known(index)
        for b in batches:
            label, empty, full, size, word = [], [], [], [], []
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = [sorted(index[w] for w in s) for s in sentence_features(text, sentences(text), known)]
                hits = [s for s in got if s]
                label.append(int(y > 0))
                empty.append(len(got) - len(hits))
                full.append(len(hits))
                size += [len(s) for s in hits]
                word += [w for s in hits for w in s]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.binary()) for x in Bags(label, empty, full, size, word).packed()], names=names)

    rows = chosen.select("text", "y").mapInArrow(run, ", ".join(f"{n} binary" for n in names)).collect()
    return Bags.joined([[bytes(r[n]) for n in names] for r in rows])


def fit_bags(bags: Bags, n_words: int, steps: int = 400, l2: float = 0.2) -> tuple[np.ndarray, float]:
    """Maximum likelihood of the noisy-or.  With S the sum of softplus(z_s) over a document's sentences,
    P(toxic) = 1 - exp(-S)."""
    y, empty, word = bags.label.astype(float), bags.empty.astype(float), bags.word
    n_bags, n_sents = len(bags.label), len(bags.size)
    bag = np.repeat(np.arange(n_bags, dtype=np.int32), bags.full)
    sent = np.repeat(np.arange(n_sents, dtype=np.int32), bags.size)
    softplus = lambda z: np.logaddexp(0.0, z)
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-z))
    theta = np.zeros(n_words + 1)
    theta[-1] = -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        b = theta[-1]
        z = b + np.bincount(sent, theta[word], minlength=n_sents)
        s = np.bincount(bag, softplus(z), minlength=n_bags) + empty * softplus(b)
        ds = np.where(y > 0, -1.0 / np.expm1(np.clip(s, 1e-9, 500.0)), 1.0)
        dz = ds[bag] * sigmoid(z)
        g = np.concatenate([np.bincount(word, dz[sent], minlength=n_words) + l2 * theta[:-1] / 4,
                            [dz.sum() + (ds * empty).sum() * sigmoid(b)]]) / n_bags
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.1 * (0.5 ** (t * 4 // steps)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, max_words: int = 4096, min_z: float = 3.5,
        max_bags: int = 30_000, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on the documents whose id is not held out and that have a label."""
    lab = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y"))
           .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("y").cast("int").alias("y")))
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # labels below the size bound travel to the texts, so the texts are read where they lie
    train = d.join(bounded(cut(lab), 16), "doc_id")
    n = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos = sum(k for y, k in n.items() if y)
    n_neg = sum(n.values()) - n_pos
    if not n_pos or not n_neg:
        return Model({}, 0.0)
    words = vocabulary(train, n_pos, n_neg, max_words, min_z)
    if not words:
        return Model({}, 0.0)
    share = min(1.0, max_bags / (n_pos + n_neg))
    chosen = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    bags = collect_bags(chosen, words)
    if len(set(bags.label.tolist())) < 2:
        return Model({}, 0.0)
    w, b = fit_bags(bags, len(words))
    return Model({k: float(x) for k, x in zip(words, w, strict=True)}, b)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, offending``: sentences (code-point spans) whose own score is 0.5 or more."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_texts(d, model.scorer,
                     "score double, offending array<struct<start:int,end:int,score:double>>")
