"""Quality classifier by co-training a text view and a page-metadata view.

Texts are parsed once: every document becomes the hashed slots of all its distinct words and stems, a few
numbers on its shape, and the hashed slots of its language and source; these features are written.

Each view's classifier is a logistic one, fitted in the driver on a bounded sample of labelled documents
(``LABELLED``, by a hash of doc_id). Besides the terms that tell the sample's classes apart it has one
input more: the evidence of the other view. Each round, both classifiers score all unlabelled
documents of the corpus; those that one is confident of are pseudo-labelled rows of the other, handed
over as counts: for every word slot, and every metadata slot, the number of good and of bad documents
that hold it. The log odds of these counts, added up over a document's slots, are that evidence. So
every document, word, language and source of the corpus counts, and what reaches the driver is one pair
of counts for each of a fixed number of slots. A held-out share of the labelled sample then calibrates both views
(Platt) and weighs them into one score. Scoring all documents is a pass over the features, without a shuffle.

A document is good if its labels say quality 1 and toxic 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, remove, table
from .tokens import arrow_slices

#: Labelled documents that the classifiers are fitted on at most, and terms with a weight of their own; all others count as evidence.
LABELLED, TERMS = 6000, 1600
ROUNDS, CONFIDENT, THRESHOLD = 3, 0.95, 0.4
SLOTS, META_SLOTS = 1 << 18, 1 << 16
#: Rows of the labelled sample that a metadata value must have for a weight of its own; evidence beyond it counts anyway.
OWN_WEIGHT = 5
PRIOR = 4.0
STEMS = (5, 7)
_WORD = re.compile(r"[^\W\d_]+")
_SHAPE = 11
_FEATURES = "doc_id long, slots array<int>, shape array<float>, lang int, source int, n_chars double"


def _shape(text: str, words: list[str], distinct: int) -> list[float]:
    """Length-robust shape of a text: shares of symbols, capitals, digits, repeats and lines."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n, m = max(1, len(raw)), max(1, len(words))
    counts = np.bincount(raw, minlength=256)
    triples = len(set(zip(words, words[1:], words[2:]))) / max(1, len(words) - 2) if len(words) > 2 else 1.0
    lines = [x for x in text.split("\n") if x]
    marks = counts[[ord(c) for c in "#*$%&<>"]].sum() / n
    return [
        np.log1p(m), distinct / m, triples, marks**0.5, (counts[124] / n) ** 0.5, (counts[33] / n) ** 0.5,
        (counts[65:91].sum() / n) ** 0.5, (counts[48:58].sum() / n) ** 0.5,
        len(set(lines)) / max(1, len(lines)), np.mean([len(w) for w in words]) if words else 0.0, float(not words),
    ]


def parse(text: str | None) -> tuple[np.ndarray, list[float]]:
    """Sorted slots of the distinct words and stems, and the shape."""
    text = text or ""
    words = _WORD.findall(text.lower())
    distinct = set(words)
    # stems, marked as such: inflected forms of a word are often too rare to count by themselves
    terms = distinct | {"^" + w[:n] for n in STEMS for w in distinct if len(w) > n}
    slots = np.fromiter((zlib.crc32(w.encode()) for w in terms), np.uint32, len(terms)) % SLOTS
    return np.unique(slots).astype(np.int32), _shape(text, words, len(distinct))


def meta_slot(name: str, value: str | None) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % META_SLOTS if value is not None else zlib.crc32(name.encode()) % META_SLOTS


@dataclass
class Features:
    """Features of a batch of documents; slots of all documents in a row, ``ends`` tells them apart."""

    slots: np.ndarray
    ends: np.ndarray
    shape: np.ndarray
    meta: np.ndarray
    n_chars: np.ndarray

    @staticmethod
    def of(texts: list, langs: list, sources: list, n_chars: np.ndarray) -> Features:
        both = [parse(t) for t in texts]
        slots = np.concatenate([s for s, _ in both]) if both else np.zeros(0, np.int32)
        meta = np.array([(meta_slot("lang", a), meta_slot("source", b)) for a, b in zip(langs, sources)], np.int32).reshape(-1, 2)
        return Features(slots, np.cumsum([0, *(len(s) for s, _ in both)]), np.array([x for _, x in both], np.float32).reshape(-1, _SHAPE), meta, n_chars)

    @staticmethod
    def read(batch) -> Features:
        """From columns of an Arrow batch or table."""
        one = lambda c: batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c)
        slots, shape = one("slots"), one("shape")
        meta = np.stack([one(c).to_numpy(zero_copy_only=False) for c in ("lang", "source")], 1)
        return Features(slots.flatten().to_numpy(), slots.offsets.to_numpy().astype(np.int64) - slots.offsets[0].as_py(), shape.flatten().to_numpy().reshape(-1, _SHAPE), meta, one("n_chars").to_numpy(zero_copy_only=False).astype(float))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Per document the sum of its slots' weights."""
        total = np.concatenate([[0.0], np.cumsum(weights[self.slots], dtype=np.float64)])
        return total[self.ends[1:]] - total[self.ends[:-1]]

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """Per slot the number of chosen documents."""
        return np.bincount(self.slots[np.repeat(chosen, np.diff(self.ends))], minlength=SLOTS)

    def pick(self, rows: np.ndarray) -> Features:
        keep = np.repeat(rows, np.diff(self.ends))
        return Features(self.slots[keep], np.concatenate([[0], np.cumsum(np.diff(self.ends)[rows])]), self.shape[rows], self.meta[rows], self.n_chars[rows])


def _fit(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 250) -> np.ndarray:
    """Logistic regression with intercept in the last place, by Adam on the whole sample."""
    beta = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(beta), np.zeros_like(beta)
    keep = np.r_[np.full(len(beta) - 1, l2), 0.0]
    for t in range(1, steps + 1):
        off = ((_sigmoid(x @ beta[:-1].astype(x.dtype) + beta[-1]) - y) / max(1, len(y))).astype(x.dtype)
        g = np.r_[off @ x, off.sum()] + keep * beta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        beta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return beta


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_odds(good: np.ndarray, bad: np.ndarray, n_good: float, n_bad: float) -> np.ndarray:
    """How much oftener good documents hold a slot than bad ones, in logarithms; zero for slots that none holds."""
    if not n_good or not n_bad:
        return np.zeros(len(good), np.float32)
    share = n_good / (n_good + n_bad)
    w = np.log((good + PRIOR * share) / (bad + PRIOR * (1 - share))) - np.log(share / (1 - share))
    return np.clip(w, -4, 4).astype(np.float32)


@dataclass
class TextView:
    """Weights of the terms that tell the classes apart, of the shape, and of the evidence from the other view."""

    evidence: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.float32))
    terms: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.float32))
    mean: np.ndarray = None
    scale: np.ndarray = None
    beta: np.ndarray = None
    chosen: np.ndarray = None

    def choose(self, f: Features, y: np.ndarray) -> None:
        """Terms whose document frequencies differ most between the classes, by the log odds ratio over its error."""
        n = [max(1, int((y == c).sum())) for c in (0, 1)]
        a, b = (f.counts(y == c) + 0.5 for c in (0, 1))
        z = np.abs((np.log(a / (n[0] - a + 1)) - np.log(b / (n[1] - b + 1))) / np.sqrt(1 / a + 1 / b))
        z[(a + b < 6) | ~(z > 3)] = 0
        best = np.lexsort((np.arange(SLOTS), -z))[:TERMS]
        self.chosen = np.sort(best[z[best] > 0])

    def _dense(self, f: Features) -> np.ndarray:
        sized = f.sums(self.evidence) / np.sqrt(np.maximum(1, np.diff(f.ends)))
        return np.c_[f.shape, sized]

    def fit(self, f: Features, y: np.ndarray) -> None:
        dense = self._dense(f)
        self.mean, self.scale = dense.mean(0), dense.std(0) + 1e-6
        k = len(self.chosen)
        x = np.zeros((len(f), k + dense.shape[1]), np.float32)
        at = np.searchsorted(self.chosen, f.slots)
        known = (at < k) & (self.chosen[np.minimum(at, k - 1)] == f.slots) if k else np.zeros(len(f.slots), bool)
        x[np.repeat(np.arange(len(f)), np.diff(f.ends))[known], at[known]] = 1
        x[:, k:] = np.clip((dense - self.mean) / self.scale, -6, 6)
        beta = _fit(x, y, 1e-4)
        self.terms = np.zeros(SLOTS, np.float32)
        self.terms[self.chosen], self.beta = beta[:k], beta[k:]

    def predict(self, f: Features) -> np.ndarray:
        return _sigmoid(f.sums(self.terms) + np.clip((self._dense(f) - self.mean) / self.scale, -6, 6) @ self.beta[:-1] + self.beta[-1])


@dataclass
class MetaView:
    """Language, source and length as stored beside the text, and the evidence from the other view."""

    evidence: np.ndarray = field(default_factory=lambda: np.zeros(META_SLOTS, np.float32))
    values: np.ndarray = field(default_factory=lambda: np.zeros(META_SLOTS, np.float32))
    beta: np.ndarray = None
    chosen: np.ndarray = None

    def choose(self, f: Features) -> None:
        self.chosen = np.flatnonzero(np.bincount(f.meta.ravel(), minlength=META_SLOTS) >= OWN_WEIGHT)

    def _dense(self, f: Features) -> np.ndarray:
        missing = ~np.isfinite(f.n_chars)
        size = (np.log1p(np.where(missing, 0, np.maximum(0, f.n_chars))) - 6) / 2
        return np.c_[size, size * size, missing, self.evidence[f.meta].sum(1)]

    def fit(self, f: Features, y: np.ndarray) -> None:
        dense, k = self._dense(f), len(self.chosen)
        x = np.zeros((len(f), k + dense.shape[1]), np.float32)
        for j in (0, 1):
            at = np.minimum(np.searchsorted(self.chosen, f.meta[:, j]), max(0, k - 1))
            known = self.chosen[at] == f.meta[:, j] if k else np.zeros(len(f), bool)
            x[np.flatnonzero(known), at[known]] = 1
        x[:, k:] = dense
        beta = _fit(x, y, 1e-3)
        self.values = np.zeros(META_SLOTS, np.float32)
        self.values[self.chosen], self.beta = beta[:k], beta[k:]

    def predict(self, f: Features) -> np.ndarray:
        return _sigmoid(self.values[f.meta].sum(1) + self._dense(f) @ self.beta[:-1] + self.beta[-1])


@dataclass
class CoModel:
    """Both views, their calibrations (slope, intercept) and the weights of the combined score."""

    text: TextView
    meta: MetaView
    calibration: list
    mix: np.ndarray
    report: dict

    def score(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = [_sigmoid(a * _logit(q) + b) for (a, b), q in zip(self.calibration, (self.text.predict(f), self.meta.predict(f)))]
        return p[0], p[1], _sigmoid(self.mix[0] * _logit(p[0]) + self.mix[1] * _logit(p[1]) + self.mix[2])


def features(docs: DataFrame) -> DataFrame:
    """doc_id and features of every document, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_slices(batches):
            f = Features.of(*(b.column(c).to_pylist() for c in ("text", "lang", "source")), None)
            slots, shape = (pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v)) for e, v in ((f.ends, f.slots), (np.arange(len(f) + 1) * _SHAPE, f.shape.ravel())))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), slots, shape, *(pa.array(f.meta[:, j]) for j in (0, 1)), b.column("n_chars")], names=["doc_id", "slots", "shape", "lang", "source", "n_chars"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    # sorted slots: the second page format stores their differences
    return materialize(rows.mapInArrow(run, _FEATURES), "features", **{"parquet.writer.version": "PARQUET_2_0"})


def _exchange(every: DataFrame, text: TextView, meta: MetaView, known: np.ndarray, confident: float) -> None:
    """One round over all unlabelled documents: each view's confident cases become the other's evidence."""
    sent = every.sparkSession.sparkContext.broadcast((text, meta, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, meta, known = sent.value
        words, values, n = np.zeros((2, SLOTS), np.int64), np.zeros((2, META_SLOTS), np.int64), np.zeros(4, np.int64)
        for b in batches:
            f = Features.read(b)
            free = ~np.isin(b.column("doc_id").to_numpy(zero_copy_only=False), known)
            p, q = text.predict(f), meta.predict(f)
            for c, by in ((0, q >= confident), (1, q <= 1 - confident)):
                words[c] += f.counts(by & free)
                n[c] += (by & free).sum()
            for c, by in ((0, p >= confident), (1, p <= 1 - confident)):
                values[c] += np.bincount(f.meta[by & free].ravel(), minlength=META_SLOTS)
                n[2 + c] += (by & free).sum()
        for view, counts, total in ((0, words, n[:2]), (1, values, n[2:])):
            slot = np.flatnonzero(counts.sum(0))
            slot, good, bad = np.r_[-1, slot], np.r_[total[0], counts[0, slot]], np.r_[total[1], counts[1, slot]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), view)), *map(pa.array, (slot, good, bad))], names=["view", "slot", "good", "bad"])

    counts = every.mapInArrow(run, "view long, slot long, good long, bad long").groupBy("view", "slot").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    got = np.stack([c.to_numpy() for c in counts.columns]) if counts.num_rows else np.zeros((4, 0), np.int64)
    for view, side, size in ((text, 0, SLOTS), (meta, 1, META_SLOTS)):
        _, slot, good, bad = got[:, got[0] == side]
        full = np.zeros((2, size))
        full[:, slot[slot >= 0]] = np.stack([good, bad])[:, slot >= 0]
        view.evidence = log_odds(*full, *(x[slot < 0].sum() for x in (good, bad)))
    sent.destroy()


def train(every: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, confident: float = CONFIDENT) -> CoModel | None:
    """Co-train on the features of all documents; None where the labels don't hold both classes.

    Every fifth row of the labelled sample is held out for the calibration and the report.
    """
    good = ((F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good")
    chosen = labels.where(F.col("doc_id").isNotNull()).select("doc_id", good).groupBy("doc_id").agg(F.min("good").alias("good"))
    # documents of the pipeline may have lost labelled rows: take them among those still there
    ids = chosen.join(every.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    sample = every.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    y = sample.column("good").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return None
    f, held = Features.read(sample), np.arange(len(y)) % 5 == 4
    own, yl = f.pick(~held), y[~held]
    text, meta, known = TextView(), MetaView(), sample.column("doc_id").to_numpy()
    text.choose(own, yl)
    meta.choose(own)
    for _ in range(rounds):
        text.fit(own, yl)
        meta.fit(own, yl)
        _exchange(every, text, meta, known, confident)
    text.fit(own, yl)
    meta.fit(own, yl)
    rest, hy = f.pick(held), y[held]
    two = len(set(hy.tolist())) == 2
    hp = [text.predict(rest), meta.predict(rest)]
    calibration = [tuple(_fit(_logit(p)[:, None], hy, 1e-3)) if two else (1.0, 0.0) for p in hp]
    cal = [_sigmoid(a * _logit(p) + b) for (a, b), p in zip(calibration, hp)]
    mix = _fit(np.stack([_logit(c) for c in cal], 1), hy, 1e-3) if two else np.array([1.0, 0.0, 0.0])
    model = CoModel(text, meta, calibration, mix, {})
    if len(hy):
        kept = model.score(rest)[2] >= THRESHOLD
        model.report = {"held_out": len(hy), "accuracy": float((kept == hy).mean()), "good_kept": float(kept[hy == 1].mean()) if (hy == 1).any() else None, "bad_kept": float(kept[hy == 0].mean()) if (hy == 0).any() else None}
    return model


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_text, p_meta, score and kept of every document.

    Null texts count as empty; null metadata is a value of its own. Without labels of both classes
    nothing can be learned: scores are null and every document is kept. A score equal to the threshold
    is kept. Repeated rows are scored each; rows without a doc_id are scored like any other; an empty
    table gives no rows. Extra columns are ignored.
    """
    every = features(docs)
    model = train(every, labels)
    if model is None:
        return every.select("doc_id", *[F.lit(None).cast("double").alias(c) for c in ("p_text", "p_meta", "score")], F.lit(True).alias("kept"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = sent.value.score(Features.read(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, p), pa.array(p[2] >= threshold)], names=["doc_id", "p_text", "p_meta", "score", "kept"])

    return every.mapInArrow(run, "doc_id long, p_text double, p_meta double, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that ``classify`` keeps, with all their columns; rows are judged in place, whatever their ids."""
    every = features(docs)
    model = train(every, labels)
    remove(docs.sparkSession, every._docloom_path)
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def good(text: pd.Series, lang: pd.Series, source: pd.Series, n: pd.Series) -> pd.Series:
        f = Features.of(text.tolist(), [None if pd.isna(x) else x for x in lang], [None if pd.isna(x) else x for x in source], n.to_numpy(float))
        return pd.Series(sent.value.score(f)[2] >= threshold)

    judge = F.pandas_udf(good, "boolean")
    return docs.where(judge(F.coalesce("text", F.lit("")), "lang", "source", F.col("n_chars").cast("double")))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, trained on ``labels``."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_quality_classifier": op9_quality_classifier}
ORACLE: dict[str, str] = {}
