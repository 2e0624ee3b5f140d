"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams, trained with FTRL-proximal.

A text is lower-cased, characters other than letters become spaces, and its 1- to 3-grams are hashed into 2^15 counts.
Weights are (1 + ln tf) * idf, of unit length; document frequencies are counted over all learnable documents. Training
takes at most about `per_label` documents of each label (chosen by a hash of the id) in one task: FTRL with elastic-net
penalties on most of them, then a temperature that minimises the log loss on the rest. Prediction is one pass over all
texts, with one weight row of 2^15 floats for each label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, materialize, slices

BITS = 15
DIM = 1 << BITS
UNKNOWN = "und"
_LETTER = np.array([chr(i).isalpha() for i in range(0x3000)])


def _letters(codes: np.ndarray) -> np.ndarray:
    letter = _LETTER[np.minimum(codes, len(_LETTER) - 1)]
    for c in np.unique(codes[codes >= len(_LETTER)]).tolist():
        letter[codes == c] = chr(c).isalpha()
    return letter


def _hashed(codes: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(len(codes) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


def gram_counts(texts: list[str | None], chars: int = 2_000_000):
    """(has a letter, bucket numbers, their counts) of each text, in order; hashing runs over blocks of texts."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n < chars):
            n += len(texts[j] or "")
            j += 1
        low = [f" {(t or '').lower()} " for t in texts[i:j]]
        codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(codes)
        codes = np.where(letter, codes, np.uint32(32))
        grams = [_hashed(codes, n) for n in (1, 2, 3)]
        at = 0
        for t in low:
            end = at + len(t)
            if letter[at:end].any():
                counts = np.bincount(np.concatenate([grams[0][at:end], grams[1][at : end - 1], grams[2][at : end - 2]]), minlength=DIM)
                found = np.flatnonzero(counts)
                yield True, found, counts[found]
            else:
                yield False, np.zeros(0, np.int64), np.zeros(0, np.int64)
            at = end
        i = j


def _weights(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[found]
    return x / max(np.sqrt(x @ x), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents of each bucket, documents) over docs(text); each task sends its counts, 2^15 numbers reach the driver."""
    def run(batches):
        df = np.zeros(DIM + 1, np.int64)
        for b in slices(batches):
            for some, found, _ in gram_counts(b.column("text").to_pylist()):
                df[found] += 1
                df[DIM] += some
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIM + 1, np.int64)
    for r in rows:
        df[r.bucket] = r.n
    return df[:DIM], int(df[DIM])


def train_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], labels: int, alpha=0.3, beta=1.0, l1=0.02, l2=0.02, epochs: int = 3, seed: int = 7) -> np.ndarray:
    """Weights (DIM x labels) by FTRL-proximal on (label, buckets, weights) rows; |z| up to l1 keeps a weight at zero."""
    z, n, rng = np.zeros((DIM, labels)), np.zeros((DIM, labels)), np.random.default_rng(seed)

    def solve(zs, ns):
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, at, x = rows[k]
            zs, ns = z[at], n[at]
            w = solve(zs, ns)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = np.outer(x, p)
            more = ns + g * g
            z[at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[at] = more
    return solve(z, n)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), labels]).mean())

    low, high, golden = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class LanguageModel:
    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.labels, self.idf, self.weights, self.temperature = labels, idf, weights, temperature

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        out, scores = [], []
        for some, found, counts in gram_counts(texts):
            if not some or not self.labels:
                out.append(UNKNOWN)
                scores.append(0.0)
                continue
            s = _weights(found, counts, self.idf) @ self.weights[found] / self.temperature
            p = np.exp(s - s.max())
            k = int(p.argmax())
            out.append(self.labels[k])
            scores.append(float(p[k] / p.sum()))
        return out, scores


def train_language_model(docs: DataFrame, per_label: int = 1500, most_labels: int = 1000) -> LanguageModel:
    """From docs(doc_id, text, label) without null labels. Without documents the model answers `und`.

    Learns from at most per_label documents of each label, distinct in id and text, whatever the ids; each label has some. More than
    most_labels labels are an error, as the model is a row of weights for each.
    """
    labels = sorted(r.label for r in docs.select("label").distinct().limit(most_labels + 1).collect())
    if len(labels) > most_labels:
        raise ValueError(f"more than {most_labels} languages")
    df, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    if not labels:
        return LanguageModel([], idf, np.zeros((DIM, 0)), 1.0)
    chosen = bounded_sample(docs, per_label, "label")

    def extract(batches):
        for b in batches:
            found = [(at.astype("<i4").tobytes(), _weights(at, c, idf).astype("<f4").tobytes()) for _, at, c in gram_counts(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_h"), b.column("label"), pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], ["_h", "label", "at", "x"])

    def fit(batches):
        rows = []
        for b in batches:
            for label, at, x in zip(*(b.column(c).to_pylist() for c in ("label", "at", "x")), strict=True):
                if at:
                    rows.append((labels.index(label), np.frombuffer(at, "<i4"), np.frombuffer(x, "<f4").astype(float)))
        aside, learn = rows[::5], [r for i, r in enumerate(rows) if i % 5]
        weights = train_ftrl(learn or aside, len(labels))
        scores = np.array([r[2] @ weights[r[1]] for r in aside]).reshape(-1, len(labels))
        t = fit_temperature(scores, np.array([r[0] for r in aside])) if aside else 1.0
        yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f4").tobytes()], "temperature": [t]})

    sample = materialize(chosen.select("_h", "label", "text").mapInArrow(extract, "_h long, label string, at binary, x binary"), "language-sample")
    # A bounded sample: one task fits it, in an order that doesn't depend on how the rows were dealt.
    got = sample.repartition(1).sortWithinPartitions("_h", "label").mapInArrow(fit, "weights binary, temperature double").first()
    weights = np.frombuffer(got.weights, "<f4").reshape(DIM, len(labels))
    return LanguageModel(labels, idf, weights, got.temperature)


def identify_languages(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = 1500) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; learns from rows where learnable holds and the label is not null.

    A text that is null or has no letter gets `und` with score 0. Ids and labels never enter a prediction.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"), learnable.alias("learnable"))
    model = train_language_model(rows.filter("learnable and label is not null").select("doc_id", "text", "label"), per_label)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            labels, scores = shared.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
