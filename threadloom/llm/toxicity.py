"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

Features of a text are its words and the first 3 to 9 bytes of longer words (words are runs of letters after lower-casing
A-Z), hashed to 2^20, and a few patterns: surface ones, and whether any word of the seed lexicon occurs. On a bounded
sample of learnable labelled rows (at most about `max_rows`, by a hash of the id) one task
1. takes as lexicon voters the seed words and the features that stand in toxic rows far more often than in others, and as
   pattern voters the surface patterns; a voter votes or abstains, and frequent features that toxic rows nearly never
   have vote clean;
2. fits a generative model of votes and latent labels by expectation-maximisation: each voter's rate on either class, the
   given label as one more noisy voter, and the voters' correlations within classes, which share out the say of voters
   that repeat each other (a word and its own prefixes);
3. trains a logistic regression on the posterior labels, over all voters and the features nearest to them;
4. calibrates its margin on margins of labelled rows kept aside, a quarter at a time.
Scoring is one pass over whole texts: the weights of the distinct features of a text are added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import Hasher, blocks, mix, word_bounds, word_bytes
from .common import bounded_sample, joinable, materialize, slices

BITS = 20
DIM = 1 << BITS
TABLE = word_bytes(digits=False)
PREFIXES = tuple(range(3, 10))
#: Seed lexicon; a parameter. The voters' rates are estimated, so a useless or missing word does no harm.
SEEDS = ("idiot", "moron", "scum", "clown", "trash", "loser", "stupid", "worthless", "pathetic", "disgusting", "dumb", "fool", "filth", "vermin", "garbage", "jerk", "creep", "imbecile", "cretin", "parasite")
PATTERNS = ("shouting", "exclaiming", "masked", "seeded")


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _patterns(text: bytes) -> list[int]:
    """Buckets, from DIM on, of the surface patterns of a text: mostly capitals, runs of '!', letters masked by '*'."""
    data = np.frombuffer(text, np.uint8)
    upper, lower = ((data >= 65) & (data <= 90)).sum(), ((data >= 97) & (data <= 122)).sum()
    return [DIM + k for k, on in enumerate((upper > lower, b"!!" in text, b"**" in text)) if on]


def features(texts: list[bytes], seeds: np.ndarray):
    """(row numbers, buckets) of all features, repeats included, for blocks of texts. seeds: buckets of the seed words."""
    seeded = np.zeros(DIM, bool)
    seeded[seeds] = True
    for i, j, data, starts in blocks(texts):
        s, e = word_bounds(data, TABLE)
        doc = np.searchsorted(starts, s, side="right") - 1 + i
        hasher = Hasher(data)
        words = _bucket(hasher.hash(s, e))
        hits = np.unique(doc[seeded[words]])
        rows, buckets = [doc, hits], [words, np.full(len(hits), DIM + PATTERNS.index("seeded"))]
        for k in PREFIXES:
            longer = e - s > k
            doc, s, e = doc[longer], s[longer], e[longer]
            rows.append(doc)
            buckets.append(_bucket(mix(hasher.hash(s, s + k) ^ np.uint64(k))))
        for r in range(i, j):
            if found := _patterns(texts[r]):
                rows.append(np.full(len(found), r))
                buckets.append(np.array(found))
        yield np.concatenate(rows), np.concatenate(buckets)


def distinct(rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(rows * (DIM + len(PATTERNS)) + buckets)
    return key // (DIM + len(PATTERNS)), key % (DIM + len(PATTERNS))


def seed_buckets(words: tuple[str, ...]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.int64)
    _, _, data, starts = next(blocks([w.encode() for w in words]))
    return _bucket(Hasher(data).hash(starts[:-1], starts[1:] - 1))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def choose_voters(rows, buckets, y, seeds, most: int = 600, calm_most: int = 40) -> np.ndarray:
    """Lexicon voters: buckets with enough toxic rows, nearly all of their rows toxic; seeds that occur; all patterns; and
    voters for clean: the most frequent buckets that toxic rows nearly never have.

    Of buckets that stand in the very same rows (a word and its own prefixes) one votes, so that rarer stems get a seat.
    """
    width = DIM + len(PATTERNS)
    toxic = np.bincount(buckets, weights=y[rows], minlength=width)
    clean = np.bincount(buckets, weights=1 - y[rows], minlength=width)
    p, n = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    lift = np.log((toxic + 0.5) / p) - np.log((clean + 0.5) / n)
    good = np.flatnonzero((toxic >= max(3, 0.004 * p)) & (toxic / (toxic + clean + 1e-9) >= 0.75) & (lift > 2))
    same = np.bincount(buckets, weights=np.random.default_rng(1).random(len(y))[rows], minlength=width)
    good = good[np.unique(same[good], return_index=True)[1]]
    best = good[np.argsort(-(toxic[good] * lift[good]), kind="stable")][:most]
    calm = np.flatnonzero((clean >= max(8, 0.02 * n)) & (toxic <= 0.25 * clean * p / n))
    calm = calm[np.argsort(-clean[calm], kind="stable")][:calm_most]
    return np.unique(np.concatenate([best, calm, seeds[toxic[seeds] + clean[seeds] > 0], np.arange(DIM, width)]))


def label_model(votes: np.ndarray, y: np.ndarray, rounds: int = 15):
    """(posterior of toxic for each row, say of each voter) by EM; starts from the given labels, which vote as well."""
    q, say = np.clip(y.astype(float), 0.02, 0.98), np.ones(votes.shape[1])
    for _ in range(rounds):
        a = (q @ votes + 0.2) / (q.sum() + 2)
        b = ((1 - q) @ votes + 0.02) / ((1 - q).sum() + 2)
        sure = np.clip([(q @ y + 1) / (q.sum() + 2), ((1 - q) @ y + 1) / ((1 - q).sum() + 2)], 0.01, 0.99)
        prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
        inside = (votes - np.outer(q, a) - np.outer(1 - q, b)) / np.sqrt(np.outer(q, a * (1 - a)) + np.outer(1 - q, b * (1 - b)) + 1e-6)
        linked = np.clip(inside.T @ inside / len(votes), 0, 1)
        np.fill_diagonal(linked, 0)
        say = 1 / (1 + np.where(linked > 0.2, linked, 0).sum(1))
        on, off = say * np.log(a / b), say * np.log((1 - a) / (1 - b))
        given = np.where(y == 1, np.log(sure[0] / sure[1]), np.log((1 - sure[0]) / (1 - sure[1])))
        q = _sigmoid(np.log(prior / (1 - prior)) + votes @ (on - off) + off.sum() + given)
    return q, say


def fit_logistic(rows, columns, n, k, target, l2: float = 0.2, steps: int = 300):
    """Weights and bias of a logistic regression with soft targets on 0/1 features (row, column pairs), by Adagrad."""
    w, bias, seen, seen_bias = np.zeros(k), 0.0, np.full(k, 1e-6), 1e-6
    for _ in range(steps):
        error = _sigmoid(np.bincount(rows, weights=w[columns], minlength=n) + bias) - target
        g = np.bincount(columns, weights=error[rows], minlength=k) + l2 * w
        seen, seen_bias = seen + g * g, seen_bias + error.sum() ** 2
        w, bias = w - 0.5 * g / np.sqrt(seen), bias - 0.5 * error.sum() / np.sqrt(seen_bias)
    return w, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from margin to label, by Newton steps with a weak pull to slope 1."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * margin + b)
        r, v = p - y, p * (1 - p) + 1e-9
        g = np.array([r @ margin + (a - 1), r.sum()])
        h = np.array([[(v * margin) @ margin + 1, v @ margin], [v @ margin, v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return max(a, 0.05), b


class ToxicityModel:
    def __init__(self, weights: np.ndarray, slope: float, offset: float, seeds: np.ndarray):
        self.weights, self.slope, self.offset, self.seeds = weights, slope, offset, seeds

    def score(self, texts: list[bytes]) -> np.ndarray:
        margin = np.zeros(len(texts))
        for rows, buckets in features(texts, self.seeds):
            used = self.weights[buckets] != 0
            r, b = distinct(rows[used], buckets[used])
            margin += np.bincount(r, weights=self.weights[b], minlength=len(texts))
        return _sigmoid(self.slope * margin + self.offset)


def fit_weights(rows, buckets, y, seeds) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the bias: voters, posterior labels, and the classifier over voters and features near them."""
    width = DIM + len(PATTERNS)
    voters = choose_voters(rows, buckets, y, seeds)
    column = np.full(width, -1)
    column[voters] = np.arange(len(voters))
    votes = np.zeros((len(y), len(voters)))
    hit = column[buckets] >= 0
    votes[rows[hit], column[buckets[hit]]] = 1
    q, _ = label_model(votes, y)
    toxic = np.bincount(buckets, weights=q[rows], minlength=width)
    all_ = np.bincount(buckets, minlength=width)
    near = np.flatnonzero((all_ >= 4) & (toxic / np.maximum(all_, 1) >= 0.8))
    used = np.unique(np.concatenate([voters, near]))
    column[:] = -1
    column[used] = np.arange(len(used))
    keep = column[buckets] >= 0
    w, bias = fit_logistic(rows[keep], column[buckets[keep]], len(y), len(used), q)
    weights = np.zeros(width, np.float32)
    weights[used] = w
    return weights, float(bias)


def fit_model(rows, buckets, y, seeds, folds: int = 4) -> ToxicityModel:
    """From distinct (row, bucket) pairs and 0/1 labels of the sample's rows. The curve from margin to score is fitted on
    margins of rows that the weights had not seen, fold by fold; the weights themselves are fitted on all rows."""
    n, width = len(y), DIM + len(PATTERNS)
    if n < 10 or y.min() == y.max():
        rate = np.clip((y.sum() + 0.1) / (n + 1), 0.01, 0.99)
        return ToxicityModel(np.zeros(width, np.float32), 1.0, float(np.log(rate / (1 - rate))), seeds)
    margin = np.zeros(n)
    for k in range(folds):
        aside = np.arange(n) % folds == k
        if not 0 < y[~aside].sum() < (~aside).sum():
            continue
        learn, number = ~aside[rows], np.cumsum(~aside) - 1
        weights, bias = fit_weights(number[rows[learn]], buckets[learn], y[~aside], seeds)
        margin[aside] = np.bincount(rows[~learn], weights=weights[buckets[~learn]], minlength=n)[aside] + bias
    slope, offset = calibrate(margin, y)
    weights, bias = fit_weights(rows, buckets, y, seeds)
    return ToxicityModel(weights, float(slope), float(slope * bias + offset), seeds)


def train_toxicity(docs: DataFrame, max_rows: int = 6_000, seeds: tuple[str, ...] = SEEDS) -> ToxicityModel:
    """From docs(doc_id, text, toxic 0/1). Two labels of one id are two rows; at most max_rows rows, distinct in id, text and label, whatever
    the ids."""
    lexicon = seed_buckets(seeds)
    chosen = bounded_sample(docs, max_rows, by=("doc_id", "text", "toxic"))

    def extract(batches):
        for b in slices(batches):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            own = [np.zeros(0, np.int64)] * len(texts)
            for rows, buckets in features(texts, lexicon):
                r, c = distinct(rows, buckets)
                for k, part in zip(np.unique(r).tolist(), np.split(c, np.flatnonzero(np.diff(r)) + 1), strict=True) if len(r) else ():
                    own[k] = part
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_h"), b.column("toxic"), pa.array([x.astype("<i4").tobytes() for x in own], pa.binary())], ["doc_id", "_h", "toxic", "buckets"])

    def fit(batches):
        y, parts = [], []
        for b in batches:
            y += b.column("toxic").to_pylist()
            parts += [np.frombuffer(x, "<i4") for x in b.column("buckets").to_pylist()]
        rows = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        model = fit_model(rows, np.concatenate([*parts, np.zeros(0, "<i4")]), np.array(y, np.int64), lexicon)
        at = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pydict({"at": [at.astype("<i4").tobytes()], "w": [model.weights[at].astype("<f4").tobytes()], "slope": [model.slope], "offset": [model.offset]})

    rows = chosen.select("doc_id", "_h", F.col("text").cast("binary").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    sample = materialize(rows.mapInArrow(extract, "doc_id long, _h long, toxic int, buckets binary"), "toxicity-sample")
    if sample.isEmpty():
        return fit_model(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), lexicon)
    # A bounded sample: one task fits it, in an order that doesn't depend on how the rows were dealt.
    got = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "toxic", "_h").mapInArrow(fit, "at binary, w binary, slope double, offset double").first()
    weights = np.zeros(DIM + len(PATTERNS), np.float32)
    weights[np.frombuffer(got["at"], "<i4")] = np.frombuffer(got.w, "<f4")
    return ToxicityModel(weights, got.slope, got.offset, lexicon)


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> ToxicityModel:
    """Labels other than 0 and 1, null ids and labels of unknown ids are left out; equal labels of an id are one. About max_rows labels are
    drawn by a hash of their ids, broadcast where counted to be small; an id on many rows of docs can't exceed twice that number
    of rows (bounded_sample)."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    marked = materialize(marked.filter(~held_out(F.col("doc_id"))).distinct(), "labels")
    n = marked.count()
    most = options.pop("max_rows", 6_000)
    # Thin the labels before the join, so that only the sample's texts move.
    marked = marked.filter(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 40)).cast("double") < min(1.0, most / max(1, n)) * float(1 << 40))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return train_toxicity(texts.join(joinable(marked), "doc_id"), max_rows=max(most * 2, 1), **options)


def held_out(doc_id: Column) -> Column:
    from .common import crc_remainder

    return crc_remainder(doc_id, 3) == 1


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            scores = shared.value.score([t or b"" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with the same columns, without the rows whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, text=text_col):
            texts = [(t or "").encode() for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            yield b.filter(pa.array(shared.value.score(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
