"""Near copies against brute force over all pairs."""

import random

import pytest

pytest.importorskip("threadloom.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_operators import frame
from threadloom.llm import simhash


def brute_near(texts):
    """The smallest index reachable over pairs of 5-word similarity 0.8."""
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    part = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = [low if p == high else p for p in part]
    return part


def edited(rng):
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):  # copies of about 0.7 to 1, some of them of copies
            for _ in range(rng.randrange(1, 2 + len(base) // 35)):
                base[rng.randrange(len(base))] = f"w{rng.randrange(900)}"
            texts.append(" ".join(base))
    return [*texts, None, "", " \n", "one two", "One  two", "one two three"]


def test_near_stage_reaches_all_pairs_of_five_words_and_0_8(spark):
    texts = edited(random.Random(5))
    part = brute_near(texts)
    kept = {i for i, p in enumerate(part) if p == i}
    fps = [simhash.fingerprint((t or "").encode(), 3) for t in texts]
    far = [i for i in range(len(texts)) if i not in kept and all(((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() > 3 for j in range(i))]
    assert len(far) > 5  # the distance of op8_simhash misses these
    docs = frame(spark, texts).unionByName(frame(spark, [texts[0]], [None]))
    got = corpus_pipeline.STAGES[2][1](spark, docs, "")
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == kept | {None}
    assert corpus_pipeline.STAGES[2][1](spark, docs.limit(0), "").count() == 0


def test_pairs_that_share_no_band_of_minima(spark):
    """Pairs of exactly 0.8 (8 of 10 shingles) that no band of minima and no close fingerprint brings together."""
    texts = []
    for n in (56336, 10093747, 20075422, 50026599, 70093124):
        words = [f"{n}v{j}" for j in range(13)]
        texts += [" ".join(words), " ".join(words[:-1] + ["end"])]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_near(texts))) == {i: i - i % 2 for i in range(10)}


def test_prefixes_meet_whatever_the_order():
    import numpy as np

    from threadloom.llm import minhash

    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        both = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 62, int(rng.integers(0, n // 6 + 1)), dtype=np.uint64)])) for _ in range(2))
        known = np.unique(rng.permutation(np.union1d(a, b))[: int(rng.integers(0, 40))])
        order = known, np.arange(len(known)) % 3 + 4
        keys = [minhash.prefix_keys(s, order, 0.8) for s in (a, b)]
        shared = len(np.intersect1d(a, b))
        assert shared < 0.8 * len(np.union1d(a, b)) - 1e-9 or set(keys[0]) & set(keys[1])
    assert len(minhash.prefix_keys(np.arange(15, dtype=np.uint64), (np.zeros(0, np.uint64), np.zeros(0)), 0.8)) == 4


def test_marks_part_long_sets_and_keep_near_ones(spark):
    """Sets of thousands of shingles that have nothing in common are told apart by their marks; near ones stay, also where the lengths differ."""
    import numpy as np
    from pyspark.sql import functions as F

    from threadloom.llm import minhash

    rng, sets = np.random.default_rng(3), []
    for n in (300, 1000, 3000, 900):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        sets += [base, np.union1d(base, rng.integers(0, 1 << 63, n // 4, dtype=np.uint64))]  # a similarity of 0.8
    assert len({len(minhash.marks(s)) for s in sets[6:]}) == 2
    signed = spark.createDataFrame([(i, len(s), minhash.marks(s)) for i, s in enumerate(sets)], "node long, n long, marks array<long>")
    pairs = spark.createDataFrame([(a, b, a) for a in range(8) for b in range(8) if a != b], "a long, b long, cell long")
    got = {(r.a, r.b) for r in minhash._possible(pairs, signed, 0.8).collect()}
    assert got == {(i, i ^ 1) for i in range(8)}
    far = pairs.select("a", "b", "cell").filter("a = 0 and b = 5")
    assert minhash._possible(far, signed.withColumn("n", F.lit(100).cast("long")), 0.8).count() == 1  # lengths too far apart are left to the sets


def test_tables_leave_no_shuffles_behind(spark):
    import pathlib
    import time

    from threadloom.llm.common import FREED, materialize

    files = lambda: set(pathlib.Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*"))
    before, setting = files(), spark.conf.get(FREED, None)
    table = materialize(spark.range(1000).selectExpr("id % 50 as k").groupBy("k").count().repartition(3, "count"), "freed")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(FREED, None) == setting and table.count() == 50
