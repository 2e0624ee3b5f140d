"""Periodic runs, BPE by SQL and hard negatives against brute force and an untouched library, with nulls, repeats, ties and empty tables."""

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("threadloom.llm")

from tests.llm.test_operators import TEXTS, frame
from threadloom.llm import bpe_sql, hard_negatives, periodic
from threadloom.llm.registry import tokenizer_path


def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, times * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    alphabet = [b"w%d" % k for k in range(rng.choice([1, 2, 3, 5, 40]))]
    words = [rng.choice(alphabet) for _ in range(rng.randrange(0, 200))]
    for _ in range(rng.randrange(0, 4)):
        unit = [rng.choice(alphabet) for _ in range(rng.randrange(1, 30))]
        words += (unit * rng.randrange(0, 8))[: rng.randrange(0, 200)] + [rng.choice(alphabet) for _ in range(rng.randrange(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    docs = [some_words(rng) for _ in range(25)]
    docs += [docs[0]] * 3 + [[], [b"a"] * 23, [b"a"] * 24, [b"a", b"b"] * 40 + [b"a"]]
    for least, times in ((24, 3), (30, 4)):
        got = periodic.find_runs(docs, least, times)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(d, least, times) for d in docs]


def test_grammar_agrees_with_words():
    rng = random.Random(9)
    words = np.array([-1, *(rng.choice([1, 1, 1, 2, 3]) for _ in range(3000)), *[7] * 500, *([4, 5] * 300), -2])
    grammar = periodic.Grammar(words, 3)
    i = np.array([rng.randrange(1, len(words) - 2) for _ in range(2000)])
    j = np.minimum(i + np.array([rng.randrange(1, 40) for _ in range(2000)]), len(words) - 1)
    for step in (1, -1):
        want = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            n = 0
            while words[a + step * n] == words[b + step * n]:
                n += 1
            want.append(n)
        assert grammar.agree(i, j, step).tolist() == want


def test_run_query_against_brute_force(spark):
    rng = random.Random(4)
    texts = [*TEXTS, *(" \t".join(w.decode() for w in some_words(rng)) + "\n" for _ in range(120)), "long " * 30_000, "a b c d " * 30]
    rows = frame(spark, texts, [None, *range(1, len(texts))])
    got = {r.doc_id: r for r in periodic.run_report(periodic.periodic_runs(periodic.plant_periods(rows))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, words = got[i or None], (t or "").encode().split()
        h = zlib.crc32(str(i).encode() if i else b"")
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = brute_runs(words) if len(set(words)) > 1 else [(0, len(words), 1)] * (len(words) >= 24)
        assert r.n_runs == len(runs)
        best = None
        for s, length, q in runs:
            if best is None or length * best[2] > best[1] * q:
                best = (s, length, q)
        assert (r.start, r.length, r.period) == (best or (None,) * 3) and r.exponent_milli == (best and 1000 * best[1] // best[2])
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()
    assert periodic.run_report(periodic.periodic_runs(periodic.plant_periods(rows.limit(0)))).count() == 0
    twice = periodic.periodic_runs(frame(spark, ["x " * 30, "x " * 30], [5, 5])).collect()
    assert [(r.doc_id, len(r.runs), r.collapsed) for r in twice] == [(5, 1, "x")] * 2


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_by_sql_equals_the_library(spark, library):
    import public_tokenizers

    rng = random.Random(1)
    long = ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (12, 47, 48, 49, 100, 700)] + ["a" * n for n in (47, 48, 49, 4096, 20_000)]
    texts = [*TEXTS, *long, "日本語のテキスト" * 40, "é" * 300, "=-" * 500, " " * 999, "\n\n  \t" * 30, "x" * 49 + "é😀" * 30, "<|endoftext|> it's", "\x00\x01  　x", "theothertheanotherthis" * 20]
    path, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = frame(spark, texts).unionByName(frame(spark, ["again", "again", "no id"], [3, 3, None])).withColumn("decoded", F.lit("clash")).withColumn("ids", F.lit(1))
    got = bpe_sql.decode_documents(bpe_sql.encode_documents(rows, path, pattern), path, pattern).collect()
    want = sorted((str(r.doc_id), library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in rows.collect())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want and all(r.n_tokens * 4 == len(r.ids) for r in got)
    digests = bpe_sql.round_trip(rows, path, pattern)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and digests.limit(0).count() == bpe_sql.round_trip(rows.limit(0), path, pattern).count() == 0
    assert {r.decoded_sha256 for r in digests.collect()} == {hashlib.sha256(t).hexdigest() for _, _, t in want}


def test_decoding_in_parts(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe_sql, "DECODE_TOKENS", 7)
    monkeypatch.setattr(bpe_sql, "KEEP", 5)
    monkeypatch.setattr(bpe_sql, "BATCH_BYTES", 20)
    codec = bpe_sql.SqlBpe(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["", "one two three four five six seven eight nine ten é😀", "x", "", "Lorem ipsum dolor sit amet " * 9]
    for _ in range(2):
        ids = codec.encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
        assert codec.decode(ids) == [t.encode() for t in texts]


def brute_negatives(rows, every=100, positives=5, negatives=10):
    rows = [(k, i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, y, v) in enumerate(rows) if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, y, v in rows:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), math.inf if j is None else j, m, j, z) for m, j, z, w in rows if m != k)
        for s, _, _, p, z in [x for x in scored if x[4] == y][:positives]:
            fits = [x for x in scored if x[4] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, p, rank, x[3], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,spread,block", [(1, 0.2, 4096), (2, 0.2, 16), (3, 1e6, 64), (4, 0.02, 64)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, seed, spread, block):
    for name, value in (("ROWS", block), ("QUERIES", max(2, block // 8)), ("CHUNK", block * 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(700):
        c = centres[rng.randrange(4)]
        rows.append((i % 650, rng.randrange(4), [x + rng.gauss(0, spread / 2) for x in c]))
    rows += [(1000 + i, i % 3, centres[0]) for i in range(150)]  # ties
    rows += [(None, 1, centres[1]), (100, None, centres[1]), (200, 1, None), (300, 2, [None, 1.0]), (400, 2, [math.nan]), (500, 2, [math.inf]), (600, 1, []), (700, 1, [0.5]), (800, 0, [0.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({c: F.lit("clash") for c in ("row", "vector", "query", "window", "score", "rank", "windows")})
    got = hard_negatives.mine_hard_negatives(hard_negatives.whole_vectors(df)).collect()
    order = {tuple(r): None for r in got}
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows) and order
    assert hard_negatives.mine_hard_negatives(hard_negatives.whole_vectors(df.limit(0))).count() == 0
