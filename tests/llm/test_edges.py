"""Edge cases of the training-data operators: repeated ids, nulls, empty tables, clashing columns, long texts, large groups."""

import hashlib
import io
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("threadloom.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_minhash import brute_near
from tests.llm.test_operators import TEXTS, brute_contamination, frame
from threadloom.llm import chat, decontam, exact_dedup, minhash, packing, secrets, simhash, toxicity, warc, wavelet
from threadloom.llm.registry import tokenizer_path
from threadloom.llm.tokens import PieceEncoder

NAMES = [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)]


@pytest.mark.parametrize("name,words", NAMES)
def test_ids_are_those_of_an_untouched_tokenizer(name, words):
    from tokenizers import Tokenizer

    texts = [t or "" for t in TEXTS] + ["<|endoftext|>", "a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|> <|endoftext", "<| endoftext |>", "plain  é text\n"]
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)]
    got = PieceEncoder(tokenizer_path(name), words).ids(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == want


def test_token_outputs_of_null_and_repeated_ids(spark):
    rows = frame(spark, ["one two", "one two", "three", "four"], [5, 5, 5, None])
    got = wavelet.token_output(rows, tokenizer_path("word_bpe_49k.json")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 5, 5, 5] and [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    assert wavelet.token_output(rows.limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0
    pieces = packing.pack_documents(rows, tokenizer_path("byte_bpe_50k.json")).collect()
    assert sorted(str(p.doc_id) for p in pieces) == ["5", "5", "5", "None"]


def test_exact_dedup_reads_survivors_only_and_keeps_other_texts_of_an_id(spark):
    rows = frame(spark, ["aaa bbb", "AAA bbb", "a text of its own", "lone", "aaa bbb"], [5, 7, 5, 9, None])
    found = exact_dedup.exact_dedup(rows, digest_all=False).collect()
    assert {r.doc_id for r in found if r.text_sha256} == {5, 7, None} and sum(r.text_sha256 is not None for r in found) == 3
    kept = exact_dedup.drop_exact_copies(rows)
    assert kept.columns == rows.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == [(5, "a text of its own"), (7, "AAA bbb"), (9, "lone")]
    assert exact_dedup.exact_dedup(rows.limit(0)).count() == 0


def test_stages_keep_other_texts_of_an_id(spark):
    rng = random.Random(3)
    long = [" ".join(f"w{rng.randrange(500)}" for _ in range(120)) for _ in range(3)]
    rows = frame(spark, [long[0], long[0] + " tail", long[1], long[2], long[1] + " end", long[2]], [1, 2, 2, 2, 3, None])
    kept = corpus_pipeline.STAGES[2][1](spark, rows, "").collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", long[0]), ("2", long[1]), ("2", long[2]), ("None", long[2])])
    renamed = rows.withColumns({c: F.lit("clash") for c in ("node", "keys", "grams", "text_hash", "bucket", "item", "_gone_id", "component")})
    for _, stage in (corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[2]):
        assert stage(spark, renamed, "").columns == renamed.columns and stage(spark, renamed.limit(0), "").count() == 0


def test_fingerprints_are_nodes(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    got = simhash.simhash_components(frame(spark, [a, b, b, c, c], [5, 5, 8, 9, 8])).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(r.fingerprint, set()).add((r.doc_id, r.component_id))
    assert sorted(map(sorted, by_text.values())) == [[(5, 5)], [(5, 5), (8, 5)], [(8, 8), (9, 8)]]


def test_fingerprints_that_differ_in_three_bytes_only(spark):
    """Lists of five equal bytes that are too long are refined by groups of the 24 bits left."""
    rng = random.Random(4)
    fps = {0xF00F << 40 | sum(rng.choice([0, 1, 2, 4, 8, 64, 129]) << 8 * i for i in (0, 3, 7)) for _ in range(60)}
    rows = list(enumerate(sorted(fps)))
    nodes = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in rows], "node long, fp long")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.near_links(nodes, 1).collect()}
    assert got == {(i, j) for i, a in rows for j, b in rows if i < j and (a ^ b).bit_count() <= 3} and len(got) > 50


def test_near_copies_of_a_large_loose_group(spark, monkeypatch):
    """Copies of one text with many edits: most pairs are below 0.8, and the rest hangs together over few links."""
    rng = random.Random(9)
    base, texts = [f"w{i}" for i in range(150)], []
    for _ in range(160):
        own = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 7])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    monkeypatch.setattr(minhash, "SHARE", 5)
    part = brute_near(texts)
    got = {r.doc_id: (r.component_id, r.kept) for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    assert {i: got.get(i, (i, True)) for i in range(len(texts))} == {i: (p, p == i) for i, p in enumerate(part)} and len(set(part)) > 5


def test_a_rewriting_template_is_written_as_its_own_output(spark):
    def forgetful(messages):
        return "".join(f"[{r}:{t if i == len(messages) - 1 else '...'}]" for i, (r, t) in enumerate(messages))

    rows = spark.createDataFrame([(1, t, ("user", "assistant")[t % 2], f"text {t}") for t in range(6)], "conv_id long, turn long, role string, text string")
    [got] = chat.format_chats(rows, template=forgetful).collect()
    turns = [(("user", "assistant")[t % 2], f"text {t}") for t in range(6)]
    assert got.formatted == forgetful(turns) and got.rewritten
    assert [got.formatted[s:e] for s, e in zip(got.text_start, got.text_end, strict=True)] == [""] * 5 + ["text 5"]
    assert got.turn_start == sorted(got.turn_start)

    def numbered(messages):
        return "".join(f"{i}:{r}:{t};" for i, (r, t) in enumerate(messages))

    many = [(2, t, "user", f"é{t}") for t in range(700)]
    pieces = chat.format_chats(spark.createDataFrame(many, "conv_id long, turn long, role string, text string"), template=numbered).orderBy("piece").collect()
    assert "".join(p.formatted for p in pieces) == numbered([(r, x) for _, _, r, x in many]) and not any(p.rewritten for p in pieces)


def test_archives_are_streams(spark):
    rng = random.Random(0)
    for step in (1, 7, 1000):
        parts = [bytes(rng.choice(b"ab\n") for _ in range(rng.choice([0, 1, 5, 3000]))) for _ in range(12)]
        data, plain = warc.Unpacked(io.BytesIO(b"".join(map(warc._member, parts))), step), io.BytesIO(b"".join(parts))
        while True:
            n = rng.randrange(-2000, 2000)
            want = plain.read(n) if n > 0 else plain.readline()
            assert (data.read(n) if n > 0 else data.readline()) == want
            if not want and n:
                break
    with pytest.raises(EOFError):
        warc.Unpacked(io.BytesIO(warc._member(b"abc" * 1000)[:-5])).read(10000)


def test_archives_of_long_and_repeated_pages(spark, monkeypatch):
    monkeypatch.setattr(warc.write_arc, "__defaults__", (*warc.write_arc.__defaults__[:-1], 1_000_000))
    long = "<p>é" + "word " * 2_000_000
    rows = [(1, "u", long), (2, "u", long), (3, "v", "x" * 150), (3, "v", "x" * 150), (None, None, None)]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = {(i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows}
    assert len(got) == 5 and {(r.page_id, r.payload_bytes, r.payload_digest) for r in got} == want
    assert sorted((r.record_type, r.refers_to or 0) for r in got if r.page_id == 3) == [("response", 0), ("revisit", 3)]


def test_a_wrong_checksum_is_refused():
    body = warc.arc_record("http://x/", "20010203040506", 3, b"one", 2, "f.arc", 9)
    [(fields, _)] = list(warc.parse_arc(warc.arc_version_block("f.arc", 2, "20010203040506") + body))
    warc.check_payload(fields, b"one")
    with pytest.raises(ValueError):
        warc.check_payload(fields, b"two")


def test_test_items_without_an_id_and_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam.prepare_phrases, "__defaults__", ("item_id", "text", 60))
    monkeypatch.setattr(decontam, "KEEP_BYTES", 1)
    phrase = " ".join(f"p{i}" for i in range(12))
    items = [(None, phrase), (4, "q0 q1 q2"), (4, "q0 q1 q2"), (4, "r0 r1 r2"), (None, None), (None, "q0 q1 q2")]
    texts = [f"a {phrase} b", "q0, q1; Q2 r0 r1 r2", None, "", "word " * 300_000 + "q0 q1 q2"]
    df, bench = frame(spark, texts + texts[:1], [0, 1, 2, 3, 4, 0]), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(df, bench).collect()
    assert len(got) == 6
    for r in got:
        n, hit, found = brute_contamination(texts[r.doc_id] if r.doc_id < 4 else "q0 q1 q2", [(-1 if i is None else i, t) for i, t in items])
        assert (r.n_hit, r["items"]) == (hit, [i for i in found if i >= 0]) and (r.doc_id == 4 or r.n_words == n)
    clean = {r.doc_id: r.text for r in decontam.remove_contamination(df, bench).collect()}
    assert clean[0] == "a  b" and 1 not in clean and clean[2] is None and clean[3] == ""


def test_secrets_of_null_and_repeated_ids(spark):
    text = f"AKIA{'Q' * 16} and abcdEFGH0123+/abcdEFGH0123+/abcdEFGH0123"
    rows = frame(spark, [text, text, text, "plain"], [1, 1, None, None])
    got = secrets.secret_report(secrets.scan_secrets(rows)).collect()
    assert sorted((str(r.doc_id), "secret:" in r.spans) for r in got) == [("1", True), ("1", True), ("None", False), ("None", True)]
    assert secrets.secret_report(secrets.scan_secrets(rows.limit(0))).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no driver tables here")
def test_toxicity_on_held_out_rows_of_the_driver_tables(spark):
    """Some labels of these tables are noise (toxic rows of plain text), which bounds the recall."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in found)
    assert hit / sum(r.predicted for r in found) > 0.95 and hit / sum(r.toxic for r in found) > 0.86
