"""The training-data operators against brute force, on small tables with nulls, empties, repeats, ties and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("threadloom.llm")

from threadloom.llm import chat, decontam, exact_dedup, langid, packing, secrets, simhash, toxicity, warc, wavelet
from threadloom.llm.common import ascii_lower, new_path
from threadloom.llm.registry import tokenizer_path
from threadloom.llm.tokens import PieceEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, component_id string, fp string, path string"
TEXTS = [
    "The cat sat on the mat and looked at the other cat.", "the CAT sat on the mat and looked at the other cat.", None, "", "   ", "Été à Paris\n\nun été", "ÉTÉ à paris\n\nun été", "x", "word " * 5000,
    "token = \"0123456789abcdef0123456789abcdef01234567\"", "日本語のテキスト and more  double  spaces", "a b c d e f g h i j k l m n o p", "zz a b c d e f g h i j k l zz a b c d e f g h i j yy",
]


def frame(spark, texts=TEXTS, ids=None):
    rows = [(i, t, None, "s", None, "clash", "clash", "clash", "clash", "clash") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).unionByName(frame(spark, ["a repeated row", "a repeated row"], [100, 100])).unionByName(frame(spark, ["no id"], [None]))


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_ascii_lower(spark):
    rows = spark.createDataFrame([("ÀÉ Ab",), ("AbZ",)], "t string").select(ascii_lower(F.col("t")).alias("x")).collect()
    assert sorted(r.x for r in rows) == sorted(["ÀÉ ab", "abz"])


@pytest.mark.parametrize("every", [True, False])
def test_exact_dedup(docs, every):
    rows = docs.select("doc_id", "text").collect()
    found = exact_dedup.exact_dedup(docs, digest_all=every).collect()
    groups = {}
    for r in rows:
        groups.setdefault(low(r.text or ""), []).append(r.doc_id)
    want = sorted(((i, max([x for x in ids if x is not None], default=None), len(ids)) for ids in groups.values() for i in ids), key=str)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    if every:
        assert {r.text_sha256 for r in found} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}


def test_exact_dedup_many_groups_take_the_shuffle_path(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "joinable", lambda df, rows=0: df)
    df = frame(spark, [f"text {i % 40}" for i in range(120)])
    for every in (True, False):
        found = exact_dedup.exact_dedup(df, digest_all=every).collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(i, 80 + i % 40, 3) for i in range(120)}


def brute_spans(text):
    out = []
    kinds = {"assign": r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    for k, (name, p) in enumerate(kinds.items()):
        for m in re.finditer(p, text):
            if {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[name]():
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


def test_secret_scan(spark):
    key, weak = "AKIA" + "Q" * 16, "abcdEFGH0123+/abcdEFGH0123+/abcdEFGH0123"
    texts = [
        *TEXTS, f"é😀 {key} and {weak} at https://s3.example.com/x", f"only {weak} here", f"{key}{' pad' * 200} {weak}", "token=token: abcdefgh PassWord='hunter22' api_key: x", "AKIA12 " + key + "9", "é" * 50 + "f" * 24 + " " + "a" * 23,
        "\n".join(f'secret = "value{i:06d}"' for i in range(300)), f"password: abcdef1 see http://db.example/ {weak}", "http://nothing.example",
    ]
    got = {r.doc_id: r for r in secrets.secret_report(secrets.scan_secrets(frame(spark, texts))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        spans = brute_spans(t or "")
        joined = ",".join(f"{n}:{a}:{e}" for a, _, e, n in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex"))
        assert {f"{n}:{a}:{e}" for a, _, e, n in spans} <= set(filter(None, got[i].spans.split(",")))
    n = len(TEXTS)
    assert "secret:" in got[n].spans and "endpoint:" in got[n].spans
    assert "secret:" not in got[n + 1].spans and "secret:" not in got[n + 2].spans
    assert "endpoint:" in got[n + 7].spans and "secret:" not in got[n + 7].spans and "endpoint:" not in got[n + 8].spans


def test_secret_right_after_an_equals_sign(spark):
    weak = "abcdEFGH0123+/abcdEFGH0123+/abcdEFGH0123"
    env = f"AWS_ACCESS_KEY_ID=AKIA{'Q' * 16}\nAWS_SECRET_ACCESS_KEY={weak}\n"
    got = secrets.secret_report(secrets.scan_secrets(frame(spark, [env, f"KEY={weak}", f"{env[:38]} KEY={weak}x"]))).orderBy("doc_id").collect()
    assert got[0].spans == f"access:18:38,secret:{env.index(weak)}:{env.index(weak) + 40}"
    assert got[1].spans == "" and "secret:" not in got[2].spans


ODD = ["a  b   c \n d", "x|y | z", " ", "", "\n\n a", "foo's 'tis ''s", "Σας ΣΑΣ", "é É İ ŉ", "日本 text", "áb", "<|endoftext|> hi", "tab\there\x1c\x85 x", "|", "| |", "$$$|||\n|x", "don't 'S 'LL", "1234 ½ ²", "a \n b", "end \n", "_a_ __b__"]


@pytest.mark.parametrize("name,words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoder_equals_the_library(name, words):
    enc, rng = PieceEncoder(tokenizer_path(name), words), random.Random(3)
    texts = ODD + [t or "" for t in TEXTS] + ["".join(rng.choice("ab é'\n .|s1") for _ in range(60)) for _ in range(300)]
    assert enc.ids(texts) == enc._whole(texts)
    assert enc.ids(texts) == enc._whole(texts)


def plain_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_wavelet_shards(spark):
    df, out = frame(spark), new_path(spark, "t")
    manifest = wavelet.write_wavelet_shards(df, out, tokenizer_path("word_bpe_49k.json"), shard_tokens=50)
    assert manifest.count() > 1
    got = {r.doc_id: r for r in wavelet.read_wavelet_shards(manifest, out).collect()}
    start = 0
    for i, ids in enumerate(plain_ids("word_bpe_49k.json", TEXTS)):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 3000])
def test_wavelet_matrix(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype(np.uint16) * 1200
    wm = wavelet.decode_shard(wavelet.encode_shard([1], [n], ids))[2]
    assert (wm.to_array() == ids).all() and (wm.access(np.arange(n)) == ids).all()
    for s in set(ids.tolist()[:3]) | {48001}:
        at = np.flatnonzero(ids == s)
        assert wm.count(s) == len(at) and (wm.select(s, np.arange(len(at))) == at).all()
        assert (wm.rank(s, np.arange(n + 1)) == np.concatenate(([0], np.cumsum(ids == s)))).all()


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, t, r, x, "clash") for t, (r, x) in enumerate([("user", said), ("assistant", said), ("user", None), ("assistant", ""), (None, "#### \\\\ </turn>"), ("assistant", "\\#\\")])]
    rows += [(2, t, "user" if t % 2 == 0 else "assistant", f"é{t}" * (t % 3), "clash") for t in range(700)] + [(None, 0, "user", "x", None), (3, 1, "assistant", "same", None), (3, 1, "assistant", "same", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.chat_report(df).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([(t, r or "", x or "") for c, t, r, x, _ in rows if c == conv])
        whole, loss = "".join(f"{r}\n{x}\n" for _, r, x in own), "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == len(chat.turn_template([(r, x) for _, r, x in own])) and not got[conv].rewritten
    assert chat.chat_report(df.limit(0)).count() == 0


def test_chat_escape():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice(["#", "\\", "<", "/", "</turn>", "###", "a", "turn>"]) for _ in range(rng.randrange(9)))
        assert chat.unescape(chat.escape(t)) == t and "</turn>" not in chat.escape(t) and "##" not in chat.escape(t)


def test_chat_finds_templates_that_rewrite_history():
    def forgetful(messages):  # shows the text of the last message only
        return "".join(f"[{r}:{t if i == len(messages) - 1 else '...'}]" for i, (r, t) in enumerate(messages))

    assert [t[-1] for t in chat.render_turns([("user", "one"), ("assistant", "two"), ("user", "x")], forgetful)] == [False, True, True]
    spans = list(chat.render_turns([("user", "one"), ("assistant", "a:a")], chat.turn_template))
    assert [s[1][s[2] : s[3]] for s in spans] == ["one", "a:a"]


def test_chat_templates_that_look_back_over_whole_conversations():
    def numbered(messages):
        return "".join(f"{i}:{r}:{t};" for i, (r, t) in enumerate(messages))

    def alternating(messages):
        assert [r for r, _ in messages] == ["user", "assistant"] * (len(messages) // 2) + ["user"] * (len(messages) % 2)
        return "".join(f"[{t}]" for _, t in messages)

    def late(messages):  # at the 21st turn the second one goes
        return "".join(f"[{t}]" for i, (_, t) in enumerate(messages) if i != 1 or len(messages) < 21)

    turns = [(("user", "assistant")[i % 2], f"text {i}") for i in range(25)]
    for template in (numbered, alternating, chat.turn_template):
        spans = list(chat.render_turns(turns, template))
        assert "".join(s[1] for s in spans) == template(turns) and not any(s[-1] for s in spans)
        assert [s[1][s[2] : s[3]] for s in spans] == [t for _, t in turns]
    assert [i for i, s in enumerate(chat.render_turns(turns, late)) if s[-1]] == [20]


def test_language_id(spark):
    rng = random.Random(5)
    words = {"en": ["the", "thing", "with", "other"], "de": ["der", "schön", "und", "keit"], "fr": ["le", "eaux", "été", "que"]}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(rng.randrange(3, 40))), g, None) for i, g in enumerate(rng.choices(list(words), k=400))]
    rows += [(1000, None, "en", None), (1001, "123 !!", "de", None), (1002, "", None, None), (1003, "der und der", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.identify_languages(df, F.col("doc_id") % 4 != 2).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    held = [r for r in rows[:400] if r[0] % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.97
    assert langid.identify_languages(df.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.identify_languages(df, F.lit(False)).collect()} == {"und"}


def test_language_id_temperature():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 4000)
    logits = rng.normal(size=(4000, 3))
    logits[np.arange(4000), y] += 1.0
    calibrated = langid.fit_temperature(logits * 5, y)
    assert 4 < calibrated < 7


def test_warc(spark):
    long = "<html>é" + "x" * 200
    rows = [(5, "http://a/ b", long, "c"), (3, None, long, "c"), (9, "u", long, "c"), (1, "v", "short", "c"), (2, "w", "short", "c"), (7, "x", None, "c"), (8, "y", "", "c"), (None, "n", long, "c"), (4, "z", "a\r\n\r\nb\n" + "q" * 100, "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    got = {r.page_id: r for r in warc.archive_pages(df).collect()}
    for i, _, h, _ in rows:
        data = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: (got[i].record_type, got[i].refers_to) for i in (5, 3, 9, 1, 2, 7, 4)} == {5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), 1: ("response", None), 2: ("response", None), 7: ("response", None), 4: ("response", None)}
    assert got[None].record_type == "revisit" and warc.archive_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    body = warc.arc_version_block("f.arc", version, "20010203040506") + warc.arc_record("http://x/ é", "20010203040506", 3, b"one\n\ntwo", version, "f.arc", 99)
    [(fields, got)] = list(warc.parse_arc(body))
    assert fields["Archive-date"] == "20010203040506" and " " not in fields["URL"] and len(fields) == (5 if version == 1 else 10)
    assert warc.http_parts(got)[1] == b"one\n\ntwo"
    with pytest.raises(ValueError):
        list(warc.parse_arc(body[:-6]))


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_contamination(text, items, size=10):
    words, hit, found = WORD.findall(low(text or "")), set(), set()
    for item, t in items:
        w = WORD.findall(low(t or ""))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            window = w[i : i + size]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


def test_decontamination(spark, monkeypatch):
    rng = random.Random(2)
    vocab = ["aa", "bb", "cc", "Dd", "éé", "x1"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 9, 10, 12, 25])))) for i in range(12)] + [(50, None), (51, "..."), (52, "b"), (53, "a b c d e f g h i j k")]
    texts = [*TEXTS, *[", ".join(rng.choice(vocab + ["zz"]) for _ in range(rng.randrange(120))) for _ in range(60)], *["-- " + (items[3][1].upper() if items[3][1].isascii() else items[3][1]) + " zz " * k for k in range(20)]]
    df = frame(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (4_000_000, 100):
        monkeypatch.setattr(decontam.prepare_phrases, "__defaults__", ("item_id", "text", block))
        got = {r.doc_id: r for r in decontam.contamination(df, bench).collect()}
        for i, t in enumerate(texts):
            assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute_contamination(t, items), (t, block)
    clean = {r.doc_id: r for r in decontam.remove_contamination(df, bench).collect()}
    for i, t in enumerate(texts):
        if got[i].n_hit == 0:
            assert clean[i].text == t
        elif i in clean:
            assert brute_contamination(clean[i].text, items)[1] == 0
        assert i in clean or got[i].n_hit
    assert decontam.contamination(df.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontam.contamination(df, bench.limit(0)).collect()} == {0}


def brute_components(fps):
    up = {i: i for i, _ in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return {i: find(i) for i, _ in fps}


def test_triples_meet_every_five_positions():
    from itertools import combinations

    assert all(any(set(t) <= set(five) for t in simhash.TRIPLES) for five in combinations(range(8), 5))


@pytest.mark.parametrize("hot", [2048, 20, 4])
def test_simhash_links(spark, hot):
    rng = random.Random(hot)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 90:  # a dense cluster, chains and lone ones
        x = base if rng.random() < 0.6 else rng.getrandbits(64)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.choice([3, 9, 17, 20, 33, 41, 50, 60])
        fps.add(x)
    rows = list(enumerate(sorted(fps)))
    nodes = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in rows], "node long, fp long")
    parts = {r.node: r.component for r in simhash.connected_components(simhash.near_links(nodes, hot)).collect()}
    assert {i: parts.get(i, i) for i, _ in rows} == brute_components(rows)


def test_simhash_of_texts(spark, docs):
    import xxhash

    def brute(t):
        w = re.findall("[^\x20\x09-\x0d]+", low(t or ""))
        if not w:
            return 0
        hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = [r for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    got = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    want = brute_components([(r.doc_id, brute(r.text)) for r in {r.doc_id: r for r in rows}.values()])
    for r in rows:
        assert got[r.doc_id].fingerprint == f"{brute(r.text):016x}" and got[r.doc_id].component_id == want[r.doc_id]
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def test_packing(spark):
    df = frame(spark)
    pieces = packing.pack_documents(df, tokenizer_path("byte_bpe_50k.json"), window=64, buffer=7).collect()
    want = plain_ids("byte_bpe_50k.json", TEXTS)
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    for i, ids in enumerate(want):
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == np.array(ids, "<u4").tobytes() and {p.doc_tokens for p in own} == {len(ids)}
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own[:-1]]))
    for own in by_seq.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0] + [p.length for p in own[:-1]])) and sum(p.length for p in own) <= 64
    assert packing.pack_documents(df.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_fullest_multiset_is_optimal():
    rng = random.Random(4)
    for _ in range(300):
        counts, room = {}, rng.randrange(1, 40)
        for _ in range(rng.randrange(8)):
            k = rng.randrange(1, 25)
            counts[k] = counts.get(k, 0) + 1
        sums = {0}
        for k, n in counts.items():
            sums |= {s + k * j for s in sums for j in range(n + 1)}
        used = packing.fullest_multiset(counts, room)
        assert all(used[k] <= counts[k] for k in used) and sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def test_packing_leaves_little_slack():
    rng = random.Random(6)
    lengths = [min(2047, int(rng.paretovariate(1.0) * 40)) for _ in range(3000)]
    windows = packing.fill_windows(lengths, 2048)
    assert sorted(i for w in windows for i in w) == list(range(3000)) and sum(lengths) / 2048 / len(windows) > 0.99


def toxic_rows(n, seed=8):
    rng = random.Random(seed)
    clean = [f"word{i}" for i in range(300)]
    bad = ["idiot", "moron", "grumpfen", "grumpfig", "grumpfer"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows(1500)
    rows += [(5000, None, "x"), (5001, "", "x"), (5001, "", "x"), (None, "idiot", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1), (9999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(df, marks)
    got = toxicity.score_toxicity(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    hit = sum(p and t for p, t in held)
    assert hit / max(1, sum(p for p, _ in held)) > 0.97 and hit / sum(t for _, t in held) > 0.9
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(not r.predicted for r in got)
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0
    blank = toxicity.learn_toxicity(df, marks.limit(0))
    assert {r.predicted for r in toxicity.score_toxicity(df, blank).collect()} == {0}


def test_label_model_shares_the_say_of_repeated_voters():
    rng = np.random.default_rng(3)
    y = (rng.random(2000) < 0.3).astype(int)
    one = ((rng.random(2000) < 0.8) & (y == 1)) | ((rng.random(2000) < 0.02) & (y == 0))
    other = ((rng.random(2000) < 0.8) & (y == 1)) | ((rng.random(2000) < 0.02) & (y == 0))
    _, say = toxicity.label_model(np.stack([one, one, other], 1).astype(float), y)
    assert say[0] < 0.7 and say[1] < 0.7 and say[2] > 0.8
