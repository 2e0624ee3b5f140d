"""Rows without ids, one id on many rows, repeated rows, and templates that don't keep their word."""

import random

from pyspark.sql import functions as F

from threadloom.llm import chat, common, exact_dedup, langid, simhash, toxicity

CHAT = "conv_id long, turn long, role string, text string"


def frame(spark, rows, schema="doc_id long, text string, label string"):
    return spark.createDataFrame(rows, schema)


def test_samples_keep_their_bound_and_each_label(spark):
    none = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("label"))
    one = spark.range(3_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("wort "), "id").alias("text"), F.lit("de").alias("label"))
    copies = spark.range(4_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("le même").alias("text"), F.lit("fr").alias("label"))
    few = frame(spark, [(1, "uno", "es"), (2, None, "es")])
    rows = none.unionByName(one).unionByName(copies).unionByName(few)
    found = {r.label: r["count"] for r in common.bounded_sample(rows, 300, "label").groupBy("label").count().collect()}
    assert found == {"en": 300, "de": 300, "fr": 1, "es": 2}
    again = common.bounded_sample(rows.repartition(7), 300, "label")
    assert {r.text for r in again.collect()} == {r.text for r in common.bounded_sample(rows, 300, "label").collect()}
    assert common.bounded_sample(rows, 500).count() == 500 and common.bounded_sample(rows.limit(0), 5, "label").count() == 0
    model = langid.train_language_model(rows, 200)
    assert model.labels == ["de", "en", "es", "fr"] and model.predict(["text 17", "wort 3"])[0] == ["en", "de"]


def test_labels_on_an_id_of_many_rows(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"w{n}" for n in range(40)]
    texts = [(5, " ".join(rng.choices(words, k=8))) for _ in range(900)] + [(n, " ".join(rng.choices(words, k=8)) + (" idiot" if n % 2 else "")) for n in range(10, 60)]
    docs = frame(spark, texts, "doc_id long, text string")
    labels = frame(spark, [(5, 0), (None, 1), (77_777, 1)] + [(n, n % 2) for n in range(10, 60)], "doc_id long, toxic int")
    seen = []
    whole = toxicity.bounded_sample
    monkeypatch.setattr(toxicity, "bounded_sample", lambda rows, most, **k: seen.append((most, whole(rows, most, **k))) or seen[-1][1])
    toxicity.learn_toxicity(docs, labels, max_rows=100)
    assert seen[0][0] == 200 and seen[0][1].count() <= 200


def test_repeated_rows_are_one_document(spark):
    long = " ".join(f"w{n}" for n in range(60))
    rows = [(1, long, "x")] * 3 + [(2, long + " end", "y")] + [(None, "lone", "z")] * 2 + [(3, "Lone", "a"), (4, None, "b"), (4, "", "c"), (5, "of its own", None)]
    df = frame(spark, rows, "doc_id long, text string, _n string")
    exact = exact_dedup.drop_exact_copies(df)
    assert exact.columns == df.columns and sorted((str(r.doc_id), r.text or "") for r in exact.collect()) == [("1", long), ("2", long + " end"), ("3", "Lone"), ("4", ""), ("5", "of its own")]
    near = simhash.drop_near_copies(df)
    assert sorted((str(r.doc_id), r.text or "") for r in near.collect()) == sorted([("1", long), ("3", "Lone"), ("4", ""), ("5", "of its own"), ("None", "lone")])
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0


def shown(template, turns, **options):
    return list(chat.render_turns(turns, template, **options))


def test_probes_and_texts_shown_twice():
    odd = [("user", "a\U0010fffdb"), ("assistant", "\U0010fffc")]
    assert [s[1][s[2] : s[3]] for s in shown(lambda m: "".join(f"<{t}>" for _, t in m), odd)] == [t for _, t in odd]
    twice = shown(lambda m: "".join(f"<{t}|{t}>" for _, t in m), [("user", "abc")])
    assert twice[0][-1] and twice[0][2] == twice[0][3]
    sized = shown(lambda m: "".join(f"{len(t)}:{t};" for _, t in m), [("user", "abc")])
    assert sized[0][-1]  # the head depends on the text


def test_a_wrong_declaration_takes_whole_prefixes(spark):
    def numbered(messages):
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(messages))

    def forgetful(messages):
        return "".join(f"[{t if i >= len(messages) - 2 else '...'}]" for i, (_, t) in enumerate(messages))

    def windowed(messages):  # right as long as there are fewer than nine turns
        return "".join(f"[{t if len(messages) < 9 else '?'}]" for _, t in messages)

    turns = [("user" if n % 2 == 0 else "assistant", f"é{n}") for n in range(20)]
    df = frame(spark, [(1, n, r, t) for n, (r, t) in enumerate(turns)], CHAT)
    [got] = chat.format_chats(df, template=numbered, history=1).collect()
    assert got.formatted == numbered(turns) and not got.rewritten and [got.formatted[a:b] for a, b in zip(got.text_start, got.text_end)] == [t for _, t in turns]
    for template in (forgetful, windowed):
        [got] = chat.format_chats(df, template=template, history=2).collect()
        assert got.formatted == template(turns) and got.rewritten
    pieces = chat.format_chats(df, template=windowed, history=2, piece=4, block_turns=6).orderBy("piece").collect()
    assert sum(len(p.roles) for p in pieces) == 20 and not any(p.rewritten for p in pieces)  # no window of eight turns shows it
    pieces = chat.format_chats(df, template=windowed, history=4, piece=4, block_turns=6).orderBy("piece").collect()
    assert [p.rewritten for p in pieces[:2]] == [False, False] and pieces[2].rewritten and [p.piece for p in pieces] == list(range(len(pieces)))
