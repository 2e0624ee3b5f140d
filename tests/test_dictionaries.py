"""Dictionary matching gives the same at every size of the dictionary; tags by a corpus; keywords of several words."""

import re

import pytest

from threadloom.functions.text import dictionary_hits
from threadloom.operators import reports, segments

TEXTS = [
    "The key light and the KEY LIGHT, a café. C++ and c++ but not c+++ or cafés", "Über uns: naïve Café-Bar! key\n light", None, "", "a a a a-b a", "★ ★★ x★ price: 5€ 5€ (5€)", "R\\E quoted \\Q", "café " * 50,
]
WORDS = ["key light", "key", "a", "a a", "café", "c++", "über uns", "★", "5€", "café-bar", "r\\e", "Über uns", "missing", "ünknown", "!", "naïve café"]


def brute(texts, keywords):
    out = {}
    for i, t in enumerate(texts):
        low = (t or "").lower()
        tokens = re.findall("[a-z][a-z0-9'-]*[a-z0-9]|[a-z]", low)
        for k in keywords:
            if re.fullmatch("([a-z][a-z0-9'-]*[a-z0-9]|[a-z])( ([a-z][a-z0-9'-]*[a-z0-9]|[a-z]))*", k):
                w = k.split(" ")
                n = sum(tokens[j : j + len(w)] == w for j in range(len(tokens)))
            else:
                n = len(re.findall(rf"(?<!\w)(?={re.escape(k.lower())}(?!\w))", low))
            if n:
                out[i, k] = n
    return out


@pytest.mark.parametrize("size", [0, 10, 2000, 50_000])
def test_hits_do_not_depend_on_the_size(spark, size):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    more = [f"filler{i}" if i % 2 else f"füller{i}" for i in range(size)]
    dictionary = spark.createDataFrame([("x", k) for k in WORDS + more] + [("y", "café"), ("y", None), ("y", " ")], "class string, keyword string")
    got = dictionary_hits(texts, dictionary, ["id"], "text").collect()
    want = brute(TEXTS, WORDS)
    assert {(r.id, r.keyword): r.n for r in got if r["class"] == "x"} == want
    assert {r.id for r in got if r["class"] == "y"} == {i for i, k in want if k == "café"}


@pytest.mark.parametrize("small", [2000, 3])
def test_keywords_with_signs_alone_and_both_ways_of_plain_ones(spark, small):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    for words in (["café", "c++"], ["key light", "key", "a", "a a"], WORDS):
        dictionary = spark.createDataFrame([("x", k) for k in words], "class string, keyword string")
        assert {(r.id, r.keyword): r.n for r in dictionary_hits(texts, dictionary, ["id"], "text", small).collect()} == brute(TEXTS, words)
    assert dictionary_hits(texts, dictionary.limit(0), ["id"], "text", small).count() == dictionary_hits(texts.limit(0), dictionary, ["id"], "text", small).count() == 0


def test_tags_raised_by_a_corpus(spark):
    posts = spark.createDataFrame([("light light lens", "t1"), ("light fog", "t2"), ("lens lens lens lens", "t1"), ("other", "t3"), ("", "t3"), (None, None)], "text string, topic string")
    corpus, index = segments.corpus_terms(posts, "text", "topic")
    assert {r.term: round(r.tfidf, 4) for r in corpus.collect()} == {"light": 2.0794, "lens": 3.4657, "fog": 1.3863, "other": 1.3863}
    rows = spark.createDataFrame([(1, "we talk of light and of a lens and of much else here today"), (2, "none of that at all")], "id int, text string")
    dictionary = spark.createDataFrame([("optics", "light"), ("optics", "lens"), ("weather", "unheard"), ("talk", "we talk")], "class string, keyword string")
    got = {r["class"]: (r.confidence, r.keywords, r.related) for r in segments.topic_tags(rows, dictionary, ["id"], 0.3, corpus, index).collect()}
    assert got == {"optics": (round(0.4 * 2 / 3 + 0.6 + (2.0794415 + 3.4657359) / 2 / 100, 3), "lens,light", "t1,t2"), "talk": (round(0.4 / 3 + 0.6 * 10 / 14, 3), "we talk", "")}


def test_keywords_of_questions(spark):
    texts = spark.createDataFrame([("An ARRI with a key to the light", "f"), ("Roger Deakins said", "f"), ("deakins alone", "g")], "text string, forum string")
    questions = spark.createDataFrame([("q", ["key light", "ARRI"], ["f"], 2), ("r", ["Roger Deakins"], ["f"], 1), ("s", ["!", "no such"], [], 1)], "name string, keywords array<string>, forums array<string>, least int")
    assert {r["name"]: (r.hits, r.complete) for r in reports.question_report(questions, texts, "forum", "text", "forum").collect()} == {"q": (2, True), "r": (1, True), "s": (0, False)}


def test_classes_are_grouped_inside_the_row_and_as_by_joins(spark):
    from threadloom.functions.text import class_hits
    from threadloom.operators import segments as ops

    texts = spark.createDataFrame([(1, "the Cat of the house, a cat"), (2, "of the of"), (3, None), (4, "nothing")], "id long, text string")
    dictionary = spark.createDataFrame([("a", "the"), ("a", "cat"), ("a", "cat"), ("b", "of the"), ("b", "cat"), ("c", None)], "class string, keyword string")
    want = {(1, "a", ("cat", "the")), (1, "b", ("cat", "of the")), (2, "a", ("the",)), (2, "b", ("of the",))}
    for small in (2000, 1):
        found = class_hits(texts, dictionary, ["id"], "text", small)
        assert {(r.id, r["class"], tuple(r.found)) for r in found.collect()} == want
    assert class_hits(texts, dictionary.limit(0), ["id"], "text").count() == 0
    tags = ops.topic_tags(texts, dictionary, ["id"], least=0.0)
    assert "Exchange" not in tags._jdf.queryExecution().executedPlan().toString() and {r.keywords for r in tags.collect()} >= {"cat,the", "cat,of the"}


def test_term_stats_without_documents_in_the_shuffle(spark, tmp_path):
    """Texts that share an id are one document, texts without an id none; no shuffle goes by term and document."""
    from threadloom.plans import segments

    rows = [(1, "fog fog light"), (7, "fog"), (7, "Fog lens"), (None, "fog only"), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = segments.term_stats(spark, str(tmp_path))
    assert {r.term: (r.tf, r.df, r.expert_tf) for r in found.collect()} == {"fog": (5, 2, 2), "light": (1, 1, 0), "lens": (1, 1, 1), "only": (1, 0, 0)}
    alone = tmp_path / "alone"
    spark.createDataFrame(rows[:2], "doc_id long, text string").write.parquet(str(alone / "documents.parquet"))
    plan = segments.term_stats(spark, str(alone))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_questions_need_no_index(spark, tmp_path):
    from threadloom.plans import search

    before = dict(search._STORED)
    spark.createDataFrame([(1, "Fog of the lens", "s"), (2, "the fog", "s"), (3, None, "s")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    asked = spark.createDataFrame([("Of The",), ("FOG",), ("none",), ("FOG",)], "keyword string")
    assert {r.keyword: r.hits for r in search.keyword_hits(spark, str(tmp_path), asked).collect()} == {"Of The": 1, "FOG": 2}
    assert search._STORED == before
