"""The stored search index: pruned buckets, updates, reopening, folding, prefixes, phrases, against brute force."""

import math
import os
import re
import unicodedata
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadloom.operators import search_index
from threadloom.operators.search_index import SearchIndex

ROWS = [
    (1, "The key light is an ARRI light", "Anna"), (2, "Café Über naïve éclair, key of light", "Bob"), (3, None, "Key"), (4, "", None), (5, "light key light key", "anna"),
    (6, "licensed licensing license", "x"), (7, "日本語 Ärger 2024", "über"),
]


def words(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if not unicodedata.category(c).startswith("M"))
    return re.findall(r"[^\W_]+", plain)


def brute(rows, terms, matches):
    """BM25 of the terms over documents that match."""
    docs = {k: words(t) + words(a) for k, t, a in rows}
    docs = {k: w for k, w in docs.items() if w}
    mean = sum(map(len, docs.values())) / len(docs)
    df = {t: sum(t in w for w in docs.values()) for t in terms}
    score = {k: sum(math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms if t in w) for k, w in docs.items() if matches(w)}
    return sorted(((k, round(s, 6)) for k, s in score.items()), key=lambda x: (-x[1], x[0]))


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "id int, body string, author string").withColumns({"term": F.lit("clash"), "length": F.lit(0), "key": F.lit("clash")})


@pytest.fixture(scope="module")
def index(spark, frame):
    return SearchIndex.build(frame, "id", {"text": "body", "author": "author"}, buckets=16, tokens="unicode")


def got(df):
    return [(r[0], round(r.score, 6)) for r in df.collect()]


def test_search_against_brute_force(index):
    assert got(index.search(all_of=["KEY", "light"])) == brute(ROWS, ["key", "light"], lambda w: {"key", "light"} <= set(w))
    assert got(index.search(any_of=["cafe", "über"])) == brute(ROWS, ["cafe", "uber"], lambda w: {"cafe", "uber"} & set(w))
    assert got(index.search(any_of=["日本語"])) == brute(ROWS, ["日本語"], lambda w: "日本語" in w)
    assert got(index.search(prefix=["Licens"])) == brute(ROWS, ["licensed", "licensing", "license"], lambda w: "license" in w)
    assert [r.id for r in index.search(phrase=["key", "light"], columns=["text"]).collect()] == [5, 1] or {r.id for r in index.search(phrase=["key", "light"], columns=["text"]).collect()} == {1, 5}
    assert {r.id for r in index.search(any_of=["light"], none_of=["arri"]).collect()} == {2, 5}
    assert index.search(all_of=["neverfound", "key"]).count() == index.search(all_of=["!"]).count() == 0
    assert {r.id for r in index.search(any_of=["key"], facets=index.spark.createDataFrame([(3,), (5,)], "id int")).collect()} == {3, 5}


def test_prefix_with_many_terms_gives_the_same(index, monkeypatch):
    want = got(index.search(any_of=["key"], prefix=["licens", "an"]))
    monkeypatch.setattr(search_index, "PREFIX_TERMS", 1)
    assert got(index.search(any_of=["key"], prefix=["licens", "an"])) == want and len(want) > 3


def test_keywords_of_several_words_and_capitals(index, spark):
    asked = spark.createDataFrame([("a", "Key Light"), ("b", "ARRI"), ("b", "café"), ("c", "light key light"), ("d", "no such"), ("e", "!")], "name string, keyword string")
    assert {r["name"]: r.hits for r in index.hit_counts(asked, phrase=True).collect()} == {"a": 2, "b": 2, "c": 1, "d": 0, "e": 0}
    assert {r["name"]: r.hits for r in index.hit_counts(asked, ["text"]).collect()} == {"a": 3, "b": 2, "c": 3, "d": 0, "e": 0}
    assert index.hit_counts(asked.limit(0)).count() == 0


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root.removeprefix("file://")).rglob("*.parquet")}


def test_updates_leave_old_files_and_equal_a_new_index(spark, frame):
    index = SearchIndex.build(frame, "id", {"text": "body", "author": "author"}, buckets=8, tokens="unicode")
    before = files(index.root)
    rows = [(2, "a new text with light", "Bob"), (8, "key light again", None), (9, None, None)]
    index = index.update(spark.createDataFrame(rows, "id int, body string, author string")).update(deleted=spark.createDataFrame([(5,), (77,), (None,)], "id int"))
    after = files(index.root)
    assert before.items() <= after.items() and len(after) > len(before)
    now = [r for r in ROWS if r[0] not in (2, 5)] + rows
    for version in (index, SearchIndex(spark, index.root), index.compact(), SearchIndex(spark.newSession(), index.root)):
        assert version.docs == sum(bool(words(t) + words(a)) for _, t, a in now)
        assert got(version.search(any_of=["light", "key"])) == brute(now, ["light", "key"], lambda w: {"light", "key"} & set(w))
    again = index.compact().update(spark.createDataFrame([(5, "key", None)], "id int, body string, author string"))
    now.append((5, "key", None))
    assert got(again.search(any_of=["key"])) == brute(now, ["key"], lambda w: "key" in w)


def test_a_query_reads_the_buckets_of_its_terms(index):
    plan = index.live(F.col("term").isin("light", "arri")).groupBy("term").count()._jdf.queryExecution().executedPlan().toString()
    chosen = [tuple(map(int, m)) for m in re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", plan)]
    assert chosen and all(some <= 2 and every == 16 for some, every in chosen)
    assert "In(term, [arri,light])" in plan and "Exchange" not in plan  # rows of a term are together as they are stored


def test_stems_and_empty_tables(spark, frame):
    index = SearchIndex.build(frame, "id", {"text": "body"}, buckets=4, stem=True)
    assert [r.id for r in index.search(all_of=["licenses"]).collect()] == [6]
    assert index.hit_counts(spark.createDataFrame([("a", "licensing")], "name string, keyword string")).first().hits == 1
    empty = SearchIndex.build(frame.limit(0), "id", {"text": "body"}, buckets=4)
    assert empty.docs == 0 and empty.search(all_of=["key"]).count() == 0 and empty.statistics().count() == 0
    assert got(empty.update(frame.select("id", "body")).search(any_of=["arri"]))[0][0] == 1


def test_a_bucket_with_much_is_several_files(spark, frame, monkeypatch):
    monkeypatch.setattr(search_index, "FILE_TOKENS", 3)
    index = SearchIndex.build(frame.withColumn("body", F.repeat(F.lit("light "), 40)), "id", {"text": "body"}, buckets=2)
    stored = [p for p in os.listdir(index.root.removeprefix("file://") + "/postings-0") if p.endswith(".parquet")]
    assert len(stored) > 1 and index.search(all_of=["light"]).count() == len(ROWS)


def test_build_cuts_texts_once_and_stems_where_they_are_read(spark):
    """Postings come without a shuffle, stems too, and are those of the general form; lengths come from the postings (F20)."""
    from threadloom.operators import search as ops
    from threadloom.operators import search_index as si

    docs = spark.createDataFrame([(1, "Lights lighting light the lights", "src1"), (2, None, "src"), (3, "", None), (4, "relational relations relating", "lights"), (5, "--- ...", "")], "doc_id long, text string, source string")
    about = {"key": "doc_id", "key_type": "bigint", "fields": ["body", "source"], "columns": ["text", "source"], "tokens": "words", "stem": True}
    rows = si._terms_of(docs, about)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    want = ops.stem_index(ops.postings(docs, "doc_id", {"body": "text", "source": "source"}), "doc_id")
    columns = ["doc_id", "field", "term", "tf", "positions"]
    assert sorted(map(tuple, rows.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    index = si.SearchIndex.build(docs, "doc_id", {"body": "text", "source": "source"}, stem=True)
    assert (index.docs, index.total) == (3, 11)
    assert sorted(map(tuple, spark.read.parquet(f"{index.root}/docs-0").select("doc_id", "length").collect())) == [(1, 6), (2, 1), (4, 4)]
