"""Reports on hand-made rows: nulls, empty tables, missing names."""

import json

from pyspark.sql import functions as F

from threadloom.operators import curation, reports
from threadloom.sources import extract, leaves

POST = "post_id string, author string, role string, forum_slug string, topic_slug string, content_text string"


def test_records_of_missing_values(spark):
    posts = spark.createDataFrame([("1", None, None, None, "t", None), ("2", "ann", "Master of Light", "f", "t", "hi\nthere")], POST)
    found = {r.post_id: r.record for r in reports.post_records(posts).collect()}
    rule = "=" * 80
    assert found["1"] == f"{rule}\nPOST ID: 1\nAUTHOR: Unknown\nROLE: N/A\nFORUM: N/A\nTOPIC: t\n{rule}\n"
    assert found["2"].endswith(f"{rule}\nhi\nthere")
    assert [r.record for r in reports.role_records(posts, "Light").collect()] == [f"POST ID: 2\nTOPIC: t\nFORUM: f\n{rule}\nhi\nthere"]


def test_totals_of_nothing_and_of_blocks(spark):
    none = spark.createDataFrame([], POST)
    row = reports.corpus_totals(none).first()
    assert row.total_posts == row.total_text_length == row.average_post_length == row.total_links == 0
    text = "a\n\n> b\n\nc wrote: d [x](https://e.org/1) https://e.org/1"
    row = reports.corpus_totals(spark.createDataFrame([("1", "a", None, "f", "t", text), ("2", "a", None, None, "t", None)], POST)).first()
    assert (row.total_content_blocks, row.total_quotes, row.total_links, row.unique_forums, row.unique_authors) == (3, 2, 1, 1, 1)
    assert row.average_post_length == len(text) // 2
    lists = {(r["list"], r["name"]): r.posts for r in reports.name_lists(none, {"author": "authors"}).collect()}
    assert lists == {}


def test_coverage_of_unknown_and_unscraped_forums(spark):
    topics = spark.createDataFrame([("new-lenses", "t1", 5), ("new-lenses", "t2", 3), ("old", "t3", 1)], "forum_slug string, topic_slug string, scraped_at int")
    forums = spark.createDataFrame([("old", "Old Forum", 0), ("never", "Never", 9)], "forum_slug string, name string, total_topics long")
    found = {r.forum_slug: tuple(r)[1:] for r in reports.coverage_span(topics, forums).collect()}
    assert found == {"new-lenses": ("New Lenses", 2, 2, 3, 5), "old": ("Old Forum", 1, 0, 1, 1)}


def test_question_notes(spark):
    texts = spark.createDataFrame([(1, "light and lens", "f1"), (2, "light", "f2"), (3, None, None)], "doc_id int, text string, source string")
    questions = spark.createDataFrame(
        [("half", ["light"], ["f1", "gone"], 2), ("few", ["lens"], ["f1"], 3), ("gone", ["light"], ["x", "gone", "f1"], 1), ("none", [], [], 1)], "name string, keywords array<string>, forums array<string>, least int")
    found = {r.name: (r.hits, r.complete, r.note) for r in reports.question_report(questions, texts, "doc_id", "text", "source").collect()}
    assert found == {
        "half": (2, True, "✓ 2 relevant posts found"), "few": (1, False, "⚠ Only 1/3 posts found"), "gone": (2, False, "⚠ Missing forums: gone, x"),
        "none": (0, False, "⚠ Only 0/1 posts found"),
    }


def test_high_class_needs_more_than_ten_replies(spark):
    ids = {"long": [f"l{i}" for i in range(12)], "ten": [f"t{i}" for i in range(11)]}
    topics = spark.createDataFrame([(k, "f", v, len(v) - 1) for k, v in ids.items()], "topic_slug string, forum_slug string, post_ids array<string>, reply_count int")
    posts = spark.createDataFrame([(p, "ann", "text") for v in ids.values() for p in v], "post_id string, author string, content_text string")
    kinds = {r.topic_slug: r.engagement for r in curation.engagement(topics, posts, []).collect()}
    assert kinds == {"long": "high", "ten": "medium"}


def test_names_of_structs_strings_and_nulls(spark):
    structs = spark.createDataFrame([(1, [("a", 0.5)]), (2, None)], "id int, topics array<struct<name: string, confidence: double>>")
    strings = spark.createDataFrame([(1, ["a"]), (2, [])], "id int, topics array<string>")
    for df in (structs, strings):
        assert {r.id: r.topics for r in reports.names_of(df, "topics", "name").collect()} == {1: ["a"], 2: []}


def test_batch_report(spark):
    runs = spark.createDataFrame([(1, "ok"), (1, "bad"), (2, "bad"), (2, "bad"), (None, "bad")], "k int, state string")
    expected = spark.createDataFrame([(1,), (2,), (3,), (3,)], "k int")
    found = sorted(tuple(r) for r in reports.batch_report(runs, expected, "k", F.col("state") == "bad", F.col("state") == "ok").collect() if r.key)
    assert found == [("failure", "1", 1), ("failure", "2", 2), ("gap", "2", 0), ("gap", "3", 0), ("result", "1", 1)]


def test_manifest_and_named_leaves(spark, tmp_path):
    (tmp_path / "index.json").write_text(json.dumps({"forums": [{"slug": "a", "title": "A"}, {"slug": "b"}], "other": 1}, indent=1))
    assert {tuple(r) for r in leaves.read_manifest(spark, f"{tmp_path}/index.json", "forums", "slug string, title string").collect()} == {("a", "A"), ("b", None)}
    films = tmp_path / "films"
    films.mkdir()
    (films / "blade-runner.json").write_text(json.dumps({"title": "Blade"}, indent=1))
    (films / "broken.json").write_text("{")
    (films / "notes.txt").write_text("x")
    assert {r.leaf_id: r.title for r in leaves.named_leaves(spark, str(films), "title string").collect()} == {"blade-runner": "Blade", "broken": None}
    assert {r.leaf_id for r in leaves.leaf_ids(spark, str(films)).collect()} == {"blade-runner", "broken"}


def test_forum_refs(spark):
    html = '<a href="/forums/forum/light/">Light</a><a href="/forums/forum/light/"></a><a href="/forums/forum/light/">Light 2</a><a href="/forums/forum/x/y">no</a><a href="https://e.org/forums/forum/cams">Cams</a><a href="/forums/topic/t/">t</a>'
    pages = spark.createDataFrame([(1, "https://e.org/forums/", html), (2, "https://e.org/", None)], "page_id long, url string, html string")
    assert {tuple(r) for r in extract.forum_refs(pages).collect()} == {(1, "https://e.org/forums/forum/light/", "light", "Light 2"), (1, "https://e.org/forums/forum/cams", "cams", "Cams")}
