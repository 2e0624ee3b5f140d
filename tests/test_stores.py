"""The curated store, snapshots and summaries on hand-made rows."""

import json

from pyspark.sql import functions as F

from threadloom.operators import curation
from threadloom.sources import curated as store

POST = "post_id string, author string, tier string"


def test_upsert_rewrites_touched_tiers_only_and_moves_posts(spark, tmp_path):
    target = str(tmp_path / "tiers")
    assert store.read_tiers(spark, target, spark.createDataFrame([], POST).schema).count() == 0
    store.write_tiers(spark.createDataFrame([("1", "a", "A"), ("2", "b", "B"), ("3", "c", "C"), ("4", None, None)], POST), target)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "tiers" / "tier=C").glob("*.parquet")}
    changed = store.upsert_posts(spark.createDataFrame([("1", "a", "B"), ("5", "e", "B")], POST), target)
    assert sorted(changed) == ["A", "B"]
    found = store.read_tiers(spark, target, spark.createDataFrame([], POST).schema)
    assert sorted(map(tuple, found.collect()), key=str) == [("1", "a", "B"), ("2", "b", "B"), ("3", "c", "C"), ("4", None, None), ("5", "e", "B")]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "tiers" / "tier=C").glob("*.parquet")} == files
    assert store.upsert_posts(spark.createDataFrame([], POST), target) == []
    store.upsert_posts(spark.createDataFrame([("4", "d", "C")], POST), target)
    assert {(r.post_id, r.tier) for r in found.sparkSession.read.schema(found.schema).parquet(target).filter("post_id = '4'").collect()} == {("4", "C")}


def test_reads_of_a_tier_prune_folders(spark, tmp_path):
    target = str(tmp_path / "tiers")
    store.write_tiers(spark.range(100).selectExpr("cast(id as string) as post_id", "'x' as author", "array('S', 'A', 'B')[id % 3] as tier"), target)
    rows = store.read_tiers(spark, target, spark.createDataFrame([], POST).schema)
    one = rows.filter("tier = 'S'")
    assert one.count() == 34
    assert "(tier#" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]
    assert {r[0].split("tier=")[1][0] for r in one.select(F.input_file_name()).distinct().collect()} == {"S"}
    wanted = spark.createDataFrame([("S", "master"), ("A", "pro")], "tier string, title string").filter("title = 'master'")
    joined = rows.join(F.broadcast(wanted), "tier")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 34


def test_previous_snapshot_is_the_latest_before(spark, tmp_path):
    target, schema = str(tmp_path / "snaps"), "forum_slug string, topics_scraped long"
    assert store.previous_snapshot(spark, target, 5, schema).count() == 0
    for at, n in ((10, 1), (20, 4), (20, 5), (30, 9)):  # the second of time 20 replaces the first
        store.save_snapshot(spark.createDataFrame([("f", n)], schema), target, at)
    assert [r.topics_scraped for r in store.previous_snapshot(spark, target, 30, schema).collect()] == [5]
    assert store.previous_snapshot(spark, target, 10, schema).count() == 0
    now = spark.createDataFrame([("f", 9), ("g", 2)], schema)
    assert {tuple(r) for r in store.snapshot_change(now, target, 30, schema).select("forum_slug", "delta", "is_new").collect()} == {("f", 4, False), ("g", 2, True)}


def test_log_grows_by_days(spark, tmp_path):
    target, schema = str(tmp_path / "log"), "query_name string, ts timestamp"
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        store.append_log(spark.createDataFrame([("q", day)], "query_name string, ts string").withColumn("ts", F.col("ts").cast("timestamp")), target)
    assert store.read_log(spark, target, schema).count() == 3
    assert store.read_log(spark, target, schema, "2024-01-02").count() == 2


def test_summary_of_nulls_and_of_nothing(spark):
    posts = spark.createDataFrame([("A", None, "ab"), ("A", "f", None), (None, "f", "c")], "tier string, forum string, content_text string")
    found = {(r.dimension, r["name"]): (r.posts, r.chars) for r in curation.curation_summary(posts, ["tier", "forum"]).collect()}
    assert found == {("tier", "A"): (2, 2), ("tier", "none"): (1, 1), ("forum", "none"): (1, 2), ("forum", "f"): (2, 1), ("total", "all"): (3, 3)}
    doc = json.loads(curation.summary_document(curation.curation_summary(posts, ["tier", "forum"]), ["tier"], "v1").first().document)
    assert doc == {"curation_version": "v1", "total_posts": 3, "tier": {"A": 2, "none": 1}}
    empty = curation.curation_summary(posts.limit(0), ["tier", "forum"])
    assert [tuple(r) for r in empty.collect()] == [("total", "all", 0, 0)]
    assert json.loads(curation.summary_document(empty, ["tier"], "v1").first().document)["tier"] == {}


def test_tier_authors_are_written_in_order(spark, tmp_path):
    people = spark.createDataFrame([("b", "A", 70.0, 3, 1), ("a", "A", 70.0, 2, 0), ("c", "A", 90.0, 1, 0), ("d", "D", 1.0, 1, 0)], "author string, tier string, score double, post_count long, expert_topics long")
    curation.write_tier_authors(curation.tier_authors(people), str(tmp_path / "authors"))
    lines = [json.loads(x) for p in sorted((tmp_path / "authors" / "tier=A").glob("*.json")) for x in p.read_text().splitlines()]
    assert [(x["author"], x["authors"]) for x in lines] == [("c", 3), ("a", 3), ("b", 3)]
    kinds = [(r.kind, r["name"]) for r in curation.persona_summary(people, 2).collect()]
    assert sorted(kinds) == [("author", "a"), ("author", "c"), ("tier", "A"), ("tier", "D")]
