"""Bundles: pieces, joined files, failures; episodes from their parts."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import episodes
from threadloom.sources import bundles

ROWS = "file string, pos long, line string"


@pytest.fixture
def ranges(spark):
    """Small tables in as many ranges as large ones have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_files_whole_in_pieces_and_joined(spark, tmp_path, ranges):
    path = str(tmp_path / "b")
    hot = spark.range(20_000).select(F.lit("hot/lines.txt").alias("file"), F.col("id").alias("pos"), F.format_string("line %06d", "id").alias("line"))
    small = spark.range(300).select(F.format_string("e%03d/meta.json", "id").alias("file"), F.lit(0).cast("long").alias("pos"), F.format_string('{"n":%d}', "id").alias("line"))
    index = spark.range(5_000).select(F.lit("index.json").alias("file"), (-F.col("id")).alias("pos"), F.format_string('{"n":%d,"t":"é],"}', "id").alias("line"))
    bundles.write_bundle(hot.unionByName(small).unionByName(index), path, arrays=["index.json"])
    about = bundles.read_manifest(spark, path).first()
    assert about.lines == 25_300 and about.files == 302 and not list((tmp_path / "b").glob("_attempts")) and not list((tmp_path / "b").rglob("*piece*"))
    assert set(about.split) <= {"hot/lines.txt"} and len(about.split["hot/lines.txt"]) > 1
    text = "".join((tmp_path / "b" / p).read_text() for p in about.split["hot/lines.txt"])
    assert text == "".join(f"line {n:06d}\n" for n in range(20_000))
    assert [x["n"] for x in json.loads((tmp_path / "b" / "index.json").read_text())] == list(range(4_999, -1, -1))
    assert bundles.read_array(spark, f"{path}/index.json", "n long, t string").agg(F.sum("n"), F.count_if(F.col("t") == "é],")).first()[:] == (4_999 * 2_500, 5_000)
    assert bundles.read_lines(spark, path, "lines.txt").groupBy("file").count().first()[:] == ("hot/lines.txt", 20_000)
    assert json.loads((tmp_path / "b" / "e007" / "meta.json").read_text()) == {"n": 7}


def test_empty_tables_nulls_and_failures(spark, tmp_path):
    bundles.write_bundle(spark.createDataFrame([], ROWS), str(tmp_path / "none"), arrays=["index.json"])
    assert (tmp_path / "none" / "index.json").read_text() == "[]" and bundles.read_manifest(spark, str(tmp_path / "none")).first().lines == 0
    bundles.write_bundle(spark.createDataFrame([("a/x.json", 1, None), ("a/x.json", 0, "1"), ("a/x.txt", None, None), ("a/x.txt", 3, "é\x00")], ROWS), str(tmp_path / "nulls"), arrays=["x.json"])
    assert json.loads((tmp_path / "nulls" / "a" / "x.json").read_text()) == [1, None] and (tmp_path / "nulls" / "a" / "x.txt").read_text() == "\né\x00\n"
    with pytest.raises(Exception, match="new path"):
        bundles.write_bundle(spark.createDataFrame([("a/x", 1, "")], ROWS), str(tmp_path / "nulls"))
    for n, bad in enumerate((None, "", "../x", "/x", "a//b", "manifest.json", "_attempts/x")):
        with pytest.raises(Exception, match="not the name of a file"):
            bundles.write_bundle(spark.createDataFrame([("a/good", 1, ""), (bad, 1, "")], ROWS), str(tmp_path / f"bad{n}"))
        assert not (tmp_path / f"bad{n}").exists()


def test_pieces_of_lost_attempts_are_left_out(spark, tmp_path):
    writer = bundles.BundleWriter(str(tmp_path / "b"), ["index.json"])
    lost = tmp_path / "b" / "_attempts" / "3-9"
    lost.mkdir(parents=True)
    (lost / "file").write_text("half")
    (tmp_path / "b" / "index.json.piece-000001").write_text('["b"]')
    (tmp_path / "b" / "index.json.piece-000000").write_text('["a"]')
    done = [bundles.TaskFiles(1, 0, 1, [("index.json", "index.json.piece-000001")]), None, bundles.TaskFiles(0, 0, 1, [("index.json", "index.json.piece-000000")])]
    writer.commit(done)
    assert json.loads((tmp_path / "b" / "index.json").read_text()) == ["a", "b"] and sorted(p.name for p in (tmp_path / "b").iterdir()) == ["index.json", "manifest.json"]
    writer.abort([])
    assert not (tmp_path / "b").exists()


def test_statistics_document(spark, tmp_path, ranges):
    totals = spark.createDataFrame([(3, 2)], "total_posts long, unique_authors long")
    names = spark.createDataFrame([("a", 'q"x'), ("a", "b"), ("a", "b c"), ("a", "é"), ("a", None), ("t", "one"), ("other", "x")], "list string, name string")
    best = spark.createDataFrame([("b", 2), ('q"x', 5)], "name string, posts long")
    bundles.publish_statistics(totals, best, names, ["a", "f", "t"], str(tmp_path / "s"))
    found = json.loads((tmp_path / "s" / "statistics.json").read_text())
    assert found == {"corpus_statistics": {"total_posts": 3, "unique_authors": 2}, "top_authors": [{"name": 'q"x', "posts": 5}, {"name": "b", "posts": 2}], "a": ["b", "b c", 'q"x', "é"], "f": [], "t": ["one"]}
    bundles.publish_statistics(totals, best.limit(0), names.limit(0), [], str(tmp_path / "e"))
    assert json.loads((tmp_path / "e" / "statistics.json").read_text()) == {"corpus_statistics": {"total_posts": 3, "unique_authors": 2}, "top_authors": []}


def test_bucket_files(spark, tmp_path):
    members = spark.createDataFrame(
        [("low-a", "A", "t1", "f", "ann", 1), ("low-b", "B", "t1", "f", "ann", 1), ("low-a", "A", "t/2", None, None, None)],
        "bucket_id string, bucket_name string, topic_slug string, forum_slug string, started_by string, reply_count long")
    topics = spark.createDataFrame([("t1", '{"topic_slug":"t1"}'), ("t/2", "{ }\n"), ("t3", "{}")], "topic_slug string, document string")
    bundles.publish_buckets(members, topics, str(tmp_path / "b"), "2024-01-01")
    assert json.loads((tmp_path / "b" / "consolidation_summary.json").read_text()) == [{"bucket_id": "low-a", "bucket_name": "A", "topics_count": 2, "authors_count": 1, "replies": 1}]
    assert sorted(p.name for p in (tmp_path / "b" / "topics").iterdir()) == ["t%2F2.json", "t1.json"]
    assert json.loads((tmp_path / "b" / "topics" / "t1.json").read_text())["curation"]["consolidated_bucket"] == "low-a"
    assert set(json.loads((tmp_path / "b" / "topics" / "t%2F2.json").read_text())) == {"curation"}
    assert len((tmp_path / "b" / "consolidated" / "low-a.jsonl").read_text().splitlines()) == 2


META = "slug string, title string, pub_date_iso string, itunes_season int, itunes_episode int, itunes_duration string, description_html string, itunes_image string, audio_seconds double"
MANIFEST = "slug string, canonical string, canonical_run_id string, runs array<string>"
REPORT = "slug string, run_id string, success boolean, chapters_generated long, word_count long, speakers_detected long"
CHAPTER = "slug string, run_id string, topics array<string>, films array<string>"


def _episodes(spark):
    slug = "S02E182__2026-02-25__a-guest__libsyn_abc"
    meta = [(slug, "SEASON 2 - EPISODE 182 - A Guest", None, 0, None, "1:02:03", "<p>", None, None), ("s2", None, "2026-01-01", 1, 5, "x:1", None, "i", 61.9), ("s3", "Season 1 - Episode 2 - ", "", None, None, None, None, None, None)]
    manifests = [(slug, None, "r2", ["r1", "r2"]), ("s2", "", "r9", None), ("gone", "r", None, [])]
    reports = [(slug, "r2", True, 3, 100, None), (slug, "r1", True, 9, 9, 9), ("s2", "r9", False, 1, 1, 1)]
    chapters = [(slug, "r2", ["b", "a"], ["f"]), (slug, "r2", ["a"], None), (slug, "r1", ["no"], ["no"])]
    frames = [spark.createDataFrame(r, s) for r, s in ((meta, META), (manifests, MANIFEST), (reports, REPORT), (chapters, CHAPTER), ([("s2", 0.5)], "slug string, coverage double"))]
    return slug, frames


def test_episodes_from_their_parts(spark):
    slug, frames = _episodes(spark)
    found = {r.slug: r.asDict(True) for r in episodes.assemble_episodes(*frames).collect()}
    assert set(found) == {slug, "s2", "s3"}
    one = found[slug]
    assert (one["title"], one["pubDate"], one["season"], one["episode"], one["durationSeconds"], one["canonicalRunId"], one["allRunIds"]) == ("A Guest", "2026-02-25", 2, 182, 3723, "r2", ["r1", "r2"])
    assert one["stats"] == {"chapters": 3, "words": 100, "speakers": 0, "topics": ["a", "b"], "films": ["f"]} and not one["hasGoal"]
    two = found["s2"]
    assert (two["title"], two["season"], two["durationSeconds"], two["hasTranscript"], two["stats"], two["hasGoal"], two["reviewCoverage"], two["allRunIds"]) == ("s2", 1, 61, True, None, True, 0.5, [])
    assert (found["s3"]["title"], found["s3"]["hasTranscript"], found["s3"]["season"], found["s3"]["pubDate"]) == ("Season 1 - Episode 2 - ", False, None, "")


def test_episode_bundle(spark, tmp_path, ranges):
    slug, frames = _episodes(spark)
    items = episodes.assemble_episodes(*frames)
    chapters = spark.createDataFrame([(slug, 1, "two"), (slug, 0, "one"), ("gone", 0, "x")], "slug string, pos long, title string")
    segments = spark.createDataFrame([(slug, n, f"t{n}") for n in range(50)], "slug string, pos long, text string")
    bundles.publish_episodes(items, chapters, segments, str(tmp_path / "e"))
    index = json.loads((tmp_path / "e" / "index.json").read_text())
    assert [i["slug"] for i in index] == [slug, "s2", "s3"] and list(index[0]) == bundles.INDEX_KEYS and index[1]["stats"] is None
    assert json.loads((tmp_path / "e" / "s2" / "meta.json").read_text())["durationSeconds"] == 61
    split = json.loads((tmp_path / "e" / "manifest.json").read_text())["split"]
    whole = lambda f: "".join((tmp_path / "e" / p).read_text() for p in split.get(f, [f]))
    assert [json.loads(x)["text"] for x in whole(f"{slug}/transcript.jsonl").splitlines()] == [f"t{n}" for n in range(50)]
    assert [json.loads(x)["title"] for x in whole(f"{slug}/chapters.json").replace("][", ",").strip("[]").split(",\n")] == ["one", "two"] and not (tmp_path / "e" / "gone").exists()


def test_files_are_read_by_name(spark, tmp_path, ranges):
    """Lines of whole files and of pieces, without a task per file or folder; absent files have none."""
    path = str(tmp_path / "b")
    hot = spark.range(20_000).select(F.lit("hot/lines.txt").alias("file"), F.col("id").alias("pos"), F.format_string("é %06d", "id").alias("line"))
    small = spark.range(400).select(F.format_string("e%%2F%03d/lines.txt", "id").alias("file"), F.lit(0).cast("long").alias("pos"), F.lit("").alias("line"))
    bundles.write_bundle(hot.unionByName(small), path)
    assert len(bundles.read_manifest(spark, path).first().split["hot/lines.txt"]) > 1
    files = spark.range(500).select("id", F.format_string("e%%2F%03d/lines.txt", "id").alias("file")).unionByName(spark.createDataFrame([(-1, "hot/lines.txt")], "id long, file string"))
    got = bundles.read_named(files, path)
    assert got.columns == ["id", "value"] and got.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    rows = got.groupBy((F.col("id") < 0).alias("hot")).agg(F.count("value"), F.count_distinct("id"), F.count_distinct("value"), F.max("value")).collect()
    assert {r.hot: tuple(r)[1:] for r in rows} == {True: (20_000, 1, 20_000, "é 019999"), False: (400, 400, 1, "")}
